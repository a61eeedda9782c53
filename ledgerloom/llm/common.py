"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import checkpoint_root, materialize

_SHIPPED: dict[str, str] = {}

__all__ = ["materialize", "name", "pick", "read", "sampled", "scratch", "ship", "text_slices", "strings", "held_out_bucket"]


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application, where it is
    not installed on them (Spark serves the archive from the driver)."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    if _SHIPPED.get("application") == sc.applicationId:
        return
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="ledgerloom-py-")), "ledgerloom.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED["application"] = sc.applicationId


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table by its path; only Spark touches the path, so any store works."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the checkpoint folder that all executors share."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def name(column: str) -> Column:
    """The column of exactly this name (dots and spaces are part of it)."""
    return F.col(f"`{column.replace('`', '``')}`")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under the operator's own names.

    Extra columns, also ones named like an operator's internal or output
    columns, are pruned here and can never clash.
    """
    return df.select(*[name(c).alias(k) for k, c in columns.items()])


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts together stay near ``limit`` bytes
    (one row at least), so that working memory does not follow the batch size."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column as Python strings, null as the empty string."""
    return [x or "" for x in batch.column(column).to_pylist()]


def sampled(share: float, *columns: str) -> Column:
    """Rows whose hash of ``columns`` lies in the lowest ``share`` of all 64-bit values."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(*columns) < F.lit(-(1 << 63) + int(share * (1 << 64)))


def held_out_bucket(id_column: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.encode(F.coalesce(id_column.cast("string"), F.lit("")), "UTF-8")), F.lit(folds))
