"""Targets in hashed buckets, so that a run writes only the buckets it touches.

A table lies in ``<root>/<table>/data/run=<id>/bucket=<b>/``; rows are dealt to
buckets by the hash of their key. The manifest of a run
(``<root>/<table>/manifest/run=<id>``: bucket, run) names the run whose files
hold each bucket, and is written last: a run without one does not count. A
merge reads the touched buckets of the previous manifest, writes those anew and
takes the other entries over, so files of untouched buckets are shared between
runs and nothing is ever overwritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.incremental import append
from ledgerloom.plans.runs import complete_runs, run_path
from ledgerloom.session import COMPACT, delete_path

BUCKET = "bucket"


class BucketedTable:
    """One target: ``schema`` (DDL), ``key`` column, number of ``buckets``.

    Choose the number so that a bucket is a few hundred MB; it stays the same
    for all runs of a table. Null keys share a bucket.
    """

    def __init__(self, spark: SparkSession, root: str, table: str, schema: str, key: str, buckets: int):
        self.spark, self.schema, self.key, self.buckets = spark, schema, key, buckets
        self.base = f"{root.rstrip('/')}/{table}"

    def bucket_of(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.buckets)).cast("int")

    def manifest(self, run_id: str) -> dict[int, str]:
        """bucket -> run that holds it (at most ``buckets`` entries)."""
        rows = self.spark.read.schema("bucket int, run string").parquet(run_path(self.base, "manifest", run_id)).collect()
        return {r["bucket"]: r["run"] for r in rows}

    def has(self, run_id: str) -> bool:
        return run_id in complete_runs(self.spark, self.base, "manifest")

    def paths(self, held: dict[int, str]) -> list[str]:
        return [f"{run_path(self.base, 'data', run)}/{BUCKET}={b}" for b, run in sorted(held.items())]

    def _read(self, held: dict[int, str]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*self.paths(held))

    def read(self, run_id: str) -> DataFrame:
        return self._read(self.manifest(run_id))

    def _commit(self, rows: DataFrame, run_id: str, others: dict[int, str]) -> dict[int, str]:
        path = run_path(self.base, "data", run_id)
        (rows.withColumn(BUCKET, self.bucket_of(self.key)).repartition(F.col(BUCKET)).write.mode("overwrite")
         .options(**COMPACT).partitionBy(BUCKET).parquet(path))
        jvm = self.spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(jpath)]
        held = others | {int(n.partition("=")[2]): run_id for n in names if n.startswith(BUCKET + "=")}
        listed = self.spark.createDataFrame(sorted(held.items()), "bucket int, run string")
        listed.coalesce(1).write.mode("overwrite").parquet(run_path(self.base, "manifest", run_id))
        return held

    def write(self, rows: DataFrame, run_id: str) -> None:
        """The whole table as run ``run_id``."""
        self._commit(rows, run_id, {})

    def merge(self, previous: str, run_id: str, rows: DataFrame, doomed: DataFrame | None = None) -> list[int]:
        """``previous`` without the keys of ``doomed`` (a column named as the
        key) and with ``rows``, as run ``run_id``; returns the touched buckets."""
        keys = rows.select(self.key)
        if doomed is not None:
            keys = keys.unionByName(doomed.select(self.key))
        touched = sorted(r["b"] for r in keys.select(self.bucket_of(self.key).alias("b")).distinct().collect())
        held = self.manifest(previous)
        kept = self._read({b: run for b, run in held.items() if b in set(touched)})
        if doomed is not None:
            kept = kept.join(doomed.select(self.key).distinct(), self.key, "left_anti")
        self._commit(append(kept, rows), run_id, {b: run for b, run in held.items() if b not in set(touched)})
        return touched

    def drop_unused(self, keep: list[str]) -> None:
        """Delete the files that no manifest of the ``keep`` runs names, and the other manifests."""
        used = {(b, run) for run_id in keep for b, run in self.manifest(run_id).items()}
        for run in complete_runs(self.spark, self.base, "manifest"):
            mine = {b for b, r in self.manifest(run).items() if r == run}
            for path in self.paths({b: run for b in mine if (b, run) not in used}):
                delete_path(self.spark, path)
            if run not in keep:
                delete_path(self.spark, run_path(self.base, "manifest", run))
