"""A flat target that takes new columns.

Each run's rows are a directory of their own, written once; after them the
run's column list, which marks the run as complete. A reader takes the newest
list and reads all complete runs in one scan with that schema; rows written
before a column came have 0 in it. No earlier file is written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.flatten import quote
from ledgerloom.plans import runs


class GrowingTable:
    """``fixed``: DDL of the event columns; every other column is a count."""

    def __init__(self, spark: SparkSession, root: str, name: str, fixed: str):
        self.spark, self.root, self.name = spark, root, name
        self.fixed = T.StructType.fromDDL(fixed)

    def _versions(self) -> list[str]:
        return runs.complete_runs(self.spark, self.root, f"{self.name}_columns")

    def counts(self, run_id: str | None = None) -> list[str]:
        """The count columns as of ``run_id`` (default: the newest run)."""
        done = [r for r in self._versions() if run_id is None or r <= run_id]
        if not done:
            return []
        rows = runs.read_run(self.spark, self.root, f"{self.name}_columns", done[-1])
        return [r["column"] for r in rows.orderBy("place").collect()]

    def append(self, rows: DataFrame, run_id: str) -> None:
        """Add ``rows``; columns that the table lacks are new counts.

        A run id comes after those of all complete runs; one that broke off
        may be written again.
        """
        done = self._versions()
        if done and run_id <= done[-1]:
            raise ValueError(f"run {run_id} does not come after {done[-1]}")
        known = self.counts()
        fixed = self.fixed.fieldNames()
        counts = known + [c for c in rows.columns if c not in known and c not in fixed]
        present = [c for c in counts if c in rows.columns]
        runs.write_run(rows.select(*[F.col(quote(c)).cast(self.fixed[c].dataType) for c in fixed],
                                   *[F.col(quote(c)).cast("bigint") for c in present]), self.root, self.name, run_id)
        names = self.spark.createDataFrame(list(enumerate(counts)), "place int, column string")
        runs.write_run(names.coalesce(1), self.root, f"{self.name}_columns", run_id)

    def read(self, run_id: str | None = None) -> DataFrame:
        """The rows of all complete runs up to ``run_id``."""
        counts = self.counts(run_id)
        schema = T.StructType([*self.fixed.fields, *[T.StructField(c, T.LongType()) for c in counts]])
        paths = [runs.run_path(self.root, self.name, r) for r in self._versions() if run_id is None or r <= run_id]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths).select(
            *[F.col(quote(c)) for c in self.fixed.fieldNames()],
            *[F.coalesce(F.col(quote(c)), F.lit(0)).alias(c) for c in counts])
