"""Run directories: each run's tables under ``<root>/<table>/run=<id>/``.

J34 write_run / previous_run (the renamed ``_COPY`` tables of the legacy
procedure become immutable run directories; "previous" is the newest
complete run before the current one), J35 empty_targets (full reload).

Nothing is overwritten in place: a run writes a new directory, so a job
never reads a path it is replacing. Spark's ``_SUCCESS`` marker tells a
complete run from one interrupted by a failure.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import COMPACT, checkpoint_root, delete_path, path_exists
from ledgerloom.sources.schemas import TARGET_SCHEMAS


def new_run_id(now: dt.datetime | None = None) -> str:
    """Sortable run id from a time (e.g. 20240101T093000)."""
    return (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%dT%H%M%S")


def run_path(root: str, table: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{table}/run={run_id}"


def write_run(df: DataFrame, root: str, table: str, run_id: str) -> str:
    """Write ``df`` as this run's copy of ``table``; returns the path.

    A run only reads older runs, so rewriting its own directory (a retry of
    a failed run with the same id) never touches data it is reading.
    """
    path = run_path(root, table, run_id)
    df.write.mode("overwrite").options(**COMPACT).parquet(path)
    return path


def reopen_run(spark: SparkSession, root: str, run_id: str) -> None:
    """Take back the commit mark of a run that is about to be written again:
    until its new report is written it does not count."""
    delete_path(spark, run_path(root, REPORT_TABLE, run_id))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath, jvm


def complete_runs(spark: SparkSession, root: str, table: str) -> list[str]:
    """Run ids of ``table`` whose write committed, oldest first."""
    fs, base, jvm = _fs(spark, f"{root.rstrip('/')}/{table}")
    if not fs.exists(base):
        return []
    runs = []
    for status in fs.listStatus(base):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("run="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                runs.append(name[len("run="):])
    return sorted(runs)


def previous_run(spark: SparkSession, root: str, table: str,
                 before: str | None = None) -> DataFrame | None:
    """The newest complete run of ``table`` (older than ``before``), or None."""
    runs = [r for r in complete_runs(spark, root, table) if before is None or r < before]
    if not runs:
        return None
    return spark.read.parquet(run_path(root, table, runs[-1]))


def default_root(spark: SparkSession) -> str:
    """Run folder under the shared checkpoint location of the session."""
    return checkpoint_root(spark).rstrip("/") + "/runs"


# The nine targets emptied by a full reload.
RELOADED_TARGETS = ("Cardholders", "Accounts", "AccountBalances", "AccountCardholders",
                    "Addresses", "Emails", "Phones", "Cards", "CardCreationHistories")


def empty_targets(spark: SparkSession) -> dict[str, DataFrame]:
    """The nine targets a full reload starts from, empty."""
    return {name: spark.createDataFrame([], TARGET_SCHEMAS[name]) for name in RELOADED_TARGETS}


REPORT_TABLE = "RunReport"


def last_complete_run(spark: SparkSession, root: str, before: str | None = None) -> str | None:
    """The newest run whose report was written; the report is written last,
    so it marks a run in which every table was committed."""
    done = [r for r in complete_runs(spark, root, REPORT_TABLE) if before is None or r < before]
    return done[-1] if done else None


def read_run(spark: SparkSession, root: str, table: str, run_id: str) -> DataFrame | None:
    if run_id not in complete_runs(spark, root, table):
        return None
    return spark.read.parquet(run_path(root, table, run_id))


STEPS_TABLE = "_steps"


def open_steps(spark: SparkSession, root: str, run_id: str, parameters: dict) -> str:
    """The folder of a run's steps.

    What an earlier attempt left there stays if it had the same parameters and
    goes if not. The parameters are written first, as the head of the manifest.
    """
    folder, text = run_path(root, STEPS_TABLE, run_id), json.dumps(parameters, sort_keys=True)
    head = f"{folder}/parameters"
    if path_exists(spark, f"{head}/_SUCCESS") and spark.read.parquet(head).first()["parameters"] == text:
        return folder
    delete_path(spark, folder)
    spark.createDataFrame([(text,)], "parameters string").write.parquet(head)
    return folder


def close_steps(spark: SparkSession, root: str, run_id: str) -> None:
    delete_path(spark, run_path(root, STEPS_TABLE, run_id))
