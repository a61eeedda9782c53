"""Spark session settings shared by tests, bench and the entry points."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_RUN_FOLDER: contextvars.ContextVar[str | None] = contextvars.ContextVar("run_folder", default=None)

# Settings every job relies on: AQE for runtime re-planning (coalesce, skew
# join split, sort-merge -> broadcast when a side is measured small), NTZ-safe
# session zone, no web UI.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "ledgerloom",
    extra_conf: dict | None = None,
) -> SparkSession:
    """Local session for tests and bench; on a cluster use the provided one.

    The checkpoint folder is never set here: ``ensure_checkpoint_dir`` takes
    the session's own, and makes one only for a local session without any.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(BASE_CONF)
    target = (extra_conf or {}).get("spark.master") or master or f"local[{cpus}]"
    if shuffle_partitions or target.startswith("local"):
        # a cluster's own setting stays unless the caller names one
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    if target.startswith("local"):
        conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Only when the session has none (local tests) a scratch folder is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to other executors
            raise ValueError("set spark.checkpoint.dir to a shared folder on the cluster")
        configured = tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables (lineage cuts)."""
    return ensure_checkpoint_dir(spark)


#: Written tables that later steps read: fewer bytes than the default codec.
COMPACT = {"compression": "zstd"}


def materialize(df, label: str = "table"):
    """Cut lineage: write ``df`` once as parquet under the shared checkpoint
    folder and read it back.

    Used where a frame is read by several later steps, or must not be
    recomputed (the numbered rows of the range ranking). Parquet keeps the
    data columnar, the read-back frame has real file sizes for AQE's
    broadcast decisions, and the files survive lost executors.
    """
    spark = df.sparkSession
    path = f"{tables_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**COMPACT).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tables_root(spark: SparkSession) -> str:
    """Folder of the intermediate tables: this application's, or the run's
    inside ``intermediate_tables``."""
    root = f"{checkpoint_root(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}"
    return _RUN_FOLDER.get() or root


@contextlib.contextmanager
def intermediate_tables(spark: SparkSession):
    """A folder of its own for the tables that ``materialize`` writes inside
    the block; it is deleted at the end.

    Frames that read those tables must have been written or collected by
    then (a run commits inside the block).
    """
    path = f"{tables_root(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN_FOLDER.set(path)
    try:
        yield path
    finally:
        _RUN_FOLDER.reset(token)
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(jpath, True).close()
