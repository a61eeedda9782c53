import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ledgerloom.session import BASE_CONF

    builder = (SparkSession.builder.master("local[8]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ll-test-ckpt-")))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
