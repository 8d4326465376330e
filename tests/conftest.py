import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("RIVULET_TEST_SF", "/root/testdata/sf0.001")
SF_ORACLE = os.environ.get("RIVULET_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("rivulet-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        # list many partition folders with a few tasks, not one task per folder
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
    )
    if not os.environ.get("SPARK_CHECKPOINT_KEEP"):
        # tests set their own shared folder (the session's own one is left alone)
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rivulet-test-"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def sf_oracle():
    return SF_ORACLE
