import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ck = tempfile.mkdtemp(prefix="cardiolake-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("cardiolake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", ck)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ck)
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="cardiolake-test-")
