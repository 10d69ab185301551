import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from skirmish.session import configure
    s = (SparkSession.builder.master("local[*]").appName("skirmish-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="skirmish-test-ckpt-", dir="/tmp"))
         .getOrCreate())
    configure(s)
    yield s
    s.stop()
