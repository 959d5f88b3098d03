import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from featureloom.session import DEFAULT_CONF
    b = SparkSession.builder.master("local[4]").appName("featureloom-tests") \
        .config("spark.sql.shuffle.partitions", "4")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fl-test-ckpt-"))
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
