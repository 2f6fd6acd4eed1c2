import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

AS_OF = "2024-01-31"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tierline.session import SESSION_DEFAULTS
    builder = (SparkSession.builder.master("local[4]").appName("tierline-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g"))
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tierline-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tierline-test-")
