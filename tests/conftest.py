import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from patrolstat.session import RECOMMENDED_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[4]").appName("patrolstat-tests")
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="patrolstat-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return Path(tempfile.mkdtemp(prefix="patrolstat-test-", dir="/tmp"))
