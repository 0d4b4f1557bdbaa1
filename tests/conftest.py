import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from snapkeep.session import SQL_SETTINGS, ensure_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    b = (
        SparkSession.builder.master("local[*]")
        .appName("snapkeep-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
    )
    for k, v in SQL_SETTINGS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    # The folder named by spark.checkpoint.dir is used as is; only a session
    # without one gets a temporary folder (see ensure_checkpoint_dir).
    ensure_checkpoint_dir(s)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
