import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartstream.session import tune  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").appName("cartstream-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(root / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
