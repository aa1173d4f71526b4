import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tallgrass.session import apply_session_settings

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_session_settings(s)
    yield s


@pytest.fixture(scope="session")
def src(spark):
    from tallgrass.sources.catalog import catalog
    return catalog(spark, SF_SMALL)


@pytest.fixture(scope="session")
def cfg():
    from tallgrass.config import harness_config
    return harness_config()


@pytest.fixture()
def scratch(spark, tmp_path_factory):
    """A fresh folder under the session's shared checkpoint dir."""
    import uuid

    from tallgrass.session import scratch_root
    return f"{scratch_root(spark)}/tests/{uuid.uuid4().hex}"
