import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fleetlens.session import get_spark
    extra = {}
    from pyspark.sql import SparkSession
    if SparkSession.getActiveSession() is None:
        # tests only: a private checkpoint folder when the environment names none
        import pyspark
        conf_dir = os.environ.get("SPARK_CONF_DIR")
        if not conf_dir:
            extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="fleetlens-test-ckpt-")
    s = get_spark("local[*]", app_name="fleetlens-tests", shuffle_partitions=8, extra=extra)
    yield s


@pytest.fixture(scope="session")
def smoke_dir():
    return SMOKE
