import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnkit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", f"--conf spark.sql.warehouse.dir={warehouse} pyspark-shell")
    session = local_session(8, 4)
    yield session
    session.stop()


@pytest.fixture()
def rows(spark):
    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make
