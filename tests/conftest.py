import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeshelf.operators.tables import LAYERS, Lake  # noqa: E402
from lakeshelf.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "lakeshelf-tests",
        "local[4]",
        4,
        {
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def lake(spark, tmp_path):
    """Fresh layers below a temporary folder."""
    made = Lake(spark, str(tmp_path / "lake"), f"t{uuid.uuid4().hex[:8]}_")
    made.create_layers()
    yield made
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE {made.namespace}{layer} CASCADE")


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
