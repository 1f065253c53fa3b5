import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from proofmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    return local_session(
        cores="4", shuffle_partitions="4", app="proofmill-tests", settings={"spark.checkpoint.dir": shared, "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    )


@pytest.fixture
def value(spark):
    """Value of a column expression over one row."""
    return lambda column: spark.range(1).select(column.alias("x")).first()["x"]
