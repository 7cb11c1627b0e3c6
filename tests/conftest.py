import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from martloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tiny inputs: compiling a stage costs more than running it.
    conf = {"spark.driver.memory": "8g", "spark.sql.codegen.wholeStage": "false"}
    session = build_session("tests", "local[8]", 4, conf)
    yield session
    session.stop()
