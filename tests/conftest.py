import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from admere.session import local_session

    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(4, 4, **{"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield session
    session.stop()
