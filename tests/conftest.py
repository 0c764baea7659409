import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from bibspark.session import clear_work_folder, get_session

    session = get_session(
        "tests", "local[8]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false", spark__driver__memory="8g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_work_folder(session)
    session.stop()
