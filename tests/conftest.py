import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from quillstone.runtime import session

    s = session("local[4]", 4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no test data")
    return str(folder)
