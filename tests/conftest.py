import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import local_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def root():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def wide_file(tmp_path_factory):
    """Three places over five days, as a wide CSV with a saved row index."""
    path = tmp_path_factory.mktemp("wide") / "panel.csv"
    path.write_text(
        "Unnamed: 0,Province/State,Country/Region,Lat,Long,1/30/20,1/31/20,2/1/20,2/2/20,2/3/20\n"
        "0,,A,10,20,1,3,6,10,15\n"
        "1,X,B,0,0,0,0,2,2,5\n"
        "2,Y,B,48,2,5,5,5,6,6\n"
    )
    return str(path)


@pytest.fixture
def panel(spark, wide_file):
    """The same places as a long panel."""
    from tidemark.functions.places import LONG_NAMES
    from tidemark.operators.reshape import days_to_long
    from tidemark.sources.wide_csv import read_wide

    return days_to_long(read_wide(spark, wide_file), list(LONG_NAMES)).withColumnsRenamed(LONG_NAMES)
