import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from check import session

    spark = session(4)
    # Results must not depend on the zone of the session.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.stop()


@pytest.fixture
def rows():
    """Rows of a frame as plain tuples, sorted."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
