import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from riskloom import catalog as cat  # noqa: E402
from riskloom.session import build_session  # noqa: E402
from riskloom.sources.sample import sample_applications  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, "8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    return sample_applications(spark, SMALL).persist()


@pytest.fixture
def applications(spark):
    """Build raw rows from partial dicts; everything not given is NULL."""

    def make(*rows):
        names = cat.KEYED_SCHEMA.fieldNames()
        full = [tuple({cat.KEY: i, **r}.get(n) for n in names) for i, r in enumerate(rows)]
        return spark.createDataFrame(full, cat.KEYED_SCHEMA)

    return make
