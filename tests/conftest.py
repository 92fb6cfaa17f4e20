import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from cadenza.catalog import Catalog  # noqa: E402
from cadenza.schemas import TABLES, schema  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cadenza.session import build_session

    s = build_session("local[4]", app_name="cadenza-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def make_catalog(spark):
    """Catalog from inline rows; tables not given are empty."""

    def build(**rows) -> Catalog:
        unknown = set(rows) - set(TABLES)
        assert not unknown, unknown
        return Catalog({t: spark.createDataFrame(rows.get(t, []), schema(t)) for t in TABLES})

    return build


@pytest.fixture(scope="session")
def small_catalog(spark):
    from cadenza.sources.testdata import from_testdata

    return from_testdata(spark, SF_SMALL)
