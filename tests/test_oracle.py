"""Every registered query against its DuckDB oracle (small scale; the driver runs sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
import check_oracle as C  # noqa: E402

from navlib.plans.oracles import ORACLES  # noqa: E402
from navlib.plans.registry import QUERIES  # noqa: E402

SF = os.environ.get("NAVLIB_ORACLE_SF", "/root/testdata/sf0.001")
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return C.duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    line = C.compare(name, spark, con, SF, E.queries(), E.oracle_sql())
    assert line.startswith("OK"), line


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "rank" in df.columns and df.count() == 10
