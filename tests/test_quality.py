import random

import pytest

import navlib as nl
from tests.helpers import day

MASTER = "scheme_code string, scheme_name string, fund_house string"


def brute_similar_pairs(rows):
    """All unordered scheme pairs per house as the report defines them."""
    out = 0
    by_house = {}
    for code, name, house in rows:
        by_house.setdefault(house, []).append(name.lower().replace(" ", "").replace("-", ""))
    for names in by_house.values():
        for i in range(len(names)):
            for j in range(i + 1, len(names)):
                a, b = names[i], names[j]
                if (a in b or b in a) and abs(len(a) - len(b)) <= 3:
                    out += 1
    return out


def test_similar_names_equals_brute_force(spark):
    rng = random.Random(11)
    alphabet = "ab -"
    rows = []
    for i in range(300):
        name = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7)))
        rows.append((str(i), name, rng.choice(["H1", "H2", "H3"])))
    df = spark.createDataFrame(rows, MASTER)
    got = nl.similar_names(df).agg({"pair_count": "sum"}).collect()[0][0]
    assert got == brute_similar_pairs(rows)


def test_similar_names_identical_group_is_one_row(spark):
    rows = [(str(i), "Alpha Fund", "H") for i in range(50)] + [("x", "Alpha-Fund X", "H"), ("y", "Beta", "H")]
    out = nl.similar_names(spark.createDataFrame(rows, MASTER)).collect()
    by = {(r.name_norm_1, r.name_norm_2): r for r in out}
    assert by[("alphafund", "alphafund")].pair_count == 50 * 49 // 2
    assert by[("alphafund", "alphafundx")].pair_count == 50
    assert len(out) == 2
    members = nl.similar_name_members(spark.createDataFrame(rows, MASTER))
    assert members.count() == 51


def test_duplicate_codes_and_names(spark):
    rows = [("1", "A", "H"), ("1", "B", "H"), ("2", "A", "H"), ("3", "C", "G")]
    df = spark.createDataFrame(rows, MASTER)
    codes = sorted((r.scheme_code, r["count"], r.scheme_name) for r in nl.duplicate_codes(df).collect())
    assert codes == [("1", 2, "A"), ("1", 2, "B")]
    names = sorted((r.scheme_name, r["count"], r.scheme_code) for r in nl.duplicate_names(df).collect())
    assert names == [("A", 2, "1"), ("A", 2, "2")]
    s = nl.duplicate_summary(df).collect()[0]
    # 1 duplicate code + 1 similar pair (A,A in H; also A⊂... only identical A) + 1 duplicate name
    assert s.total_schemes_analyzed == 4
    assert s.total_potential_duplicates == 1 + brute_similar_pairs(rows) + 1
    assert s.status == "needs_review"


def test_quality_checks_on_hand_frame(spark):
    rows = [
        ("1", "a", 10.0, day(0)),
        ("1", "a", 10.0, day(0)),  # duplicate key
        ("X2", None, -1.0, day(1)),  # bad code, null name, invalid nav
        (None, "c", 20000.0, day(2)),  # null code (not a format error), invalid nav
        ("3", "d", None, None),
    ]
    df = spark.createDataFrame(rows, "scheme_code string, scheme_name string, nav double, date date")
    nulls = {r.column_name: r.null_count for r in nl.dq_null_checks(df).collect()}
    assert nulls == {"scheme_code": 1, "scheme_name": 1, "nav": 1, "date": 1}
    assert nl.dq_invalid_nav(df).collect()[0]["count"] == 2
    assert nl.dq_duplicates(df).collect()[0].record_count == 2
    assert nl.dq_code_format(df).collect()[0].invalid_format_count == 1
    o = nl.dq_overall(df).collect()[0]
    assert o.total_issues == 4 + 2 + 1 + 1 and o.total_records == 5
    assert o.score == 0.0 and o.status == "needs_attention"
    dates = nl.dq_date_consistency(df).collect()[0]
    assert dates.unique_dates == 3


def test_nav_summary_freshness(spark):
    rows = [("1", "a", "H", day(0), 1.005), ("2", "b", "G", day(3), 3.0)]
    df = spark.createDataFrame(rows, "scheme_code string, scheme_name string, fund_house string, date date, nav double")
    s = nl.nav_summary(df, day(4)).collect()[0]
    assert s.data_freshness == "Current" and s.total_fund_houses == 2
    assert nl.nav_summary(df, day(5)).collect()[0].data_freshness == "Stale"
    assert s.min_nav == 1.0  # 1.005 is just below the half in binary


def test_lookups(spark):
    rows = [("2", "Alpha Equity", "Big House"), ("1", "beta debt", "Small"), ("3", "Gamma", "big house")]
    m = spark.createDataFrame(rows, MASTER)
    assert [r.scheme_code for r in nl.search_schemes(m, "big", limit=5).collect()] == ["2", "3"]
    assert [r.scheme_code for r in nl.schemes_by_category(m, "EQUITY").collect()] == ["2"]
    assert [r.fund_house for r in nl.fund_houses(m).collect()] == ["Big House", "Small", "big house"]
    with pytest.raises(Exception):
        nl.search_schemes(m, "(unclosed").collect()
