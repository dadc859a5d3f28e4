from datetime import date

import pytest
from pyspark.sql import functions as F

from quayside.operators import dimension as dm
from quayside.operators.facts import DimensionKey, fact_surrogate_lookup
from quayside.plans.dimensions import EQUIPMENT, DimensionSpec, load_dimension
from .conftest import bag

SPEC1 = DimensionSpec(("k",), ("v",))
SPEC2 = DimensionSpec(("k",), ("v",), scd_type=2)


@pytest.fixture
def dim(make):
    opened, end = date(2020, 1, 1), date(2099, 1, 1)
    rows = [(1, "k1", "a"), (2, "k2", "b"), (3, "k3", "c"), (4, "k5", None), (5, "k6", "5")]
    rows = [(*r, "A", opened, end) for r in rows]
    rows.append((6, "k1", "old", "C", date(2019, 1, 1), opened))
    return make(rows, "ID bigint, k string, v string, TRANG_THAI_BG string, NGAY_HL_BG date, NGAY_HH_BG date")


@pytest.fixture
def feed(make):
    return make([("k1", "a"), ("k2", "B"), ("k4", "d"), (None, "z"), ("k5", None), ("k6", None),
                 ("k4", "d")], "k string, v string")


def test_split(dim, feed):
    stored = dm.current_rows(dim)
    changes = dm.split_changes(stored, feed, ["k"], "ID", ["v"], deletes=True)
    assert bag(changes) == sorted(
        [("I", None, "k4", "d"), ("U", 2, "k2", "B"), ("D", 3, "k3", "c"), ("U", 5, "k6", None)], key=repr
    )
    everything = dm.split_changes(stored, feed, ["k"], "ID", ["v"], deletes=True, keep_unchanged=True)
    kinds = {r["_change"]: r["n"] for r in everything.groupBy("_change").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"I": 1, "U": 2, "D": 1, "=": 2}
    copies = dm.split_changes(stored, feed, ["k"], "ID", ["v"], drop_duplicates=False)
    assert dm.of_kind(copies, "I").count() == 2


def test_type1(dim, feed):
    once = load_dimension(dm.current_rows(dim), feed, SPEC1, "2024-05-01")
    assert {(r.ID, r.k, r.v) for r in once.collect()} == {
        (1, "k1", "a"), (2, "k2", "B"), (3, "k3", "c"), (4, "k5", None), (5, "k6", None), (6, "k4", "d")
    }
    assert bag(load_dimension(once, feed, SPEC1, "2024-05-02")) == bag(once)


def test_type2(dim, feed):
    once = load_dimension(dim, feed, SPEC2, "2024-05-01")
    day, opened, end = date(2024, 5, 1), date(2020, 1, 1), date(2099, 1, 1)
    assert bag(once) == sorted([
        (1, "k1", "a", "A", opened, end), (4, "k5", None, "A", opened, end),
        (2, "k2", "b", "C", opened, day), (3, "k3", "c", "C", opened, day),
        (5, "k6", "5", "C", opened, day),
        (6, "k1", "old", "C", date(2019, 1, 1), opened),
        (7, "k2", "B", "A", day, end), (8, "k4", "d", "A", day, end), (9, "k6", None, "A", day, end),
    ], key=repr)
    assert bag(load_dimension(once, feed, SPEC2, "2024-05-01")) == bag(once)
    assert dm.current_rows(once).groupBy("k").count().filter("count > 1").count() == 0


def test_conflicting_feed_rows_are_an_error(dim, make):
    feed = make([("k1", "x"), ("k1", "y"), ("k9", "p"), ("k9", "q")], "k string, v string")
    with pytest.raises(ValueError, match="disagree"):
        load_dimension(dim, feed, SPEC2, "2024-05-01")
    copies = make([("k1", "y"), ("k1", "y"), ("k9", "q")], "k string, v string")
    loaded = load_dimension(dim, copies, SPEC2, "2024-05-01")
    assert bag(dm.current_rows(loaded).select("k", "v")) == [("k1", "y"), ("k9", "q")]
    stamped = make([("k1", "x", 2), ("k1", "y", 1)], "k string, v string, at int")
    latest = load_dimension(dim, stamped, DimensionSpec(("k",), ("v",), scd_type=2, latest_by=("at",)),
                            "2024-05-01")
    assert bag(dm.current_rows(latest).select("k", "v")) == [("k1", "x")]


def test_composite_keys(make):
    dim = make([(1, "a", "x", 1), (2, "a", "y", 2)], "ID bigint, k string, l string, v int")
    feed = make([("a", "x", 1), ("a", "y", 3), ("b", "x", 4), ("b", None, 5)], "k string, l string, v int")
    changes = dm.split_changes(dim, feed, ["k", "l"], "ID", ["v"])
    assert bag(changes) == sorted([("U", 2, "a", "y", 3), ("I", None, "b", "x", 4)], key=repr)


def test_equipment_windows_are_kept(make):
    feed = make([("C1", f"2024-0{m}-01", "X", "Y", f"2024-0{m + 1}-01") for m in (1, 3, 5)],
                "CHE_ID string, AS_AT_TS string, COMPANY string, MANAGE_BY string, EXPIRY_TS string")
    empty = feed.limit(0).selectExpr("cast(1 as bigint) ID", "CHE_ID", "AS_AT_TS", "COMPANY", "MANAGE_BY", "EXPIRY_TS")
    assert load_dimension(empty, feed, EQUIPMENT, "2024-06-01").count() == 3


def test_fact_takes_the_current_version(make):
    dim = make([(1, "a", "C"), (7, "a", "A")], "ID bigint, k string, TRANG_THAI_BG string")
    loaded = fact_surrogate_lookup(
        make([("a", 5)], "k string, q int"), [DimensionKey(dim, [("k", "k")], "ID", "DIM_ID")], [], [("sum", "q", "Q")])
    assert [(r["DIM_ID"], r["Q"]) for r in loaded.collect()] == [(7, 5)]


def test_fact_counts_once_per_key(make):
    facts = make([("a", 1), ("a", 2), ("b", 4), (None, 8)], "k string, q int")
    dim = make([(10, "a"), (11, "a"), (12, None)], "ID bigint, k string")
    loaded = fact_surrogate_lookup(
        facts, [DimensionKey(dim, [("k", "k")], "ID", "DIM_ID")], [], [("sum", "q", "Q"), ("max", "q", "M")]
    )
    assert bag(loaded) == [(-1, 12, 8), (10, 3, 2)]
    with pytest.raises(ValueError):
        fact_surrogate_lookup(facts, [], [], [("avg", "q", "Q")])
