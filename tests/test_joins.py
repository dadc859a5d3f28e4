from datetime import date, timedelta
import random

import pytest
from pyspark.sql import functions as F

from quayside.operators import joins as j
from .conftest import bag


def d(n):
    return date(2024, 1, 1) + timedelta(n)


@pytest.fixture
def windows(make):
    return make([("C1", d(1), d(5), "a"), ("C1", d(5), d(9), "b"), (" ", d(0), d(99), "blank")],
                "key string, start date, end date, v string")


def test_validity_windows_touch_overlap_and_miss(make, windows):
    facts = make([("C1", d(0)), ("C1", d(1)), ("C1", d(5)), ("C1", d(9)), ("C1", d(10)),
                  (" ", d(5)), (None, d(5))], "key string, at date")
    joined = j.validity_join(
        facts, windows.filter("key <> ' '"), [("key", "key")], "at", ("start", "end"), ["v"], "w"
    )
    assert bag(joined) == sorted([
        ("C1", d(0), None), ("C1", d(1), "a"), ("C1", d(5), "a"), ("C1", d(5), "b"),
        ("C1", d(9), "b"), ("C1", d(10), None), (" ", d(5), None), (None, d(5), None),
    ], key=repr)


@pytest.mark.parametrize("buckets", [
    j.Buckets(7, "2024-01-01", "2024-03-01"),
    j.Buckets(1, "2024-01-20", "2024-01-25"),
    j.Buckets(400, "2024-01-01", "2024-01-02"),
])
def test_buckets_change_nothing(make, buckets):
    rng = random.Random(7)
    facts = make([(f"k{rng.randrange(4)}", d(rng.randrange(-20, 120)), i) for i in range(300)],
                 "key string, at date, n int")
    spans = [(rng.randrange(-30, 110), rng.randrange(0, 40)) for _ in range(60)]
    rows = [(f"k{rng.randrange(4)}", d(a), d(a + n), f"w{i}") for i, (a, n) in enumerate(spans)]
    rows += [("k1", d(9), d(3), "reversed"), ("k1", None, d(3), "open"), ("k2", d(0), date(2099, 1, 1), "on")]
    windows = make(rows, "key string, start date, end date, v string")
    args = (facts, windows, [("key", "key")], "at", ("start", "end"), ["v"], "w")
    assert bag(j.validity_join(*args, buckets=buckets)) == bag(j.validity_join(*args))


def test_left_guard_keeps_the_row(make, windows):
    facts = make([("C1", d(1), "x"), ("C1", d(1), "y")], "key string, at date, kind string")
    joined = j.validity_join(facts, windows, [("key", "key")], "at", ("start", "end"), ["v"], "w",
                             when=F.col("src.kind") == "x")
    assert bag(joined) == [("C1", d(1), "x", "a"), ("C1", d(1), "y", None)]


def test_roles_fill_their_own_side_only(make, windows):
    facts = make([("ON", "C1", "C1"), ("OFF", "C1", "C1"), ("NONE", "C1", "C1"), (None, "C1", "C1")],
                 "role string, fr string, to string").withColumn("at", F.lit(d(2)))
    joined = j.validity_join_by_role(
        facts, windows, "role", {"ON": ("fr", "from"), "OFF": ("to", "to")}, "key", "at",
        ("start", "end"), ["v"],
    )
    assert {(r.role, r.v_from, r.v_to) for r in joined.collect()} == {
        ("ON", "a", None), ("OFF", None, "a"), ("NONE", None, None), (None, None, None)
    }


def test_roles_equal_one_join_per_role(make):
    rng = random.Random(3)
    facts = make([(rng.choice(["ON", "OFF", "X"]), f"s{rng.randrange(5)}", f"s{rng.randrange(5)}",
                   d(rng.randrange(50)), i) for i in range(200)],
                 "role string, fr string, to string, at date, n int")
    windows = make([(f"s{rng.randrange(5)}", d(a), d(a + 20), f"w{a}") for a in range(0, 50, 3)],
                   "key string, start date, end date, v string")
    once = j.validity_join_by_role(
        facts, windows, "role", {"ON": ("fr", "from"), "OFF": ("to", "to")}, "key", "at",
        ("start", "end"), ["v"],
    )
    twice = facts
    for role, (column, suffix) in {"ON": ("fr", "from"), "OFF": ("to", "to")}.items():
        twice = j.validity_join(twice, windows, [(column, "key")], "at", ("start", "end"), ["v"],
                                suffix, when=F.col("src.role") == role)
    assert bag(once) == bag(twice)


def test_duplicate_lookup_keys(make):
    src = make([("k",), ("n",), (None,)], "key string")
    keys = make([("k",), ("k",), (None,)], "key string")
    faithful = j.flag_exists(src, keys, [("key", "key")], "flag")
    assert bag(faithful) == sorted([("k", "Y"), ("k", "Y"), ("n", " "), (None, " ")], key=repr)
    once = j.flag_exists(src, keys, [("key", "key")], "flag", unique=True)
    assert bag(once) == sorted([("k", "Y"), ("n", " "), (None, " ")], key=repr)


def test_unique_lookup_is_deterministic(make):
    src = make([("k",)], "key string")
    lookup = make([("k", "b"), ("k", "a")], "key string, v string")
    assert bag(j.enrich(src, lookup, [("key", "key")], ["v"], "l", unique=True)) == [("k", "b")]


def test_existence(make):
    src, other = make([("k", 1), ("n", 2)], "key string, n int"), make([("k",), ("k",)], "code string")
    assert j.existence_join(src, other, [("key", "code")]).count() == 2
    assert bag(j.existence_join(src, other, [("key", "code")], once=True)) == [("k", 1)]


def test_full_outer_equals_the_built_in(make):
    left = make([("a", "x", 1), ("a", "x", 2), ("b", "x", 3), (None, "x", 4), ("c", None, 5)],
                "k string, l string, n int")
    right = make([("a", "x", 6), ("a", "x", 7), ("d", "x", 8), (None, "x", 9), ("c", None, 10)],
                 "k string, l string, m int")
    mine = j.full_outer(left, right, [("k", "k"), ("l", "l")], "r")
    renamed = right.toDF("k_r", "l_r", "m_r")
    built_in = left.join(renamed, (left.k == renamed.k_r) & (left.l == renamed.l_r), "full")
    assert mine.columns == built_in.columns and bag(mine) == bag(built_in)
    assert mine.count() == 4 + 3 + 3


def test_chain_uses_earlier_columns(make):
    src = make([("a",), ("z",)], "k string")
    first = make([("a", "x")], "k string, v string")
    second = make([("x", "found", "on"), ("x", "hidden", "off")], "v string, w string, state string")
    chained = j.enrich_chain(src, [
        j.Lookup(first, [("k", "k")], ["v"], "one"),
        j.Lookup(second, [("v_one", "v")], ["w"], "two", where=F.col("state") == "on"),
    ])
    assert bag(chained) == sorted([("a", "x", "found"), ("z", None, None)], key=repr)


def test_lookup_taken_from_the_source_itself(make):
    df = make([("a", 1), ("a", 2), ("b", 3)], "k string, n int")
    joined = j.enrich(df, df, [("k", "k")], ["n"], "max", unique=True)
    assert bag(joined) == [("a", 1, 2), ("a", 2, 2), ("b", 3, 3)]
    assert j.full_outer(df, df, [("k", "k")], "r").count() == 5
    assert j.without_keys_of(df, df.filter("n = 3"), [("k", "k")]).count() == 2
