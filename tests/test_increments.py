"""Digests, compaction by size, file ledgers, deltas, rejects, registries, late rows and back-fill plans."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F, types as T

from .conftest import bag
from quayside.contracts import MOVES, untyped
from quayside.functions import today_key
from quayside.operators import dimension as dm, numbering, runlog
from quayside.operators.projection import conform, conform_rejects
from quayside.operators.slices import slice_digests
from quayside.plans import daily
from quayside.sources import readers as r, writers as w

ROWS = "k int, v string, x double, slice string"


def files(path):
    return {f: (os.path.getsize(f), os.path.getmtime(f)) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


# ---- digests ------------------------------------------------------------------------------------------


def digest(df):
    return {r["slice"]: tuple(r)[1:] for r in slice_digests(df, "slice").collect()}


def test_digests_are_of_bags(make):
    rows = [(1, "a", 0.5, "d"), (1, "a", 0.5, "d"), (2, None, None, "d"), (3, "", float("nan"), None)]
    base = digest(make(rows, ROWS))
    assert set(base) == {"d", None} and base["d"][0] == 3
    assert digest(make(rows[::-1], ROWS).repartition(3)) == base
    assert digest(make(rows, ROWS).select("x", "slice", "v", "k")) == base
    different = [
        rows[1:], rows + rows[:1],  # copies
        [(1, "a", 0.5, "d"), (1, "a", 0.5, "d"), (2, "", None, "d"), rows[3]],  # NULL is not ''
        [(1, "a", 0.5, "d"), (2, "a", 0.5, "d"), (2, None, None, "d"), rows[3]],
    ]
    for other in different:
        assert digest(make(other, ROWS))["d"] != base["d"]
    assert digest(make([(1, "a", None, "d")], ROWS)) != digest(make([(None, "a", 1.0, "d")], ROWS))
    # what moves from one column to the next is another row
    two = "p string, q string, slice string"
    assert digest(make([("a", None, "d")], two)) != digest(make([(None, "a", "d")], two))
    assert digest(make([(1, "a", 0.0, "d")], ROWS)) == digest(make([(1, "a", -0.0, "d")], ROWS))


def test_unchanged_slices_are_neither_read_nor_written(make, spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "digests")
    rows = [(k, "a", k / 2, f"d{k % 4}" if k % 5 else None) for k in range(40)]
    w.land_slices_by_digest(make(rows, ROWS), path, log, "slice")
    assert bag(spark.read.schema(make([], ROWS).schema).parquet(path)) == bag(make(rows, ROWS))
    # stored files may be unreadable: they are not looked at
    for f in glob.glob(f"{path}/slice=d1/*"):
        with open(f, "wb") as out:
            out.write(b"garbage")
    before = files(path)
    w.land_slices_by_digest(make(rows, ROWS).repartition(7), path, log, "slice")
    assert files(path) == before and spark.read.parquet(log).agg(F.max("version")).first()[0] == 1
    again = rows + [(1, "b", 1.0, "d2"), (99, "n", None, "d7")]
    w.land_slices_by_digest(make(again, ROWS), path, log, "slice")
    after = files(path)
    kept = {f for f in before if "slice=d2" not in f}
    assert kept == {f for f in after if "slice=d2" not in f and "slice=d7" not in f}
    assert bag(spark.read.parquet(f"{path}/slice=d2").select("k", "v")) == bag(
        make([x for x in again if x[3] == "d2"], ROWS).select("k", "v"))
    # only the days asked for, and back to what it was
    w.land_slices_by_digest(make(rows, ROWS), path, log, "slice", days=["d3", None])
    assert files(path) == after
    w.land_slices_by_digest(make(rows, ROWS), path, log, "slice", days=["d2"])
    assert len(spark.read.parquet(f"{path}/slice=d2").collect()) == sum(x[3] == "d2" for x in rows)


def test_a_load_that_failed_before_its_digests_is_repeated(make, spark, tmp_path, monkeypatch):
    path, log = str(tmp_path / "t"), str(tmp_path / "digests")

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(w, "_log_digests", fails)
        with pytest.raises(RuntimeError):
            w.land_slices_by_digest(make([(1, "a", 1.0, "d")], ROWS), path, log, "slice")
    w.land_slices_by_digest(make([(1, "a", 1.0, "d")], ROWS), path, log, "slice")
    assert spark.read.parquet(path).count() == 1 and spark.read.parquet(log).count() == 1


def test_adopted_tables(make, spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "digests")
    rows = make([(1, "a", 1.0, "d"), (2, "b", 1.0, "e")], ROWS)
    w.append_slices(rows, path, "slice")
    w.adopt_slices(spark.read.schema(rows.schema).parquet(path), log, "slice")
    before = files(path)
    w.land_slices_by_digest(rows, path, log, "slice")
    assert files(path) == before


# ---- slice folders --------------------------------------------------------------------------------------


@pytest.mark.parametrize("value", [None, "a/b", "x=1:2", "100%", "a b", "[q]^{z}", "ü"])
def test_folders_as_spark_names_them(make, spark, tmp_path, value):
    path, rows = str(tmp_path / "t"), make([(1, "a", 1.0, value), (2, "b", 1.0, "other")], ROWS)
    w.append_slices(rows, path, "slice")
    for _ in range(2):
        w.replace_slice(make([(5, "n", 2.0, value)], ROWS), path, "slice", value)
    assert bag(spark.read.schema(rows.schema).parquet(path).select("k", "slice")) == sorted(
        [(5, value), (2, "other")], key=repr)
    assert len([d for d in os.listdir(path) if d.startswith("slice=")]) == 2
    w.replace_slice(make([], ROWS), path, "slice", value)
    assert bag(spark.read.schema(rows.schema).parquet(path).select("k")) == [(2,)]


def test_folders_of_typed_slices(make, spark, tmp_path):
    for kind, value in (("date", dt.date(2024, 1, 2)), ("int", 20240102), ("boolean", True), ("timestamp_ntz", dt.datetime(2024, 1, 2, 3))):
        path, rows = str(tmp_path / kind), make([(1, value)], f"k int, slice {kind}")
        w.append_slices(rows, path, "slice")
        w.replace_slice(make([(2, value)], f"k int, slice {kind}"), path, "slice", value)
        assert bag(spark.read.schema(rows.schema).parquet(path)) == [(2, value)]


def test_scratch_files_go(make, spark, tmp_path):
    from quayside.settings import shared_dir

    where = f"{shared_dir(spark).removeprefix('file:')}/quayside"
    before = set(os.listdir(where)) if os.path.isdir(where) else set()
    rows = make([(1, "a", 1.0, "d")], ROWS)
    w.land_slices(rows, str(tmp_path / "t"), "slice")
    w.land_slices_by_digest(rows, str(tmp_path / "u"), str(tmp_path / "digests"), "slice")
    w.compact_partitions(spark, str(tmp_path / "t"), "slice")
    w.compact_by_size(spark, str(tmp_path / "t"), "slice")
    assert set(os.listdir(where)) == before


# ---- compaction -----------------------------------------------------------------------------------------


def test_compaction_by_size_settles(make, spark, tmp_path):
    path, r_ = str(tmp_path / "t"), random.Random(1)
    said = lambda n: "".join(r_.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    rows = [(k, said(200), k / 3, s) for s, n in (("big", 900), ("small", 30), (None, 60)) for k in range(n)]
    for part in range(10):
        w.append_slices(make(rows[part::10], ROWS), path, "slice")
    schema, target = make([], ROWS).schema, 60_000
    w.compact_by_size(spark, path, "slice", target)
    stored = spark.read.schema(schema).parquet(path)
    assert bag(stored) == bag(make(rows, ROWS))
    count = {x["slice"]: x["file_count"] for x in w.partition_stats(stored, "slice").collect()}
    assert 2 <= count["big"] < 10 and count["small"] == 1 and count[None] == 1
    before = files(path)
    for _ in range(2):
        w.compact_by_size(spark, path, "slice", target)
        assert files(path) == before
    # one more small file is not worth a rewrite of a slice whose others are large; two are
    w.append_slices(make([(1, "x", 1.0, "small")], ROWS), path, "slice")
    w.compact_by_size(spark, path, "slice", target)
    after = files(path)
    assert {f for f in after if "slice=big" in f} == {f for f in before if "slice=big" in f}
    assert sum("slice=small" in f for f in after) == 1


def test_bins_by_bytes(make):
    listed = make([("d", f"f{k}", 10, b) for k, b in enumerate([30, 30, 40, 90, 10, 49, 49, 2])], "slice string, file_path string, record_count long, bytes long")
    got = {x["file_path"]: x["bin"] for x in w.file_bins(listed, "slice", 100).collect()}
    assert got == {"f0": "small-0", "f1": "small-0", "f2": "small-0", "f3": "f3", "f4": "small-1", "f5": "small-1", "f6": "small-1", "f7": "small-2"}
    assert w.file_bins(make([("d", "a", 1, 60), ("d", "b", 1, 10), ("e", "c", 1, 10)], listed.schema), "slice", 100).isEmpty()


# ---- files taken once -------------------------------------------------------------------------------------


def test_ledger_of_files(make, spark, tmp_path):
    path = str(tmp_path / "in")
    ledger = spark.createDataFrame([], r.FILE)
    schema = make([], ROWS).schema
    os.makedirs(path)
    rows, same = r.read_new_files(spark, path, ledger, schema)
    assert rows.isEmpty() and same.isEmpty()
    w.append_slices(make([(1, "a", 1.0, "d1"), (2, "b", 1.0, None)], ROWS), path, "slice")
    rows, ledger = r.read_new_files(spark, path, ledger, schema)
    assert bag(rows.select("k", "slice")) == [(1, "d1"), (2, None)]
    ledger = spark.createDataFrame(ledger.collect(), ledger.schema)
    w.append_slices(make([(3, "late", 1.0, "d1")], ROWS), path, "slice")
    rows, ledger = r.read_new_files(spark, path, ledger, schema)
    assert bag(rows.select("k", "v", "slice")) == [(3, "late", "d1")]
    ledger = spark.createDataFrame(ledger.collect(), ledger.schema)
    assert r.read_new_files(spark, path, ledger, schema)[0].isEmpty()
    # a file that was replaced is a new one
    one = sorted(glob.glob(f"{path}/slice=d1/*.parquet"))[0]
    stat = os.stat(one)
    os.utime(one, (stat.st_atime, stat.st_mtime + 60))
    assert r.read_new_files(spark, path, ledger, schema)[0].count() == 1


# ---- stages -----------------------------------------------------------------------------------------------


def test_rejects_and_rows_add_up(make):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()),
                           T.StructField("d", T.DateType()), T.StructField("x", T.DecimalType(5, 2))])
    raw = [("a", " 1 ", "01-JAN-24", "1.5"), ("b", "x", "31-DEC-00", None), ("b", "", "soon", "9999999"),
           (None, None, None, None), ("c", "7", "32-JAN-24", "2"), ("b", "x", "31-DEC-00", None)]
    df = make(raw, "id string, n string, d string, x string")
    rows, rejects = conform_rejects(df, schema, ["id"])
    assert rows.schema.simpleString() == conform(df, schema).schema.simpleString()
    assert bag(rows) == bag(conform(df.filter("id = 'a' OR id IS NULL"), schema))
    assert bag(rejects.select("id", "reject_column", "reject_text")) == sorted([
        ("b", "n", "x"), ("b", "n", "x"), ("b", "n", ""), ("b", "d", "soon"), ("b", "x", "9999999"), ("c", "d", "32-JAN-24")], key=repr)
    assert rows.count() + rejects.select("reject_row").distinct().count() == len(raw)


def test_load_day_lands_copies(make, spark, tmp_path):
    row = {f.name: "x" for f in MOVES} | {"EXEC_TS": "31-AUG-23"}
    of = lambda n: spark.createDataFrame([row] * n, untyped(MOVES))
    paths = str(tmp_path / "raw"), str(tmp_path / "summary")
    for n in (1, 2, 1):  # one copy more, and one less, is a change
        daily.load_day(of(n), *paths, MOVES, "20230831")
        assert spark.read.parquet(paths[1]).count() == n


def test_today_of_a_moment(make):
    moments = make([(dt.datetime(2023, 12, 31, 17, 0),), (dt.datetime(2023, 12, 31, 16, 59, 59),), (None,)], "t timestamp_ntz")
    got = [x[0] for x in moments.select(today_key("Asia/Bangkok", F.col("t"))).collect()]
    assert got == ["20240101", "20231231", None]


# ---- key registry -----------------------------------------------------------------------------------------


def test_registry_keeps_ids(make):
    registry = make([("b", 1, 7)], "k string, j int, id bigint")
    rows = make([("c", 1), ("a", 1), ("a", 1), ("b", 1), ("b", 2), (None, 1), ("a", None)], "k string, j int")
    after = numbering.register_keys(registry, rows, ["k", "j"], "id")
    assert bag(after) == [("a", 1, 8), ("b", 1, 7), ("b", 2, 9), ("c", 1, 10)]
    assert bag(numbering.register_keys(after, rows.limit(0), ["k", "j"], "id")) == bag(after)
    empty = make([], "k string, j int, id bigint")
    assert bag(numbering.register_keys(empty, rows.filter("k = 'c'"), ["k", "j"], "id")) == [("c", 1, 1)]


# ---- late rows ----------------------------------------------------------------------------------------------

DIM = "ID long, k string, a string, b int, note string, TRANG_THAI_BG string, NGAY_HL_BG date, NGAY_HH_BG date"
OPEN = dt.date(2099, 1, 1)


def d(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def late(make, dim, rows):
    fed = make(rows, "k string, since date, a string, b int")
    return dm.apply_backdated(dim, fed, ["k"], "ID", ["a", "b"], "since")


def test_late_rows_cut_timelines(make):
    dim = make([
        (1, "p", "x", 1, "n1", "C", d(0), d(10)), (2, "p", "y", None, "n2", "A", d(10), OPEN),
        (3, "q", "x", 1, None, "C", d(0), d(5)),
        (4, "r", "x", 1, None, "A", d(0), OPEN), (5, None, "z", 1, None, "A", d(0), OPEN),
    ], DIM)
    got = late(make, dim, [
        ("p", d(4), "new", 2), ("p", d(10), "y", 5), ("p", d(-3), "x", 1),  # split, replace, merge in front
        ("q", d(8), "back", 1), ("q", d(3), "x", 1),  # in a gap, and no change
        ("s", d(1), None, None), (None, d(1), "x", 1), ("r", None, "x", 1),
    ])
    assert got.columns == dim.columns
    rows = bag(got.drop("ID"))
    assert rows == sorted([
        ("p", "x", 1, None, "C", d(-3), d(4)), ("p", "new", 2, None, "C", d(4), d(10)), ("p", "y", 5, None, "A", d(10), OPEN),
        ("q", "x", 1, None, "C", d(0), d(5)), ("q", "back", 1, None, "A", d(8), OPEN),
        ("r", "x", 1, None, "A", d(0), OPEN), ("s", None, None, None, "A", d(1), OPEN), (None, "z", 1, None, "A", d(0), OPEN),
    ], key=repr)
    ids = {(x["k"], x["NGAY_HL_BG"]): x["ID"] for x in got.collect()}
    assert ids["p", d(10)] == 2 and ids["q", d(0)] == 3 and ids["r", d(0)] == 4
    assert sorted(v for v in ids.values() if v > 5) == [6, 7, 8, 9] and len(set(ids.values())) == len(ids)


def test_late_rows_that_disagree(make):
    dim = make([(1, "p", "x", 1, None, "A", d(0), OPEN)], DIM)
    with pytest.raises(ValueError, match="disagree"):
        late(make, dim, [("p", d(4), "a", 2), ("p", d(4), "b", 2)])
    assert bag(late(make, dim, [])) == bag(dim)
    assert bag(late(make, dim, [("p", d(4), "x", 1), ("p", d(4), "x", 1)])) == bag(dim)


def test_timelines_against_a_day_by_day_model(make):
    """What is known of a key on each day, late rows applied to the days up to the next known change."""
    r_ = random.Random(6)
    rows, ident, days = [], 0, 40
    known, starts = {}, {}
    for key in "abcdefgh":
        at, known[key], starts[key] = r_.randrange(5), [None] * days, set()
        while at < days:
            end = min(days, at + r_.randint(1, 12))
            value = (r_.choice("xyz"), r_.choice([1, None]))
            last = end >= days
            ident += 1
            rows.append((ident, key, *value, None, "A" if last else "C", d(at), OPEN if last else d(end)))
            for t in range(at, end):
                known[key][t] = value
            starts[key] |= {at, end}
            at = end + r_.choice([0, 0, 3])
    fed = [(key, t, r_.choice("xyz"), r_.choice([1, None])) for key in "abcdef" for t in r_.sample(range(days), 4)]
    for key, t, a, b in fed:
        until = min([s for s in starts[key] | {u for k, u, *_ in fed if k == key} if s > t], default=days)
        for u in range(t, until):
            known[key][u] = (a, b)
    got = late(make, make(rows, DIM), [(k, d(t), a, b) for k, t, a, b in fed]).collect()
    seen = {key: [None] * days for key in known}
    for x in got:
        for t in range((x["NGAY_HL_BG"] - d(0)).days, min(days, (x["NGAY_HH_BG"] - d(0)).days)):
            assert seen[x["k"]][t] is None, "overlap"
            seen[x["k"]][t] = (x["a"], x["b"])
    assert seen == known
    touched = [x for x in got if x["k"] in "abcdef"]
    for x in touched:  # no equal neighbours
        assert not any(y["k"] == x["k"] and y["NGAY_HL_BG"] == x["NGAY_HH_BG"] and (y["a"], y["b"]) == (x["a"], x["b"]) for y in touched)
    assert len({x["ID"] for x in got}) == len(got)


# ---- back-fill plan -------------------------------------------------------------------------------------------


def test_due_days(make):
    t = lambda day, hour: dt.datetime(2024, 1, day, hour)
    runs = [("j", t(1, 1), t(1, 2), "S"), ("j", t(2, 1), t(2, 2), "F"), ("j", t(2, 3), t(2, 4), "S"),  # repaired
            ("j", t(3, 1), t(3, 2), "S"), ("j", t(3, 3), t(3, 4), "F"), ("j", t(4, 1), t(4, 2), "F"),
            ("j", t(7, 1), t(7, 2), ""), ("j", t(8, 1), t(8, 2), "Q"), ("i", t(20, 1), t(20, 2), "S")]
    log = make(runs, "JOB_NAME string, TIME_START timestamp_ntz, TIME_FINISH timestamp_ntz, STATUS_JOB string")
    assert bag(runlog.due_days(log, "20240101", "20240109")) == sorted([
        ("j", "failed", "20240103", "20240104", 2), ("j", "missing", "20240105", "20240106", 2),
        ("j", "open", "20240107", "20240108", 2), ("j", "missing", "20240109", "20240109", 1),
        ("i", "missing", "20240101", "20240109", 9)], key=repr)
    assert runlog.due_days(log.limit(0), "20240101", "20240109").isEmpty()
