from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quayside import functions as fn
from quayside.contracts import MOVES, REPORT, STAGE_TABLES, contract, stamped, untyped
from quayside.operators import projection as p


def column(make, values, expression, kind="string"):
    df = make([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_sentinel_dates(make):
    landed = ["31-AUG-23", "31-DEC-00", None, "01-jan-70", "garbage"]
    missing = date(1900, 12, 31)
    assert column(make, landed, fn.conform_date) == [
        date(2023, 8, 31), missing, missing, date(2070, 1, 1), missing
    ]


def test_source_dates_are_read_as_the_formatter_reads_them(make):
    months = "JAN Feb mar APR MAY jun JUL AUG SEP OCT NOV dec Sept JA XXX ANF".split()
    texts = [f"{d:02d}-{m}-{y:02d}" for d in (0, 1, 9, 28, 29, 30, 31, 32) for m in months for y in (0, 23, 24, 99)]
    texts += ["", " ", "1-JAN-20", "01-JAN-2020", "01-JAN-20 ", " 01-JAN-20", "01-JAN-20\n", "01/JAN/20", "01-JAN-2", "1 -JAN-20",
              "1T-JAN-20", "+1-JAN-20", "01-JAN-+1", "01-JAN--1", "\u0661\u0661-JAN-20", "01-\u017fep-20", "01--JAN-20", None]
    rows = make([(t,) for t in texts], "t string").select(
        fn.slice_date(F.col("t")).alias("got"), F.try_to_date("t", "dd-MMM-yy").alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows] and sum(r.got is not None for r in rows) > 200


def test_slice_keys_are_spelled_as_the_formatter_spells_them(spark):
    days = spark.range(-1_200_000, 1_200_000, 997).select(F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    spelled = F.upper(F.date_format("d", "dd-MMM-yy"))
    assert days.filter(~fn.slice_key(F.col("d")).eqNullSafe(spelled)).isEmpty()


def test_conform_stays_within_what_the_jvm_compiles(make):
    names = [f"c{i}" for i in range(60)]
    raw = make([tuple("05-FEB-24" for _ in names)], ", ".join(f"{n} string" for n in names))
    typed = p.conform(raw, contract(", ".join(f"{n} date" if i % 2 else n for i, n in enumerate(names))))
    parts = typed._jdf.queryExecution().debug().codegenToSeq()
    assert all(parts.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(parts.size()))
    assert [*typed.first()] == [date(2024, 2, 5) if i % 2 else "05-FEB-24" for i in range(60)]


def test_conform_takes_columns_named_like_its_own(make):
    raw = make([("05-FEB-24", "x", "05-MAR-24")], "_dates string, _dates_ string, d string")
    typed = p.conform(raw, contract("d date, _dates date, _dates_"))
    assert [*typed.first()] == [date(2024, 3, 5), date(2024, 2, 5), "x"]


def test_trim_takes_spaces_only(make):
    df = make([(" a ", 1), (" a\t ", 2), (" ", 3), (None, 4)], "s string, n int")
    assert [r.s for r in p.trim_all_strings(df).orderBy("n").collect()] == ["a", "a\t", "", None]


def test_conform_types_dates_and_order(make):
    raw = make([(" 1 ", "05-FEB-24", " x"), ("a1", "nope", None), (None, None, "y ")],
               "n string, d string, s string")
    typed = p.conform(raw, contract("s, n int, d date"))
    assert typed.dtypes == [("s", "string"), ("n", "int"), ("d", "date")]
    missing = date(1900, 12, 31)
    assert [tuple(r) for r in typed.collect()] == [
        ("x", 1, date(2024, 2, 5)), (None, None, missing), ("y", None, missing)
    ]


def test_conform_keeps_dates_that_are_dates(make):
    typed = p.conform(make([(date(2020, 1, 1),), (None,)], "d date"), contract("d date"))
    assert [r.d for r in typed.collect()] == [date(2020, 1, 1), date(1900, 12, 31)]


def test_keys_of_a_day(make):
    days = [date(2024, 1, 5), None]
    assert column(make, days, fn.slice_key, "date") == ["05-JAN-24", None]
    assert column(make, days, fn.date_to_key, "date") == [20240105, None]
    assert column(make, days, fn.date_to_day_of_year_key, "date") == [2024005, None]
    assert column(make, ["20231231", "x"], fn.next_day_key) == ["20240101", None]
    assert column(make, [20240229, 20230229], fn.key_to_date, "int") == [date(2024, 2, 29), None]


def test_parse_date(make):
    spelled = ["20240831", "2024-08-31", "08/31/2024", "31-AUG-24", "?", None]
    day = date(2024, 8, 31)
    assert column(make, spelled, fn.parse_date) == [day, day, day, day, None, None]
    with pytest.raises(Exception, match="not a date"):
        column(make, ["?"], lambda c: fn.parse_date(c, strict=True))
    assert column(make, [None], lambda c: fn.parse_date(c, strict=True)) == [None]


def test_epoch_does_not_depend_on_the_session_zone(spark, make):
    at = [datetime(2024, 1, 1, 7, 0, 0, 500)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert column(make, at, fn.epoch, "timestamp_ntz") == [1704067200000]
            assert column(make, at, lambda c: fn.epoch(c, millis=False), "timestamp_ntz") == [1704067200]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_today_key(spark):
    key = spark.range(1).select(fn.today_key()).first()[0]
    assert len(key) == 8 and key.isdigit()


def test_text(make):
    assert column(make, ["a'b\"c", None], fn.sanitize) == ["abc", None]
    assert column(make, ["[x]"], lambda c: fn.remove_symbols(c, r"\[\]", "|")) == ["|x|"]
    assert column(make, ["a.b"], lambda c: fn.replace_pairs(c, [(".", "a"), ("a", "z")])) == ["zzb"]
    assert column(make, ["x", None], fn.null_to_blank) == ["x", " "]


def test_flags(make):
    assert column(make, ["45R1", "4531", "45G1", "", None], fn.is_reefer) == ["Y", "Y", " ", " ", " "]
    assert column(make, ["k", None], fn.presence_flag) == ["Y", " "]
    assert column(make, ["b", None], lambda c: fn.either(c == "b", F.lit(1), F.lit(2))) == [1, 2]
    first = lambda c: fn.first_match([(c > 1, "one"), (c > 0, "zero")])
    assert column(make, [2, 1, 0, None], first, "int") == ["one", "zero", " ", " "]


def test_concat_propagates_null(make):
    df = make([("a", None, "b"), ("a", "-", "b")], "x string, y string, z string")
    assert [r[0] for r in df.select(F.concat("x", "y", "z")).collect()] == [None, "a-b"]


def test_not_in_drops_null(make):
    df = make([(None,), ("X",), ("TOP",)], "c string")
    assert [r.c for r in df.filter(~F.col("c").isin("TOP")).collect()] == ["X"]


def test_one_per_key(make):
    df = make([("a", 1, "x"), ("a", 2, None), ("b", 1, "y"), ("b", 1, "z")], "k string, at int, v string")
    latest = p.one_per_key(df, ["k"], latest_by=["at"])
    assert sorted(tuple(r) for r in latest.collect()) == [("a", 2, None), ("b", 1, "z")]
    assert p.one_per_key(df.select("k"), ["k"]).count() == 2


def test_projection(make):
    df = make([(1, "a")], "n int, s string")
    assert p.rename_with_suffix(df, "m").columns == ["n_m", "s_m"]
    assert p.rename_by_pairs(df, ["n"], ["m"]).columns == ["m", "s"]
    assert p.align(df, df.select("s", "n")).columns == ["s", "n"]
    assert p.select_by_pattern(df, "^n", exclude=True).columns == ["s"]
    assert p.stamp(df, d=20231001).first().d == 20231001
    later = p.transform_exprs(df, [("m", "n * 2"), ("o", "m + 1"), ("q", "'*'")]).first()
    assert (later.m, later.o, later.q) == (2, 3, "*")


def test_contracts():
    assert len(MOVES) == 39 and len(REPORT) == 37 and len(STAGE_TABLES) == 9
    assert stamped(MOVES).names[-1] == "ETL_DATE"
    assert {f.dataType.simpleString() for f in untyped(MOVES).fields} == {"string"}
