from datetime import date

from quayside.contracts import contract, stamped
from quayside.operators.params import param_values
from quayside.plans.daily import load_day, load_next_day
from quayside.settings import new_path
from .conftest import bag

SCHEMA = contract("ITEM_KEY, EXEC_TS date, UPD_TS date, N int")
RAW = "ITEM_KEY string, EXEC_TS string, UPD_TS string, N string"


def test_two_days(spark, make):
    raw, summary = new_path(spark, "raw"), new_path(spark, "smy")
    source = make([(" a ", "01-OCT-23", "31-DEC-00", "1"), ("b", "01-OCT-23", "30-SEP-23", "x"),
                   ("c", "02-OCT-23", None, "3"), ("d", "03-OCT-23", None, "4")], RAW)
    params = make([("ETL_DATE", "20231001")], "MA_THAM_SO string, GIA_TRI string")
    for expected in ("20231002", "20231002"):
        params = load_next_day(source, raw, summary, SCHEMA, params, "20231002")
        assert param_values(params, ["ETL_DATE"]) == {"ETL_DATE": expected}
    read = lambda: bag(spark.read.schema(stamped(SCHEMA)).parquet(summary))
    none = date(1900, 12, 31)
    loaded = [
        ("a", date(2023, 10, 1), none, 1, 20231001),
        ("b", date(2023, 10, 1), date(2023, 9, 30), None, 20231001),
        ("c", date(2023, 10, 2), none, 3, 20231002),
    ]
    assert read() == loaded
    load_day(source, raw, summary, SCHEMA, "20231001")
    assert read() == loaded
    gone = source.filter("ITEM_KEY <> 'b'")
    load_day(gone, raw, summary, SCHEMA, "20231001")
    assert read() == [loaded[0], loaded[2]]
