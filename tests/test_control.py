from datetime import datetime

from pyspark.sql import functions as F

from quayside.operators import params as pm, runlog
from quayside.operators.aggregate import count_rows, group_by_filter
from .conftest import bag

LOG = ("DAG_ID string, JOB_NAME string, TIME_START timestamp_ntz, TIME_FINISH timestamp_ntz, "
       "STATUS_JOB string, STATUS_FINISH string, ERROR_MESSAGE string, JOB_TYPE string")


def run(dag, state, minute, error=""):
    at = datetime(2024, 1, 1, 10, minute)
    return (dag, "job", at, at, state, "1", error, "SERIAL")


def test_padded_parameters_are_found(make):
    params = make([(" ETL_DATE ", " 20231001 "), ("OTHER", "x")], "MA_THAM_SO string, GIA_TRI string")
    assert pm.param_values(params, ["ETL_DATE", "ABSENT"]) == {"ETL_DATE": "20231001"}


def test_watermark_stops_at_its_end(make):
    params = make([("ETL_DATE", "20231001"), ("OTHER", "20231001")], "MA_THAM_SO string, GIA_TRI string")
    once = pm.advance_watermark(params, "20231002")
    assert pm.param_values(once, ["ETL_DATE", "OTHER"]) == {"ETL_DATE": "20231002", "OTHER": "20231001"}
    twice = pm.advance_watermark(once, "20231002")
    assert pm.param_values(twice, ["ETL_DATE"]) == {"ETL_DATE": "20231002"}


def test_run_log(make):
    log = make([run("a", "Q", 1), run("b", "S", 2)], LOG)
    log = runlog.run_log_append(log, make([run("a", "F", 3, "it's \"bad\"")], LOG))
    latest = {r.DAG_ID: (r.STATUS_JOB, r.ERROR_MESSAGE) for r in runlog.run_log_latest(log).collect()}
    assert latest == {"a": ("F", "its bad"), "b": ("S", "")}


def test_outcome(make):
    rows = [run("ok", "S", 1), run("ok", "S", 2), run("on", "S", 1), run("on", "", 2),
            run("ko", "S", 1), run("ko", "F", 2), run("ko", "", 3), run("ok", "F", 0)]
    outcome = runlog.run_outcome(make(rows, LOG), "2024-01-01 10:00:00", ["DAG_ID"])
    assert bag(outcome) == [("ko", "failed"), ("ok", "success"), ("on", "running")]


def test_grouping(make):
    df = make([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "k string, f string, n int")
    grouped = group_by_filter(df, ["k"], "f", ["x"], [("sum", "n", "total"), ("count", "n", "c")])
    assert bag(grouped) == [("a", 1, 1), ("b", 3, 1)]
    assert count_rows(df.filter(F.col("n") > 5)).first()[0] == 0
