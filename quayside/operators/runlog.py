"""Job runs as an append-only log of events."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from ..contracts import RUN_LOG
from ..functions import sanitize
from .projection import one_per_key

# States of a run.
QUEUED, SUCCEEDED, FAILED, UNKNOWN = "Q", "S", "F", ""


def run_log_append(log: DataFrame, runs: DataFrame) -> DataFrame:
    """Add events, quotes removed from their error text."""
    events = runs.withColumn("ERROR_MESSAGE", sanitize(F.col("ERROR_MESSAGE")))
    return log.select(*RUN_LOG.names).unionByName(events.select(*RUN_LOG.names))


def run_log_latest(log: DataFrame, run: str = "DAG_ID", at: str = "TIME_FINISH") -> DataFrame:
    """The latest event of each run.  The log only grows; this is its current state."""
    return one_per_key(log, [run], latest_by=[at])


def run_outcome(log: DataFrame, since, by: Sequence[str] = ()) -> DataFrame:
    """Runs started after ``since``: failed if any failed, else running if any has no state yet,
    else success."""
    state = F.col("STATUS_JOB")
    recent = log.filter(F.col("TIME_START") > F.lit(since).cast("timestamp_ntz"))
    return recent.groupBy(*by).agg(
        F.when(F.max(state == FAILED), "failed")
        .when(F.max(state == UNKNOWN), "running")
        .otherwise("success")
        .alias("outcome")
    )


def due_days(log: DataFrame, first: str, last: str, by: Sequence[str] = ("JOB_NAME",)) -> DataFrame:
    """The back-fill plan: per job, ranges of days (``yyyyMMdd``) from ``first`` to ``last`` that have to be run again.

    A day is done if the last run that started on it succeeded.  The others are ``missing`` (no run), ``failed`` or
    ``open`` (queued, or without a state yet); neighbouring days of one kind make a range: the day minus the day's number
    among those of its kind is the same all through a range.  Jobs are those the log knows.
    """
    day = lambda key: F.to_date(F.lit(key), "yyyyMMdd")
    runs = log.select(*by, F.col("TIME_START").cast("date").alias("_day"), "TIME_START", "TIME_FINISH", "STATUS_JOB")
    inside = runs.filter((F.col("_day") >= day(first)) & (F.col("_day") <= day(last)))
    # of runs that end together the failed one counts, then one that is not done
    rank = F.when(F.col("STATUS_JOB") == FAILED, 2).when(F.col("STATUS_JOB") == SUCCEEDED, 0).otherwise(1)
    states = inside.groupBy(*by, "_day").agg(
        F.max(F.struct("TIME_FINISH", "TIME_START", rank.alias("rank"))).getField("rank").alias("_rank"))
    jobs = log.select(*by).distinct()
    days = jobs.select(*by, F.explode(F.sequence(day(first), day(last))).alias("_day"))
    same = reduce(and_, [days[c].eqNullSafe(states[c]) for c in ("_day", *by)])
    kind = F.when(states["_rank"].isNull(), "missing").when(states["_rank"] == 2, "failed").otherwise("open")
    due = days.join(states, same, "left").filter(states["_rank"].isNull() | (states["_rank"] > 0)).select(
        *[days[c] for c in (*by, "_day")], kind.alias("state"))
    nth = F.row_number().over(Window.partitionBy(*by, "state").orderBy("_day"))
    key = lambda column: F.date_format(column, "yyyyMMdd")
    return due.withColumn("_range", F.date_sub("_day", nth)).groupBy(*by, "state", "_range").agg(
        key(F.min("_day")).alias("first_day"), key(F.max("_day")).alias("last_day"), F.count("*").alias("n_days")
    ).drop("_range")
