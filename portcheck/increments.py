"""Writing versions, digests, deltas, late rows, registries and ledgers: work in proportion to what changed."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F, types as T

from quayside.contracts import MOVES, THROUGHPUT_BY
from quayside.functions import today_key
from quayside.operators import dimension as dm, numbering, runlog, versions as vs
from quayside.operators.commits import CommitConflict, VersionedTable
from quayside.operators.projection import conform_rejects
from quayside.operators.slices import changed_slices
from quayside.plans import dimensions, yard
from quayside.settings import materialize, new_path
from quayside.sources import readers as r, writers as w

from .loads import _typed
from .registry import check
from .tables import REPORT_VIEWS
from .versioned import CHAINS
from .views import day, scrambled, text

# ---- versions: stage, audit, publish ------------------------------------------------------------

_MAIN = {"v_heads": "SELECT snapshot_id AS head FROM v_refs WHERE name = 'main'", **CHAINS}
_READ_MAIN = """SELECT h.event_id, h.value, h.slice
    FROM v_history h JOIN v_shown s ON h.slice = s.slice AND h.content_id = s.content_id"""


def _stored_versions(v) -> VersionedTable:
    """The given history as a stored table."""
    schema = T.StructType([v.history.schema[c] for c in ("event_id", "value", "slice")])
    table = VersionedTable(v.spark, new_path(v.spark, "versions"), schema)
    v.history.drop("ts").write.partitionBy("content_id").parquet(f"{table.path}/history")
    v.commits.write.parquet(f"{table.path}/commits")
    table.swap_refs(v.refs, 0)
    return table


def _two_writers(v):
    """Two writers stage on one head: one rewrites the 12th and empties the 14th, one adds to the 12th and the 30th.
    A third adds to the 30th alone and to a new day."""
    table = _stored_versions(v)
    rows = table.read()
    first = table.stage(rows.filter("slice = '2024-01-12'").withColumn("value", F.col("value") * 3), 2_000_001,
                        "2024-02-01 00:00:00", "overwrite", emptied=["2024-01-14"])
    second = table.stage(rows.filter("slice IN ('2024-01-12', '2024-01-30') AND value > 5"), 2_000_002, "2024-02-01 00:01:00")
    moved = F.when(F.col("value") > 15, F.date_add("slice", 7)).otherwise(F.col("slice"))
    third = table.stage(rows.filter("slice = '2024-01-30' AND value > 10").withColumn("slice", moved), 2_000_003,
                        "2024-02-01 00:02:00")
    return table, first, second, third


@check("snapshot_commit_staged", """
    SELECT * FROM v_main WHERE slice NOT IN (DATE '2024-01-12', DATE '2024-01-14')
    UNION ALL SELECT event_id, value * 3, slice FROM v_main WHERE slice = DATE '2024-01-12'
    UNION ALL
    SELECT event_id, value, CASE WHEN value > 15 THEN slice + 7 ELSE slice END
    FROM v_main WHERE slice = DATE '2024-01-30' AND value > 10""", v_main=_READ_MAIN, **_MAIN)
def _(v):
    table, first, second, third = _two_writers(v)
    table.publish(first, "2024-02-01 01:00:00")
    try:
        table.publish(second, "2024-02-01 01:01:00")
        raise AssertionError("a second writer of one slice must be refused")
    except CommitConflict:
        pass
    table.publish(third, "2024-02-01 01:02:00")  # other slices: repeated on top
    return table.read()


@check("snapshot_audit_staged", """
    SELECT * FROM v_main
    UNION ALL SELECT * FROM v_main WHERE slice IN (DATE '2024-01-12', DATE '2024-01-30') AND value > 5""",
       v_main=_READ_MAIN, **_MAIN)
def _(v):
    table, _, second, _ = _two_writers(v)
    return table.read_staged(second)


@check("snapshot_commit_refused", "SELECT DISTINCT CAST(2000002 AS BIGINT) AS snapshot_id, slice FROM v_main "
       "WHERE slice = DATE '2024-01-12' AND value > 5", v_main=_READ_MAIN, **_MAIN)
def _(v):
    from quayside.operators.commits import conflicts

    table, first, second, _ = _two_writers(v)
    table.publish(first, "2024-02-01 01:00:00")
    lost = conflicts(table.commits, table.refs(), second)
    return lost.select(F.lit(2_000_002).cast("bigint").alias("snapshot_id"), "slice")


# ---- changes between two versions --------------------------------------------------------------

_SHOWN_BY = """
    SELECT h.slice, h.event_id, h.value FROM v_history h
    JOIN v_shown s ON h.slice = s.slice AND h.content_id = s.content_id WHERE s.head = {head}"""
_CHANGES = """
    SELECT slice, event_id, value, CASE WHEN net > 0 THEN 'added' ELSE 'removed' END AS side,
      CAST(abs(net) AS BIGINT) AS copies
    FROM (SELECT slice, event_id, value, sum(side) AS net
          FROM (SELECT *, 1 AS side FROM v_after UNION ALL SELECT *, -1 FROM v_before)
          GROUP BY slice, event_id, value)
    WHERE net <> 0"""


def _between(before: str, after: str) -> dict[str, str]:
    heads = f"SELECT CAST({before} AS BIGINT) AS head UNION SELECT CAST({after} AS BIGINT)"
    return {"v_heads": heads, "v_before": _SHOWN_BY.format(head=before), "v_after": _SHOWN_BY.format(head=after), **CHAINS}


def _changes(v, before, after):
    history = _stored_versions(v).history.select("slice", "event_id", "value", "content_id")
    return vs.snapshot_changes(history, v.commits, vs.commits_of(v.spark, before), vs.commits_of(v.spark, after))


@check("snapshot_changes", _CHANGES, **_between(scrambled(45), scrambled(75)))
def _(v):
    return _changes(v, scrambled(45), scrambled(75))


# commit 60 was rolled back: neither builds on the other
@check("snapshot_changes_rolled_back", _CHANGES, **_between(scrambled(60), scrambled(64)))
def _(v):
    return _changes(v, scrambled(60), scrambled(64))


# ---- slices: digests, deltas, compaction, files -----------------------------------------------------


@check("land_slice_by_digest", """
    SELECT * FROM v_source
    UNION ALL
    SELECT * FROM v_source WHERE slice = DATE '2024-01-07' AND event_type = 'purchase'
    UNION ALL
    SELECT * REPLACE (CAST(NULL AS DATE) AS slice) FROM v_source WHERE slice = DATE '2024-01-12'""")
def _(v):
    path, digests, rows = new_path(v.spark, "landed"), new_path(v.spark, "digests"), v.source_slices
    w.land_slices_by_digest(rows, path, digests, "slice")
    again = rows.filter("slice = '2024-01-07' AND event_type = 'purchase'")
    undated = F.when(F.col("slice") != "2024-01-12", F.col("slice"))
    w.land_slices_by_digest(rows.withColumn("slice", undated).unionByName(again), path, digests, "slice")
    return v.spark.read.schema(rows.schema).parquet(path)


@check("land_slice_by_digest_adopted", "SELECT * FROM v_landed", v_landed="""
    SELECT * FROM v_source UNION ALL SELECT * FROM v_stored WHERE slice NOT IN (SELECT slice FROM v_source)""")
def _(v):
    path, digests, source = new_path(v.spark, "landed"), new_path(v.spark, "digests"), v.source_slices
    w.append_slices(v.stored_slices, path, "slice")
    stored = v.spark.read.schema(source.schema).parquet(path)
    w.adopt_slices(stored, digests, "slice")
    w.land_slices_by_digest(source, path, digests, "slice")
    return v.spark.read.schema(source.schema).parquet(path)


_LATE = "EXEC_TS >= DATE '1998-06-01'"


@check("throughput_delta", f"""
    SELECT {', '.join(THROUGHPUT_BY)}, count(*) AS TOTALCONT, 20231002 AS ETL_DATE
    FROM v_report_rows GROUP BY {', '.join(THROUGHPUT_BY)}""", **REPORT_VIEWS)
def _(v):
    now = v.moves
    # as stored before: the last days without some moves, and others lifted by other means
    fel = F.when(F.expr(_LATE) & (F.col("X") == "3"), "F").otherwise(F.col("FEL"))
    was = now.filter(F.expr(f"NOT ({_LATE} AND X = '1')")).withColumn("FEL", fel)
    kept = materialize(yard.yard_throughput(yard.report_rows(replace(v.yard, moves=was)), 20231001), "totals")
    due = materialize(changed_slices(was, now, "EXEC_TS", "copies"), "changed-slices")
    in_due = lambda rows: replace(v.yard, moves=rows.join(due, "EXEC_TS", "left_semi"))
    return yard.throughput_delta(kept, in_due(was), in_due(now), 20231002)


@check("compact_by_size", "SELECT * FROM v_source")
def _(v):
    path, rows = new_path(v.spark, "compact"), v.source_slices
    for low in range(0, 20, 4):
        w.append_slices(rows.filter((F.col("value") >= low) & (F.col("value") < low + 4)), path, "slice")
    w.append_slices(rows.filter("value >= 20 OR value < 0"), path, "slice")
    w.compact_by_size(v.spark, path, "slice", 16 << 10)
    return v.spark.read.schema(rows.schema).parquet(path)


@check("meta_files", """
    SELECT slice, count(*) AS record_count, count(DISTINCT value < 10) AS file_count,
      true AS bytes_agree
    FROM v_source GROUP BY slice""")
def _(v):
    path, rows = new_path(v.spark, "stats"), v.source_slices
    for part in ("value < 10", "value >= 10"):
        rows.filter(part).repartition(4, "slice").write.partitionBy("slice").mode("append").parquet(path)
    stats = w.partition_sizes(v.spark.read.schema(rows.schema).parquet(path), "slice")
    nothing = v.spark.createDataFrame([], r.FILE)
    listed = r.new_files(v.spark, path, nothing).groupBy(
        F.regexp_extract("path", "slice=([^/]*)", 1).cast("date").alias("slice")).agg(F.sum("size").alias("_listed"))
    return stats.join(listed, "slice").select(
        "slice", "record_count", "file_count", (F.col("bytes") == F.col("_listed")).alias("bytes_agree"))


@check("slice_replace_null", """
    SELECT event_id, event_type, value, CASE WHEN slice > DATE '2024-01-20' THEN NULL ELSE slice END AS slice FROM v_source
    WHERE NOT (slice > DATE '2024-01-20' AND event_type = 'error')""")
def _(v):
    undated = F.when(F.col("slice") > "2024-01-20", F.lit(None)).otherwise(F.col("slice"))
    path, rows = new_path(v.spark, "undated"), v.source_slices.withColumn("slice", undated)
    w.append_slices(rows, path, "slice")
    corrected = rows.filter("slice IS NULL AND event_type <> 'error'")
    for _ in range(2):
        w.replace_slice(corrected, path, "slice", None)
    return v.spark.read.schema(rows.schema).parquet(path)


@check("incremental_file_ledger", """
    SELECT *, CASE WHEN slice < DATE '2024-01-20' AND event_type <> 'error' THEN 1 ELSE 2 END AS taken FROM v_source""")
def _(v):
    path, rows = new_path(v.spark, "arriving"), v.source_slices
    early = (F.col("slice") < "2024-01-20") & (F.col("event_type") != "error")
    ledger, taken = v.spark.createDataFrame([], r.FILE), []
    for part in (early, ~early):  # the second time also late files of old days
        w.append_slices(rows.filter(part), path, "slice")
        found, ledger = r.read_new_files(v.spark, path, ledger, rows.schema)
        ledger = materialize(ledger, "ledger")
        taken.append(found.withColumn("taken", F.lit(len(taken) + 1)))
    nothing, _ = r.read_new_files(v.spark, path, ledger, rows.schema)
    return taken[0].unionByName(taken[1]).unionByName(nothing.withColumn("taken", F.lit(3)))


# ---- stages ------------------------------------------------------------------------------------------

_UNREADABLE = "trim(COMPLETE_TS) <> '31-DEC-00' AND try_strptime(trim(COMPLETE_TS), '%d-%b-%y') IS NULL"


@check("conform_rejects", f"""
    SELECT ITEM_NO, COMPLETE_TS, CAST(NULL AS VARCHAR) AS reject_column, CAST(NULL AS VARCHAR) AS reject_text
    FROM (SELECT {_typed('ITEM_NO')}, {_typed('COMPLETE_TS')} FROM v_raw_moves
          WHERE NOT coalesce({_UNREADABLE}, false))
    UNION ALL
    SELECT ITEM_NO, NULL, 'COMPLETE_TS', COMPLETE_TS FROM v_raw_moves WHERE {_UNREADABLE}""")
def _(v):
    rows, rejects = conform_rejects(v.raw_moves, MOVES, ["ITEM_NO"])
    none = F.lit(None).cast("string")
    return rows.select("ITEM_NO", "COMPLETE_TS", none.alias("reject_column"), none.alias("reject_text")).unionByName(
        rejects.select("ITEM_NO", F.lit(None).cast("date").alias("COMPLETE_TS"), "reject_column", "reject_text"))


@check("stamp_today", "SELECT *, strftime(ts + INTERVAL 7 HOUR, '%Y%m%d') AS ETL_DATE FROM events")
def _(v):
    events = v.table("events")
    return events.withColumn("ETL_DATE", today_key("Asia/Bangkok", F.col("ts")))


# ---- dimensions ------------------------------------------------------------------------------------


def _loaded(v, spec, feed, known):
    """A dimension loaded twice: from the part of the feed known first, with some attributes blanked, then from all of it."""
    blank = {a: F.lit(None).cast(feed.schema[a].dataType) for a in spec.attributes[:1]}
    first = feed.filter(known).withColumns(blank)
    fields = ["ID bigint", *[f"{f.name} {f.dataType.simpleString()}" for f in feed.schema if f.name in (*spec.keys, *spec.attributes)]]
    dim = v.spark.createDataFrame([], ", ".join(fields))
    dim = materialize(dimensions.load_dimension(dim, first, spec, "2001-01-01"), "dimension")
    return dimensions.load_dimension(dim, feed, spec, "2001-01-02")


def _loaded_sql(keys: str, attributes: str, feed: str, known: str) -> str:
    return f"""
    SELECT row_number() OVER (ORDER BY NOT known, {keys}) AS ID, {keys}, {attributes}
    FROM (SELECT DISTINCT {keys}, {attributes}, {known} AS known FROM {feed})"""


@check("dim_departure_place", _loaded_sql("ITEM_KEY", "RECEIVAL_PLACE", "v_pregate", "RECEIVAL_PLACE < 'P3'"))
def _(v):
    return _loaded(v, dimensions.DEPARTURE_PLACE, v.pregate, "RECEIVAL_PLACE < 'P3'")


@check("dim_handling_method", _loaded_sql(
    "OPERATION_METHOD", "OPERATION_NAME, TRANFER_LINK_DEPOT", "v_methods", "TRANFER_LINK_DEPOT = 'Y'"))
def _(v):
    return _loaded(v, dimensions.HANDLING_METHOD, v.methods, "TRANFER_LINK_DEPOT = 'Y'")


@check("dim_equipment", _loaded_sql("CHE_ID, AS_AT_TS", "COMPANY, MANAGE_BY, EXPIRY_TS", "v_equipment", "MANAGE_BY = 'PORT'"))
def _(v):
    return _loaded(v, dimensions.EQUIPMENT, v.equipment, "MANAGE_BY = 'PORT'")


_EARLY = """
    SELECT ITEM_KEY, row_number() OVER (ORDER BY ITEM_KEY) AS ID
    FROM (SELECT DISTINCT ITEM_KEY FROM v_feed WHERE PLACE_OF_DELIVERY < '3' AND ITEM_KEY IS NOT NULL)"""
_LATER = """
    SELECT ITEM_KEY, (SELECT max(ID) FROM v_early) + row_number() OVER (ORDER BY ITEM_KEY) AS ID
    FROM (SELECT DISTINCT ITEM_KEY FROM v_feed
          WHERE ITEM_KEY IS NOT NULL AND ITEM_KEY NOT IN (SELECT ITEM_KEY FROM v_early))"""


@check("surrogate_registry", """
    SELECT f.ITEM_KEY, f.PLACE_OF_DELIVERY, i.ID FROM v_feed f
    JOIN (SELECT * FROM v_early UNION ALL SELECT * FROM v_later) i ON f.ITEM_KEY = i.ITEM_KEY""", v_early=_EARLY, v_later=_LATER)
def _(v):
    registry = v.spark.createDataFrame([], "ITEM_KEY string, ID bigint")
    for feed in (v.feed.filter("PLACE_OF_DELIVERY < '3'"), v.feed):
        registry = materialize(numbering.register_keys(registry, feed, ["ITEM_KEY"], "ID"), "registry")
    # rebuilt from nothing: the ids of the registry
    return v.feed.join(registry, "ITEM_KEY").select("ITEM_KEY", "PLACE_OF_DELIVERY", "ID")


_EVENTS = """
    SELECT ITEM_KEY, NGAY_HL_BG AS d, 1 AS prio, ID, PLACE_OF_DELIVERY AS place, true AS here FROM v_touched
    UNION ALL
    SELECT ITEM_KEY, NGAY_HH_BG, 0, NULL, NULL, false FROM v_touched WHERE NGAY_HH_BG < DATE '2099-01-01'
    UNION ALL
    SELECT ITEM_KEY, since, 2, NULL, PLACE_OF_DELIVERY, true FROM v_late"""
_MARKED = """
    SELECT *, lag(here) OVER o IS NULL OR here <> lag(here) OVER o
              OR here AND place IS DISTINCT FROM lag(place) OVER o AS starts
    FROM (SELECT ITEM_KEY, d, max(ID) AS ID, first(place ORDER BY prio DESC) AS place, first(here ORDER BY prio DESC) AS here
          FROM v_changes_known GROUP BY ITEM_KEY, d)
    WINDOW o AS (PARTITION BY ITEM_KEY ORDER BY d)"""
_BACKDATED = """
    SELECT coalesce(ID, (SELECT max(ID) FROM v_dim) + row_number() OVER (PARTITION BY ID IS NULL ORDER BY ITEM_KEY, d)) AS ID,
      ITEM_KEY, place AS PLACE_OF_DELIVERY, CASE WHEN until = DATE '2099-01-01' THEN 'A' ELSE 'C' END AS TRANG_THAI_BG,
      d AS NGAY_HL_BG, until AS NGAY_HH_BG
    FROM (SELECT *, coalesce(lead(d) OVER (PARTITION BY ITEM_KEY ORDER BY d), DATE '2099-01-01') AS until
          FROM v_marked WHERE starts)
    WHERE here
    UNION ALL
    SELECT * FROM v_dim WHERE ITEM_KEY NOT IN (SELECT ITEM_KEY FROM v_late)"""
_LATE_ROWS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS ITEM_KEY, nullif(o_orderpriority, '5-LOW') AS PLACE_OF_DELIVERY,
      CAST(o_orderdate AS DATE) + CAST(o_custkey % 90 - 45 AS INTEGER) AS since
    FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), '0-FIRST', CAST(o_orderdate AS DATE) - 60 FROM orders WHERE o_orderstatus = 'F'"""


@check("scd2_backdated", _BACKDATED, v_late=_LATE_ROWS, v_changes_known=_EVENTS, v_marked=_MARKED,
       v_touched="SELECT * FROM v_dim WHERE ITEM_KEY IN (SELECT ITEM_KEY FROM v_late)")
def _(v):
    orders = v.table("orders").withColumn("_day", F.col("o_orderdate").cast("date"))
    key = text(F.col("o_orderkey")).alias("ITEM_KEY")
    late = orders.filter("o_orderdate >= timestamp_ntz '1998-01-01 00:00:00'").select(
        key, F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("PLACE_OF_DELIVERY"),
        F.expr("date_add(_day, cast(o_custkey % 90 - 45 as int))").alias("since"),
    ).unionByName(orders.filter("o_orderstatus = 'F'").select(
        key, F.lit("0-FIRST").alias("PLACE_OF_DELIVERY"), F.date_add("_day", -60).alias("since")))
    return dm.apply_backdated(v.dim, late, ["ITEM_KEY"], "ID", ["PLACE_OF_DELIVERY"], "since")


# ---- run log ---------------------------------------------------------------------------------------


_STATE = "CASE STATUS_JOB WHEN 'F' THEN 2 WHEN 'S' THEN 0 ELSE 1 END"
_DUE = f"""
    SELECT j.DAG_ID, c.d, CASE WHEN s.state IS NULL THEN 'missing' WHEN s.state = 2 THEN 'failed' ELSE 'open' END AS state
    FROM (SELECT DISTINCT DAG_ID FROM v_runs) j
    CROSS JOIN (SELECT CAST(unnest(range(DATE '2024-01-03', DATE '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS d) c
    LEFT JOIN (SELECT DAG_ID, CAST(TIME_START AS DATE) AS d, arg_max({_STATE}, (TIME_FINISH, TIME_START, {_STATE})) AS state
               FROM v_runs GROUP BY ALL) s ON s.DAG_ID = j.DAG_ID AND s.d = c.d
    WHERE s.state IS NULL OR s.state > 0"""


@check("due_days", """
    SELECT DAG_ID, state, strftime(min(d), '%Y%m%d') AS first_day, strftime(max(d), '%Y%m%d') AS last_day, count(*) AS n_days
    FROM (SELECT *, d - CAST(row_number() OVER (PARTITION BY DAG_ID, state ORDER BY d) AS INTEGER) AS island FROM v_due)
    GROUP BY DAG_ID, state, island""", v_due=_DUE)
def _(v):
    return runlog.due_days(v.runs, "20240103", "20240202", by=["DAG_ID"])
