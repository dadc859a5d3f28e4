"""Sources and sinks, slices, stages, dimensions, parameters and the run log."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quayside.contracts import MOVES, PREGATE, stamped
from quayside.operators import dimension as dm, params as pm, runlog
from quayside.plans import dimensions, stages
from quayside.settings import new_path, shared_dir
from quayside.sources import readers as r, writers as w

from .registry import check
from .views import DATE_COLUMNS, day


def new_database(spark) -> str:
    """A database of its own for a query's tables, under the shared folder."""
    name = f"quayside_{uuid.uuid4().hex[:12]}"
    w.create_database(spark, name, f"{shared_dir(spark)}/quayside/{name}")
    return name


# ---- scans ------------------------------------------------------------------------------------


@check("scan_parquet_or_empty", "SELECT * FROM orders")
def _(v):
    schema = v.table("orders").schema
    there = r.read_or_empty(v.spark, f"{v.sf_dir}/orders.parquet", schema)
    return there.unionByName(r.read_or_empty(v.spark, new_path(v.spark, "nothing-here"), schema))


def _round_trip(v, fmt, **options):
    path, rows = new_path(v.spark, fmt), v.table("lineitem")
    w.write_files(rows, fmt, path, **options)
    return r.read_files(v.spark, fmt, path, rows.schema, **options)


@check("scan_csv_roundtrip", "SELECT * FROM lineitem")
def _(v):
    return _round_trip(v, "csv", header=True)


@check("scan_json_roundtrip", "SELECT * FROM lineitem")
def _(v):
    return _round_trip(v, "json")


@check("scan_orc_roundtrip", "SELECT * FROM lineitem")
def _(v):
    return _round_trip(v, "orc")


@check("incremental_file_slice", "SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def _(v):
    return r.incremental_slice(v.table("events"), ["ts"], "20240115")


# ---- sinks ------------------------------------------------------------------------------------


@check("sink_file_roundtrip", "SELECT * FROM lineitem")
def _(v):
    return _round_trip(v, "parquet")


@check("sink_append", "SELECT * FROM v_source")
def _(v):
    path, rows = new_path(v.spark, "append"), v.source_slices
    w.append_slices(rows.filter("event_type = 'error'"), path, "slice")
    w.append_slices(rows.filter("event_type <> 'error'"), path, "slice")
    return v.spark.read.schema(rows.schema).parquet(path)


@check("sink_overwrite_partitions", """
    SELECT event_id, event_type, CASE WHEN slice >= DATE '2024-01-20' THEN value + 1 ELSE value END AS value,
      slice
    FROM v_source WHERE slice < DATE '2024-01-20' OR event_type <> 'error'""")
def _(v):
    path, rows = new_path(v.spark, "overwrite"), v.source_slices
    w.append_slices(rows, path, "slice")
    again = rows.filter("slice >= '2024-01-20' AND event_type <> 'error'")
    w.replace_slices(again.withColumn("value", F.col("value") + 1), path, "slice")
    return v.spark.read.schema(rows.schema).parquet(path)


@check("sink_create_or_replace", "SELECT * FROM orders")
def _(v):
    table = f"{new_database(v.spark)}.placed"
    w.create_or_replace(v.table("customer"), table)
    w.create_or_replace(v.table("orders"), table)
    return v.spark.table(table)


@check("sink_save_as_table", "SELECT * FROM orders")
def _(v):
    table = f"{new_database(v.spark)}.placed"
    w.save_as_table(v.table("orders").filter("o_orderstatus = 'O'"), table)
    w.save_as_table(v.table("orders").filter("o_orderstatus <> 'O'"), table)
    return v.spark.table(table)


@check("create_table_if_absent", "SELECT * FROM v_pregate")
def _(v):
    table = f"{new_database(v.spark)}.pregate"
    w.create_table_if_absent(v.spark, table, PREGATE, properties={"layer": "stage"})
    v.pregate.write.insertInto(table)
    w.create_table_if_absent(v.spark, table, PREGATE)
    return v.spark.table(table)


@check("repartition_table_by", "SELECT * FROM v_source")
def _(v):
    database = new_database(v.spark)
    w.save_as_table(v.source_slices, f"{database}.flat")
    w.repartition_table_by(v.spark, f"{database}.flat", "slice", f"{database}.sliced")
    return v.spark.table(f"{database}.sliced")


@check("delete_where", """
    SELECT * FROM v_source
    WHERE NOT (slice = DATE '2024-01-05' OR event_type = 'error' AND slice > DATE '2024-01-20')""")
def _(v):
    database = new_database(v.spark)
    table = f"{database}.sliced"
    w.create_or_replace(v.source_slices, table, partition_by="slice")
    late_errors = (F.col("event_type") == "error") & (F.col("slice") > "2024-01-20")
    w.delete_where(v.spark, table, (F.col("slice") == "2024-01-05") | late_errors, "slice")
    return v.spark.table(table)


@check("compact_partitions", "SELECT * FROM v_source")
def _(v):
    path, rows = new_path(v.spark, "compact"), v.source_slices
    w.append_slices(rows.filter("value < 10"), path, "slice")
    w.append_slices(rows.filter("value >= 10"), path, "slice")
    w.compact_partitions(v.spark, path, "slice")
    return v.spark.read.schema(rows.schema).parquet(path)


@check("meta_partitions", "SELECT slice, count(*) AS record_count, true AS has_files FROM v_source GROUP BY slice")
def _(v):
    path, rows = new_path(v.spark, "stats"), v.source_slices
    w.append_slices(rows, path, "slice")
    stats = w.partition_stats(v.spark.read.schema(rows.schema).parquet(path), "slice")
    return stats.select("slice", "record_count", (F.col("file_count") >= 1).alias("has_files"))


@check("top_n_partitions", """
    SELECT slice, count(*) AS record_count FROM v_source GROUP BY slice ORDER BY slice LIMIT 5""")
def _(v):
    path, rows = new_path(v.spark, "top"), v.source_slices
    w.append_slices(rows, path, "slice")
    stored = v.spark.read.schema(rows.schema).parquet(path)
    return w.top_partitions(stored, "slice", 5).select("slice", "record_count")


# ---- slices and stages --------------------------------------------------------------------------


@check("slice_replace_by_etl_date", """
    SELECT event_id, event_type, CASE WHEN slice = DATE '2024-01-10' THEN value * 2 ELSE value END AS value,
      CAST(strftime(slice, '%Y%m%d') AS INTEGER) AS ETL_DATE
    FROM v_source WHERE slice <> DATE '2024-01-10' OR event_type = 'purchase'""")
def _(v):
    key = F.date_format("slice", "yyyyMMdd").cast("int")
    path, stored = new_path(v.spark, "by-day"), v.source_slices.withColumn("ETL_DATE", key).drop("slice")
    w.append_slices(stored, path, "ETL_DATE")
    corrected = v.source_slices.filter("slice = '2024-01-10' AND event_type = 'purchase'")
    new = corrected.withColumn("value", F.col("value") * 2).drop("slice")
    for _ in range(2):
        w.replace_slice(new, path, "ETL_DATE", 20240110)
    return v.spark.read.schema(stored.schema).parquet(path)


_LANDED = """
    SELECT * FROM v_source WHERE slice IN (SELECT slice FROM {changed})
    UNION ALL
    SELECT * FROM v_stored WHERE slice NOT IN (SELECT slice FROM {changed})"""
_REMOVED = """
    SELECT slice FROM (SELECT * FROM v_stored EXCEPT SELECT * FROM v_source)
    UNION SELECT slice FROM v_source WHERE slice NOT IN (SELECT slice FROM v_stored)"""
_EITHER = _REMOVED + """
    UNION SELECT slice FROM (SELECT * FROM v_source EXCEPT SELECT * FROM v_stored)"""


def _landed(v, mode):
    path, source = new_path(v.spark, "landed"), v.source_slices
    w.append_slices(v.stored_slices, path, "slice")
    w.land_slices(source, path, "slice", mode)
    return v.spark.read.schema(source.schema).parquet(path)


@check("land_slice", _LANDED.format(changed="v_changed"), v_changed=_EITHER)
def _(v):
    return _landed(v, "symmetric")


@check("land_slice_removed_only", _LANDED.format(changed="v_changed"), v_changed=_REMOVED)
def _(v):
    return _landed(v, "removed")


# the source repeats purchases of one day, which only counting copies shows, and has lost the day of others
@check("land_slice_copies", """
    SELECT * FROM v_source
    UNION ALL
    SELECT * FROM v_source WHERE slice = DATE '2024-01-07' AND event_type = 'purchase'
    UNION ALL
    SELECT * REPLACE (CAST(NULL AS DATE) AS slice) FROM v_source WHERE slice = DATE '2024-01-12'""")
def _(v):
    path, rows = new_path(v.spark, "landed"), v.source_slices
    w.append_slices(rows, path, "slice")
    again = rows.filter("slice = '2024-01-07' AND event_type = 'purchase'")
    undated = F.when(F.col("slice") != "2024-01-12", F.col("slice"))
    w.land_slices(rows.withColumn("slice", undated).unionByName(again), path, "slice")
    return v.spark.read.schema(rows.schema).parquet(path)


def _typed(c: str) -> str:
    if c not in DATE_COLUMNS:
        return f"trim({c}) AS {c}"
    parsed = f"try_strptime(nullif(trim({c}), '31-DEC-00'), '%d-%b-%y')"
    # two-digit years are all of this century
    century = f"CASE WHEN {parsed} < TIMESTAMP '2000-01-01' THEN {parsed} + INTERVAL 100 YEAR ELSE {parsed} END"
    return f"coalesce(CAST({century} AS DATE), DATE '1900-12-31') AS {c}"


_STAGE = "SELECT " + ", ".join(_typed(c) for c in MOVES.names) + " FROM v_raw_moves"


@check("conform_stage", _STAGE)
def _(v):
    return stages.conform_stage(v.raw_moves, MOVES)


_MONTH = "CASE WHEN FEL = 'F' THEN 'full ' || REPORT_MONTH ELSE REPORT_MONTH END"


@check("summary_load", f"""
    SELECT * REPLACE ({_MONTH} AS REPORT_MONTH), 20231001 AS ETL_DATE FROM v_moves
    UNION ALL
    SELECT *, 20230930 FROM v_moves WHERE CAT_TYPE = 'INTERNAL'""")
def _(v):
    path, internal = new_path(v.spark, "summary"), v.moves.filter("CAT_TYPE = 'INTERNAL'")
    stages.summary_load(internal, path, MOVES, 20230930)
    stages.summary_load(internal, path, MOVES, 20231001)
    stages.summary_load(v.moves, path, MOVES, 20231001, [("REPORT_MONTH", _MONTH)])
    return v.spark.read.schema(stamped(MOVES)).parquet(path)


# ---- dimensions -----------------------------------------------------------------------------------

_SPLIT = """
    SELECT CASE WHEN d.ID IS NULL THEN 'I' ELSE 'U' END AS _change, d.ID, f.ITEM_KEY, f.PLACE_OF_DELIVERY
    FROM (SELECT DISTINCT * FROM v_feed WHERE ITEM_KEY IS NOT NULL) f
    LEFT JOIN {dim} d ON f.ITEM_KEY = d.ITEM_KEY
    WHERE d.ID IS NULL OR f.PLACE_OF_DELIVERY IS DISTINCT FROM d.PLACE_OF_DELIVERY"""
_GONE = """
    UNION ALL
    SELECT 'D', ID, ITEM_KEY, PLACE_OF_DELIVERY FROM v_active
    WHERE ITEM_KEY NOT IN (SELECT ITEM_KEY FROM v_feed WHERE ITEM_KEY IS NOT NULL)"""
_ACTIVE = "SELECT * FROM v_dim WHERE TRANG_THAI_BG = 'A'"
_SPLIT2 = _SPLIT.format(dim="v_active") + _GONE
KEYS, ATTRIBUTES = ["ITEM_KEY"], ["PLACE_OF_DELIVERY"]


@check("scd1_split", _SPLIT.format(dim="v_active"), v_active=_ACTIVE)
def _(v):
    return dm.split_changes(dm.current_rows(v.dim), v.feed, KEYS, "ID", ATTRIBUTES)


@check("scd2_split", _SPLIT2, v_active=_ACTIVE)
def _(v):
    return dm.split_changes(dm.current_rows(v.dim), v.feed, KEYS, "ID", ATTRIBUTES, deletes=True)


@check("scd1_apply", """
    SELECT d.ID, d.ITEM_KEY,
      CASE WHEN c.ID IS NULL THEN d.PLACE_OF_DELIVERY ELSE c.PLACE_OF_DELIVERY END AS PLACE_OF_DELIVERY,
      d.TRANG_THAI_BG, d.NGAY_HL_BG, d.NGAY_HH_BG
    FROM v_active d LEFT JOIN (SELECT * FROM v_changes WHERE _change = 'U') c ON d.ID = c.ID
    UNION ALL
    SELECT (SELECT max(ID) FROM v_active) + row_number() OVER (ORDER BY ITEM_KEY), ITEM_KEY,
      PLACE_OF_DELIVERY, NULL, NULL, NULL
    FROM v_changes WHERE _change = 'I'""", v_active=_ACTIVE, v_changes=_SPLIT.format(dim="v_active"))
def _(v):
    return dimensions.load_dimension(
        dm.current_rows(v.dim), v.feed, dimensions.ARRIVAL_PLACE, "2001-01-01"
    )


@check("scd2_apply", """
    SELECT d.ID, d.ITEM_KEY, d.PLACE_OF_DELIVERY,
      CASE WHEN c.ID IS NULL THEN d.TRANG_THAI_BG ELSE 'C' END AS TRANG_THAI_BG, d.NGAY_HL_BG,
      CASE WHEN c.ID IS NULL THEN d.NGAY_HH_BG ELSE DATE '2001-01-01' END AS NGAY_HH_BG
    FROM v_dim d LEFT JOIN (SELECT ID FROM v_changes WHERE _change IN ('U', 'D')) c ON d.ID = c.ID
    UNION ALL
    SELECT (SELECT max(ID) FROM v_dim) + row_number() OVER (ORDER BY ITEM_KEY), ITEM_KEY,
      PLACE_OF_DELIVERY, 'A', DATE '2001-01-01', DATE '2099-01-01'
    FROM v_changes WHERE _change IN ('I', 'U')""", v_active=_ACTIVE, v_changes=_SPLIT2)
def _(v):
    spec = dimensions.DimensionSpec(("ITEM_KEY",), ("PLACE_OF_DELIVERY",), scd_type=2)
    return dimensions.load_dimension(v.dim, v.feed, spec, "2001-01-01")


@check("surrogate_keys", """
    SELECT ITEM_KEY, PLACE_OF_DELIVERY,
      (SELECT max(ID) FROM v_dim) + row_number() OVER (ORDER BY ITEM_KEY) AS ID
    FROM v_feed f WHERE ITEM_KEY IS NOT NULL AND ITEM_KEY NOT IN (SELECT ITEM_KEY FROM v_dim)""")
def _(v):
    new = dm.of_kind(dm.split_changes(v.dim, v.feed, KEYS, "ID", ATTRIBUTES), "I")
    return dm.surrogate_keys(new.drop("ID"), v.dim, "ID", KEYS)


# ---- parameters and run log -----------------------------------------------------------------------


@check("param_lookup", """
    SELECT trim(MA_THAM_SO) AS MA_THAM_SO, trim(GIA_TRI) AS GIA_TRI FROM v_params
    WHERE trim(MA_THAM_SO) IN ('ETL_DATE_view', 'ETL_DATE_click', 'ETL_DATE_none')""")
def _(v):
    return pm.param_lookup(v.params, ["ETL_DATE_view", "ETL_DATE_click", "ETL_DATE_none"])


@check("advance_watermark", """
    SELECT MA_THAM_SO, CASE WHEN trim(MA_THAM_SO) = 'ETL_DATE_view' AND trim(GIA_TRI) <> '20240131'
      THEN strftime(strptime(trim(GIA_TRI), '%Y%m%d') + INTERVAL 1 DAY, '%Y%m%d') ELSE GIA_TRI END AS GIA_TRI
    FROM v_params""")
def _(v):
    return pm.advance_watermark(v.params, "20240131", "ETL_DATE_view")


@check("run_log_append", """
    SELECT * FROM v_runs WHERE STATUS_JOB <> 'F'
    UNION ALL
    SELECT * REPLACE (replace(ERROR_MESSAGE, '"', '') AS ERROR_MESSAGE) FROM v_runs
    WHERE STATUS_JOB = 'F'""")
def _(v):
    return runlog.run_log_append(
        v.runs.filter("STATUS_JOB <> 'F'"), v.runs.filter("STATUS_JOB = 'F'")
    )


@check("run_log_latest", """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY DAG_ID ORDER BY TIME_FINISH DESC) AS rn FROM v_runs)
    WHERE rn = 1""")
def _(v):
    return runlog.run_log_latest(v.runs)


@check("run_outcome", """
    SELECT DAG_ID, CASE WHEN count(*) FILTER (STATUS_JOB = 'F') > 0 THEN 'failed'
      WHEN count(*) FILTER (STATUS_JOB = '') > 0 THEN 'running' ELSE 'success' END AS outcome
    FROM v_runs WHERE TIME_START > TIMESTAMP '2024-01-28' GROUP BY DAG_ID""")
def _(v):
    return runlog.run_outcome(v.runs, "2024-01-28 00:00:00", ["DAG_ID"])
