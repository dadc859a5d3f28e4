"""Projections, filters and column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside import functions as fn
from quayside.contracts import contract
from quayside.operators import projection as p
from quayside.operators.slices import slice_filter
from quayside.plans.yard import reported_moves
from quayside.sources.readers import scan

from .registry import check
from .views import text


@check("scan_project_filter", """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'""")
def _(v):
    recent = (F.col("l_shipdate") >= "1998-01-01") & (F.col("l_returnflag") == "R")
    return scan(v.table("lineitem"), ["l_orderkey", "l_partkey", "l_quantity"], recent)


@check("project_contract", "SELECT MOVE_TYPE, ITEM_KEY, EXEC_TS FROM v_moves")
def _(v):
    return p.project(v.moves, contract("MOVE_TYPE, ITEM_KEY, EXEC_TS date"))


@check("rename_with_suffix", """
    SELECT OPERATION_METHOD AS OPERATION_METHOD_oper, OPERATION_NAME AS OPERATION_NAME_oper,
      TRANFER_LINK_DEPOT, CRT_TS FROM v_methods""")
def _(v):
    return p.rename_with_suffix(v.methods, "oper", ["OPERATION_METHOD", "OPERATION_NAME"])


@check("rename_by_pairs", "SELECT l_orderkey, l_shipdate AS NGAY_DL, l_quantity AS SAN_LUONG FROM lineitem")
def _(v):
    rows = v.table("lineitem").select("l_orderkey", "l_shipdate", "l_quantity")
    return p.rename_by_pairs(rows, ["l_shipdate", "l_quantity"], ["NGAY_DL", "SAN_LUONG"])


@check("select_by_pattern", "SELECT TRANG_THAI_BG, NGAY_HL_BG, NGAY_HH_BG FROM v_dim")
def _(v):
    return p.select_by_pattern(v.dim, "BG")


@check("stamp_etl_date", "SELECT *, 20231001 AS ETL_DATE FROM v_pregate")
def _(v):
    return p.stamp(v.pregate, ETL_DATE=20231001)


@check("transform_exprs", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'done' END AS state,
      upper(CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'done' END) AS label,
      o_orderkey * 2 AS twice FROM orders""")
def _(v):
    return p.transform_exprs(v.table("orders"), [
        ("state", "CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'done' END"),
        ("label", "upper(state)"),
        ("twice", "o_orderkey * 2"),
    ]).select("o_orderkey", "state", "label", "twice")


@check("filter_literals", """
    SELECT ITEM_KEY, ITEM_NO, CAT_TYPE, MOVE_TYPE FROM v_moves
    WHERE CAT_TYPE = 'YARD' AND MOVE_TYPE <> 'TRANS'""")
def _(v):
    kept = (F.col("CAT_TYPE") == "YARD") & (F.col("MOVE_TYPE") != "TRANS")
    return scan(v.moves, ["ITEM_KEY", "ITEM_NO", "CAT_TYPE", "MOVE_TYPE"], kept)


@check("filter_in_not_in", """
    SELECT ITEM_NO, CHE_ID, VES_ID FROM v_moves
    WHERE CHE_ID NOT IN ('???', 'TOP', 'A00', ' ') AND VES_ID NOT IN ('V1', 'V2')
      AND IN_OUT IN ('IN', 'LIFTON')""")
def _(v):
    kept = (
        ~F.col("CHE_ID").isin("???", "TOP", "A00", " ")
        & ~F.col("VES_ID").isin("V1", "V2")
        & F.col("IN_OUT").isin("IN", "LIFTON")
    )
    return scan(v.moves, ["ITEM_NO", "CHE_ID", "VES_ID"], kept)


# the SQL states all seven conditions, the operator the three that decide
@check("filter_yard_moves", """
    SELECT m.ITEM_KEY, m.ITEM_NO, m.MOVE_TYPE, m.CHE_ID
    FROM v_moves m
    LEFT JOIN v_areas a ON m.MOVE_TYPE = 'LIFTON' AND m.STACK = a.STACK
      AND m.EXEC_TS BETWEEN a.FR_DATE AND a.TO_DATE
    LEFT JOIN v_areas b ON m.MOVE_TYPE = 'LIFTOFF' AND m.TO_STACK = b.STACK
      AND m.EXEC_TS BETWEEN b.FR_DATE AND b.TO_DATE
    WHERE m.CAT_TYPE = 'YARD' AND m.CHE_ID NOT IN ('???', 'TOP', 'A00', ' ')
      AND m.MOVE_TYPE IN ('LIFTON', 'LIFTOFF')
      AND (m.MOVE_TYPE <> 'TRANS' OR m.CAT_TYPE <> 'INTERNAL' OR a.SCAN_AREA IS NULL
           OR a.SCAN_AREA <> 'Y' OR a.IS_VIRTUAL_HEAP_STACK <> 'Y')
      AND (m.MOVE_TYPE <> 'LIFTOFF' OR m.CAT_TYPE <> 'VES' OR b.SCAN_AREA IS NULL
           OR b.SCAN_AREA <> 'Y' OR b.IS_VIRTUAL_HEAP_STACK <> 'Y')
      AND (m.MOVE_TYPE <> 'LIFTOFF' OR m.CAT_TYPE <> 'INTERNAL' OR b.SCAN_AREA IS NULL
           OR b.SCAN_AREA <> 'Y' OR b.IS_VIRTUAL_HEAP_STACK <> 'Y')
      AND (m.MOVE_TYPE <> 'LIFTON' OR m.CAT_TYPE <> 'INTERNAL' OR a.SCAN_AREA IS NULL
           OR a.SCAN_AREA <> 'Y' OR a.IS_VIRTUAL_HEAP_STACK <> 'Y')""")
def _(v):
    return reported_moves(v.moves).select("ITEM_KEY", "ITEM_NO", "MOVE_TYPE", "CHE_ID")


@check("filter_keys_not_null", "SELECT * FROM v_feed WHERE ITEM_KEY IS NOT NULL")
def _(v):
    return p.keys_not_null(v.feed, ["ITEM_KEY"])


@check("slice_filter", "SELECT event_id, event_type, value, slice FROM v_events WHERE slice = DATE '2024-01-15'")
def _(v):
    return slice_filter(v.source_slices, "slice", "2024-01-15")


@check("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(v):
    return p.distinct_rows(v.table("lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


@check("trim_all_strings", """
    SELECT p_partkey, p_name, chr(9) || p_brand AS p_brand, '' AS blank FROM part""")
def _(v):
    padded = v.table("part").select(
        "p_partkey",
        text("  ", F.col("p_name"), "   ").alias("p_name"),
        text(" \t", F.col("p_brand"), " ").alias("p_brand"),
        F.lit(" ").alias("blank"),
    )
    return p.trim_all_strings(padded)


@check("conform_types", """
    SELECT TRY_CAST(CASE WHEN l_linenumber = 3 THEN 'x' || l_partkey ELSE '' || l_partkey END AS BIGINT)
        AS part_no,
      l_linenumber AS line_no, l_returnflag AS flag
    FROM lineitem""")
def _(v):
    raw = v.table("lineitem").select(
        F.when(F.col("l_linenumber") == 3, text("x", F.col("l_partkey")))
        .otherwise(text(" ", F.col("l_partkey"), " ")).alias("part_no"),
        text(F.col("l_linenumber"), "  ").alias("line_no"),
        text(" ", F.col("l_returnflag")).alias("flag"),
    )
    return p.conform(raw, contract("part_no bigint, line_no int, flag"))


@check("conform_sentinel_date", """
    SELECT event_id, CASE WHEN event_type IN ('error', 'signup', 'view') THEN DATE '1900-12-31'
      ELSE slice END AS happened_on
    FROM v_events""")
def _(v):
    kind = F.col("event_type")
    landed = (
        F.when(kind == "error", "31-DEC-00").when(kind == "view", "garbage")
        .when(kind != "signup", fn.slice_key(F.col("slice")))
    )
    return v.events.select("event_id", fn.conform_date(landed).alias("happened_on"))


@check("null_to_blank", "SELECT ITEM_KEY, coalesce(PLACE_OF_DELIVERY, ' ') AS place FROM v_pregate")
def _(v):
    return v.pregate.select("ITEM_KEY", fn.null_to_blank(F.col("PLACE_OF_DELIVERY")).alias("place"))


@check("iso_reefer_flag", """
    SELECT ITEM_NO, ISO, CASE WHEN substr(ISO, 3, 1) IN ('3', '4', 'R') THEN 'Y' ELSE ' ' END AS IS_REEFER
    FROM v_moves""")
def _(v):
    return v.moves.select("ITEM_NO", "ISO", fn.is_reefer(F.col("ISO")).alias("IS_REEFER"))


@check("conditional_pick", """
    SELECT ITEM_NO, CASE WHEN IN_OUT = 'LIFTON' THEN DEP_TS ELSE ARR_TS END AS EXEC_TS,
      CASE WHEN VES_ID = 'V4' THEN PLACE_OF_RECEIPT ELSE 'CTL' END AS PLACE_OF_RECEIPT
    FROM v_moves""")
def _(v):
    return v.moves.select(
        "ITEM_NO",
        fn.either(F.col("IN_OUT") == "LIFTON", F.col("DEP_TS"), F.col("ARR_TS")).alias("EXEC_TS"),
        fn.either(F.col("VES_ID") == "V4", F.col("PLACE_OF_RECEIPT"), F.lit("CTL"))
        .alias("PLACE_OF_RECEIPT"),
    )


@check("case_multi_branch", """
    SELECT STACK, CASE WHEN IS_VIRTUAL_HEAP_STACK = 'Y' AND SCAN_AREA = 'Y' THEN ' Soi'
      WHEN IS_VIRTUAL_HEAP_STACK = 'Y' AND FUMIGATE_AREA = 'Y' THEN ' Khử trùng' ELSE ' ' END AS treated
    FROM v_areas""")
def _(v):
    heap = F.col("IS_VIRTUAL_HEAP_STACK") == "Y"
    return v.areas.select("STACK", fn.first_match([
        (heap & (F.col("SCAN_AREA") == "Y"), " Soi"),
        (heap & (F.col("FUMIGATE_AREA") == "Y"), " Khử trùng"),
    ]).alias("treated"))


@check("concat_null_propagates", """
    SELECT ITEM_KEY, R_D || PLACE_OF_DELIVERY || RECEIVAL_PLACE AS route FROM v_pregate""")
def _(v):
    return v.pregate.select(
        "ITEM_KEY", F.concat("R_D", "PLACE_OF_DELIVERY", "RECEIVAL_PLACE").alias("route")
    )


@check("date_format_slice_key", """
    SELECT o_orderkey, upper(strftime(o_orderdate, '%d-%b-%y')) AS slice_key FROM orders""")
def _(v):
    return v.table("orders").select("o_orderkey", fn.slice_key(F.col("o_orderdate")).alias("slice_key"))


@check("parse_date_formats", """
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS ordered
    FROM orders""")
def _(v):
    status, when = F.col("o_orderstatus"), F.col("o_orderdate")
    spelled = (
        F.when(F.col("o_orderpriority") == "5-LOW", "no date")
        .when(status == "O", F.date_format(when, "yyyyMMdd"))
        .when(status == "F", F.date_format(when, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(when, "MM/dd/yyyy"))
    )
    return v.table("orders").select("o_orderkey", fn.parse_date(spelled).alias("ordered"))


@check("int_to_date", """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS ordered
    FROM orders""")
def _(v):
    key = fn.date_to_key(F.col("o_orderdate"))
    key = F.when(F.col("o_orderstatus") == "P", key * 100 + 99).otherwise(key)
    return v.table("orders").select("o_orderkey", fn.key_to_date(key).alias("ordered"))


@check("date_to_int_key", """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_key,
      CAST(strftime(o_orderdate, '%Y%j') AS INTEGER) AS day_of_year_key FROM orders""")
def _(v):
    when = F.col("o_orderdate")
    return v.table("orders").select(
        "o_orderkey",
        fn.date_to_key(when).alias("day_key"),
        fn.date_to_day_of_year_key(when).alias("day_of_year_key"),
    )


@check("epoch_millis_in_zone", """
    SELECT event_id,
      CAST(round_even((epoch_us(ts) - 25200000000) / 1000.0, 0) AS BIGINT) AS millis,
      CAST(round_even((epoch_us(ts) - 25200000000) / 1000000.0, 0) AS BIGINT) AS seconds
    FROM events""")
def _(v):
    return v.table("events").select(
        "event_id",
        fn.epoch(F.col("ts")).alias("millis"),
        fn.epoch(F.col("ts"), millis=False).alias("seconds"),
    )


@check("remove_symbols", """
    SELECT event_id, regexp_replace(props, '[{}"]', '', 'g') AS bare,
      regexp_replace(props, '[0-9]', '#', 'g') AS masked FROM events""")
def _(v):
    return v.table("events").select(
        "event_id",
        fn.remove_symbols(F.col("props"), '{}"').alias("bare"),
        fn.remove_symbols(F.col("props"), "0-9", "#").alias("masked"),
    )


@check("replace_pairs", """
    SELECT p_partkey, replace(replace(p_name, 'red', 'blue'), 'blue', 'green') AS renamed FROM part""")
def _(v):
    pairs = [("red", "blue"), ("blue", "green")]
    return v.table("part").select("p_partkey", fn.replace_pairs(F.col("p_name"), pairs).alias("renamed"))


@check("next_day_key", """
    SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + 1, '%Y%m%d') AS next_day FROM orders""")
def _(v):
    key = F.date_format("o_orderdate", "yyyyMMdd")
    return v.table("orders").select("o_orderkey", fn.next_day_key(key).alias("next_day"))
