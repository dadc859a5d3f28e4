"""Joins, aggregates, numbering, comparison and the report."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.contracts import REPORT, THROUGHPUT_BY
from quayside.operators import joins as j
from quayside.operators.aggregate import count_rows, group_by_filter, group_measures
from quayside.operators.compare import diff_rows, except_distinct
from quayside.operators.facts import DimensionKey, fact_surrogate_lookup
from quayside.operators.numbering import global_row_id
from quayside.plans import yard
from quayside.sources.readers import read_sql

from .registry import check

BY_ITEM = [("ITEM_KEY", "ITEM_KEY")]
BUCKETS = j.Buckets(90, "1995-01-01", "2001-12-31")


@check("enrich_left", """
    SELECT m.ITEM_KEY, m.ITEM_NO, o.UPD_TS AS UPD_TS_oog
    FROM v_moves m LEFT JOIN v_oversize o ON m.ITEM_KEY = o.ITEM_KEY""")
def _(v):
    return j.enrich(v.moves, v.oversize, BY_ITEM, ["UPD_TS"], "oog", keep=["ITEM_KEY", "ITEM_NO"])


@check("enrich_inner", """
    SELECT m.ITEM_NO, p.R_D AS R_D_gate, p.PLACE_OF_DELIVERY AS PLACE_OF_DELIVERY_gate
    FROM v_moves m JOIN v_pregate p ON m.ITEM_KEY = p.ITEM_KEY""")
def _(v):
    return j.enrich(
        v.moves, v.pregate, BY_ITEM, ["R_D", "PLACE_OF_DELIVERY"], "gate", "inner", ["ITEM_NO"]
    )


@check("join_equi_plus_theta", """
    SELECT m.ITEM_NO, m.MOVE_TYPE, p.R_D AS R_D_gate
    FROM v_moves m JOIN v_pregate p ON m.ITEM_KEY = p.ITEM_KEY
      AND (p.R_D = 'R' AND m.MOVE_TYPE = 'LIFTOFF' OR p.R_D = 'D' AND m.MOVE_TYPE = 'LIFTON')""")
def _(v):
    receipt = (F.col("lookup.R_D") == "R") & (F.col("src.MOVE_TYPE") == "LIFTOFF")
    delivery = (F.col("lookup.R_D") == "D") & (F.col("src.MOVE_TYPE") == "LIFTON")
    on = (F.col("src.ITEM_KEY") == F.col("lookup.ITEM_KEY")) & (receipt | delivery)
    return j.enrich(v.moves, v.pregate, on, ["R_D"], "gate", "inner", ["ITEM_NO", "MOVE_TYPE"])


@check("join_inner_filtered_dim", """
    SELECT p.ITEM_KEY, o.OPERATION_NAME AS OPERATION_NAME_oper
    FROM v_pregate p JOIN v_methods o ON p.OPERATION_METHOD = o.OPERATION_METHOD
      AND o.TRANFER_LINK_DEPOT = 'Y'""")
def _(v):
    depot = v.methods.filter("TRANFER_LINK_DEPOT = 'Y'")
    on = [("OPERATION_METHOD", "OPERATION_METHOD")]
    return j.enrich(v.pregate, depot, on, ["OPERATION_NAME"], "oper", "inner", ["ITEM_KEY"])


@check("join_existence_inner", """
    SELECT p.* FROM v_pregate p JOIN v_charges c ON p.OPERATION_METHOD = c.CHARGE_CD
      AND c.TRANSPORT_TYPE <> 'B'""")
def _(v):
    by_road = v.charges.filter("TRANSPORT_TYPE <> 'B'")
    return j.existence_join(v.pregate, by_road, [("OPERATION_METHOD", "CHARGE_CD")])


@check("join_existence_semi", """
    SELECT p.* FROM v_pregate p WHERE EXISTS (
      SELECT 1 FROM v_charges c WHERE p.OPERATION_METHOD = c.CHARGE_CD AND c.TRANSPORT_TYPE <> 'B')""")
def _(v):
    by_road = v.charges.filter("TRANSPORT_TYPE <> 'B'")
    return j.existence_join(v.pregate, by_road, [("OPERATION_METHOD", "CHARGE_CD")], once=True)


_VALIDITY = """
    SELECT m.ITEM_NO, m.CHE_ID, m.EXEC_TS, e.INTERNAL_CHE_ID AS INTERNAL_CHE_ID_m,
      e.AS_AT_TS AS AS_AT_TS_m
    FROM v_moves m LEFT JOIN v_equipment e ON e.CHE_ID <> ' ' AND m.CHE_ID = e.CHE_ID
      AND m.EXEC_TS >= e.AS_AT_TS AND m.EXEC_TS <= e.EXPIRY_TS"""


def _equipment_at(v, buckets):
    moves = v.moves.select("ITEM_NO", "CHE_ID", "EXEC_TS")
    return j.validity_join(
        moves, v.equipment.filter("CHE_ID <> ' '"), [("CHE_ID", "CHE_ID")], "EXEC_TS",
        ("AS_AT_TS", "EXPIRY_TS"), ["INTERNAL_CHE_ID", "AS_AT_TS"], "m", buckets=buckets,
    )


@check("join_validity_left", _VALIDITY)
def _(v):
    return _equipment_at(v, None)


@check("join_validity_buckets", _VALIDITY)
def _(v):
    return _equipment_at(v, BUCKETS)


@check("join_validity_two_roles", """
    SELECT m.ITEM_NO, m.MOVE_TYPE, a.AREA AS AREA_from, a.SCAN_AREA AS SCAN_AREA_from,
      b.AREA AS AREA_to, b.SCAN_AREA AS SCAN_AREA_to
    FROM v_moves m
    LEFT JOIN v_areas a ON m.MOVE_TYPE = 'LIFTON' AND m.STACK = a.STACK
      AND m.EXEC_TS >= a.FR_DATE AND m.EXEC_TS <= a.TO_DATE
    LEFT JOIN v_areas b ON m.MOVE_TYPE = 'LIFTOFF' AND m.TO_STACK = b.STACK
      AND m.EXEC_TS >= b.FR_DATE AND m.EXEC_TS <= b.TO_DATE""")
def _(v):
    joined = j.validity_join_by_role(
        v.moves, v.areas, "MOVE_TYPE", {"LIFTON": ("STACK", "from"), "LIFTOFF": ("TO_STACK", "to")},
        "STACK", "EXEC_TS", ("FR_DATE", "TO_DATE"), ["AREA", "SCAN_AREA"],
    )
    return joined.select("ITEM_NO", "MOVE_TYPE", "AREA_from", "SCAN_AREA_from", "AREA_to", "SCAN_AREA_to")


@check("flag_exists_left", """
    SELECT m.ITEM_KEY, m.ITEM_NO, CASE WHEN o.ITEM_KEY IS NULL THEN ' ' ELSE 'Y' END AS IS_OOG
    FROM v_moves m LEFT JOIN v_oversize o ON m.ITEM_KEY = o.ITEM_KEY""")
def _(v):
    return j.flag_exists(v.moves.select("ITEM_KEY", "ITEM_NO"), v.oversize, BY_ITEM, "IS_OOG")


@check("flag_exists_filtered", """
    SELECT m.ITEM_KEY, m.ITEM_NO, CASE WHEN d.ITEM_KEY IS NULL THEN ' ' ELSE 'Y' END AS IS_DANGEROUS
    FROM v_moves m LEFT JOIN v_dangerous d ON d.CHARGE_FLG = 'Y' AND m.ITEM_KEY = d.ITEM_KEY""")
def _(v):
    charged = v.dangerous.filter("CHARGE_FLG = 'Y'")
    moves = v.moves.select("ITEM_KEY", "ITEM_NO")
    return j.flag_exists(moves, charged, BY_ITEM, "IS_DANGEROUS", unique=True)


@check("code_table_lookup", """
    SELECT p.*, c.DESCR AS DESCR_sys FROM v_pregate p
    LEFT JOIN v_codes c ON c.CODE_TP = 'CHUYEN_CANG' AND p.TRANSFER_REASON_CD = c.CODE_REF""")
def _(v):
    return j.code_table_lookup(v.pregate, v.codes, "CHUYEN_CANG", "TRANSFER_REASON_CD")


@check("enrich_chain", """
    SELECT p.*, o.OPERATION_NAME AS OPERATION_NAME_oper, c.CHARGE_TYPE AS CHARGE_TYPE_charge,
      s.DESCR AS DESCR_sys
    FROM v_pregate p
    JOIN v_methods o ON p.OPERATION_METHOD = o.OPERATION_METHOD AND o.TRANFER_LINK_DEPOT = 'Y'
    LEFT JOIN v_charges c ON p.OPERATION_METHOD = c.CHARGE_CD
    LEFT JOIN v_codes s ON p.TRANSFER_REASON_CD = s.CODE_REF AND s.CODE_TP = 'CHUYEN_CANG'""")
def _(v):
    method = [("OPERATION_METHOD", "OPERATION_METHOD")]
    return j.enrich_chain(v.pregate, [
        j.Lookup(v.methods, method, ["OPERATION_NAME"], "oper", "inner",
                 F.col("TRANFER_LINK_DEPOT") == "Y"),
        j.Lookup(v.charges, [("OPERATION_METHOD", "CHARGE_CD")], ["CHARGE_TYPE"], "charge"),
        j.Lookup(v.codes, [("TRANSFER_REASON_CD", "CODE_REF")], ["DESCR"], "sys",
                 where=F.col("CODE_TP") == "CHUYEN_CANG"),
    ])


@check("scd_full_outer", """
    SELECT d.*, f.ITEM_KEY AS ITEM_KEY_smy, f.PLACE_OF_DELIVERY AS PLACE_OF_DELIVERY_smy
    FROM (SELECT * FROM v_dim WHERE TRANG_THAI_BG = 'A') d
    FULL JOIN v_feed f ON d.ITEM_KEY = f.ITEM_KEY""")
def _(v):
    return j.full_outer(v.dim.filter("TRANG_THAI_BG = 'A'"), v.feed, BY_ITEM, "smy")


@check("count_rows", "SELECT count(*) AS n_rows FROM lineitem")
def _(v):
    return count_rows(v.table("lineitem"))


@check("fact_groupby_sum", """
    SELECT l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS SAN_LUONG
    FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY l_suppkey""")
def _(v):
    rows = v.table("lineitem").withColumn("l_quantity", F.col("l_quantity").cast("decimal(18,2)"))
    grouped = group_by_filter(
        rows, ["l_suppkey"], "l_returnflag", ["R", "A"], [("sum", "l_quantity", "SAN_LUONG")]
    )
    return grouped.withColumn("SAN_LUONG", F.col("SAN_LUONG").cast("double"))


@check("fact_groupby_multi", """
    SELECT CAST(l_shipdate AS DATE) AS NGAY_DL, l_returnflag, count(l_orderkey) AS n,
      min(l_quantity) AS least, max(l_quantity) AS most, count(DISTINCT l_partkey) AS parts,
      CAST(avg(l_linenumber) AS DOUBLE) AS line
    FROM lineitem GROUP BY 1, 2""")
def _(v):
    rows = v.table("lineitem").withColumn("NGAY_DL", F.col("l_shipdate").cast("date"))
    return group_measures(rows, ["NGAY_DL", "l_returnflag"], [
        ("count", "l_orderkey", "n"), ("min", "l_quantity", "least"), ("max", "l_quantity", "most"),
        ("count_distinct", "l_partkey", "parts"), ("avg", "l_linenumber", "line"),
    ])


@check("fact_surrogate_lookup", """
    SELECT CAST(l_shipdate AS DATE) AS NGAY_DL, coalesce(o.ID, -1) AS DIM_METHOD_ID,
      coalesce(e.ID, -1) AS DIM_EQUIPMENT_ID,
      CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS SAN_LUONG, count(*) AS SO_LUOT
    FROM lineitem
    LEFT JOIN (SELECT CAST(n_nationkey + 1 AS BIGINT) AS ID, n_nationkey FROM nation
               WHERE n_regionkey < 3) o ON l_suppkey % 25 = o.n_nationkey
    LEFT JOIN (SELECT s_suppkey + 1 AS ID, s_suppkey FROM supplier WHERE s_acctbal > 0) e
      ON l_suppkey = e.s_suppkey
    GROUP BY 1, 2, 3""")
def _(v):
    facts = v.table("lineitem").select(
        F.col("l_shipdate").cast("date").alias("NGAY_DL"),
        (F.col("l_suppkey") % 25).alias("method"),
        "l_suppkey",
        F.col("l_quantity").cast("decimal(18,2)").alias("LNSD"),
    )
    methods = v.table("nation").filter("n_regionkey < 3").select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("ID"), "n_nationkey"
    )
    equipment = v.table("supplier").filter("s_acctbal > 0").select(
        (F.col("s_suppkey") + 1).alias("ID"), "s_suppkey"
    )
    loaded = fact_surrogate_lookup(
        facts,
        [DimensionKey(methods, [("method", "n_nationkey")], "ID", "DIM_METHOD_ID"),
         DimensionKey(equipment, [("l_suppkey", "s_suppkey")], "ID", "DIM_EQUIPMENT_ID")],
        ["NGAY_DL"],
        [("sum", "LNSD", "SAN_LUONG"), ("count", "LNSD", "SO_LUOT")],
    )
    return loaded.withColumn("SAN_LUONG", F.col("SAN_LUONG").cast("double"))


_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


@check("global_row_id", f"""
    SELECT l_orderkey, {', '.join(_LINE_ORDER)},
      row_number() OVER (ORDER BY l_orderkey, {', '.join(_LINE_ORDER)}) AS ROW_ID
    FROM lineitem""")
def _(v):
    rows = v.table("lineitem").select("l_orderkey", *_LINE_ORDER)
    return global_row_id(rows, ["l_orderkey"], tie_break=_LINE_ORDER)


@check("except_distinct", "SELECT * FROM v_stored EXCEPT SELECT * FROM v_source")
def _(v):
    return except_distinct(v.stored_slices, v.source_slices)


@check("slice_diff_removed", "SELECT *, true AS removed FROM (SELECT * FROM v_stored EXCEPT SELECT * FROM v_source)")
def _(v):
    rows = diff_rows(v.stored_slices, v.source_slices, "removed")
    return rows.drop("_stored", "_source").withColumn("removed", F.lit(True))


@check("slice_diff_symmetric", """
    SELECT *, 'removed' AS side FROM (SELECT * FROM v_stored EXCEPT SELECT * FROM v_source)
    UNION ALL
    SELECT *, 'added' FROM (SELECT * FROM v_source EXCEPT SELECT * FROM v_stored)""")
def _(v):
    rows = diff_rows(v.stored_slices, v.source_slices, "symmetric")
    side = F.when(F.col("_stored") > 0, "removed").otherwise("added")
    return rows.withColumn("side", side).drop("_stored", "_source")


@check("sql_text_scan", """
    SELECT o_orderpriority, count(*) AS n FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY o_orderpriority""")
def _(v):
    return read_sql(
        v.spark,
        "SELECT o_orderpriority, count(*) AS n FROM {placed} "
        "WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) GROUP BY o_orderpriority",
        {"since": "1998-01-01"},
        placed=v.table("orders"),
    )


# ---- the report, joined and derived step by step as the warehouse describes it ----------------

_REPORT_ORDER = ["ITEM_KEY"] + [c for c in REPORT.names if c not in ("ITEM_KEY", "ROW_ID", "ETL_DATE")]
_REPORT_ROWS = """
    SELECT coalesce(e.INTERNAL_CHE_ID, ' ') AS CHE_ID, m.CAT_TYPE, m.MOVE_TYPE,
      m.MOVE_TYPE AS REPORT_MOVE_TYPE,
      coalesce(a.AREA, ' ') AS YARD_AREA_FR, coalesce(b.AREA, ' ') AS YARD_AREA_TO,
      coalesce(a.AREA, ' ') AS FROM_AREA_REPORT, coalesce(a.MANAGE_BY, ' ') AS FROM_MANAGE_REPORT,
      coalesce(b.AREA, ' ') AS TO_AREA_REPORT, coalesce(b.MANAGE_BY, ' ') AS TO_MANAGE_REPORT,
      CASE WHEN substr(m.ISO, 3, 1) IN ('3', '4', 'R') THEN 'Y' ELSE ' ' END AS IS_REEFER,
      CASE WHEN o.ITEM_KEY IS NULL THEN ' ' ELSE 'Y' END AS IS_OOG,
      CASE WHEN d.ITEM_KEY IS NULL THEN ' ' ELSE 'Y' END AS IS_DANGEROUS,
      m.FEL, m.LENGTH, m.ISO, m.BILL_TYPE, m.CHE_OPER, m.CHE_TYPE, m.VES_ID, m.VES_TYPE,
      coalesce(e.COMPANY, ' ') AS COMPANY, coalesce(e.MANAGE_BY, ' ') AS MANAGEBY,
      CASE WHEN m.IN_OUT = 'LIFTON' THEN p.PLACE_OF_DELIVERY ELSE 'CTL' END AS PLACE_OF_DELIVERY,
      CASE WHEN m.IN_OUT = 'LIFTOFF' THEN p.RECEIVAL_PLACE ELSE 'CTL' END AS PLACE_OF_RECEIPT,
      m.IN_OUT, m.ITEM_NO, m.ITEM_KEY, m.REPORT_MONTH,
      CASE WHEN m.IN_OUT = 'LIFTON' THEN m.DEP_TS ELSE m.ARR_TS END AS EXEC_TS,
      CASE WHEN m.IN_OUT = 'LIFTON' THEN m.DEP_TS ELSE m.ARR_TS END AS OLD_EXEC_TS,
      m.TRANSFER_REASON_CD,
      CASE WHEN m.IN_OUT = 'IN' THEN 'Hạ từ depot ' ELSE 'Chuyển depot ' END
        || CASE WHEN s.DESCR IS NOT NULL THEN s.DESCR ELSE q.OPERATION_NAME END
        || CASE WHEN a.IS_VIRTUAL_HEAP_STACK = 'Y' AND a.SCAN_AREA = 'Y' THEN ' Soi'
                WHEN a.IS_VIRTUAL_HEAP_STACK = 'Y' AND a.FUMIGATE_AREA = 'Y' THEN ' Khử trùng'
                WHEN b.IS_VIRTUAL_HEAP_STACK = 'Y' AND b.SCAN_AREA = 'Y' THEN ' Soi'
                WHEN b.IS_VIRTUAL_HEAP_STACK = 'Y' AND b.FUMIGATE_AREA = 'Y' THEN ' Khử trùng'
                ELSE ' ' END AS OPERATION_NAME,
      CASE WHEN a.IS_VIRTUAL_HEAP_STACK = 'Y' AND a.SCAN_AREA = 'Y' THEN 'Y'
           WHEN b.IS_VIRTUAL_HEAP_STACK = 'Y' AND b.SCAN_AREA = 'Y' THEN 'Y'
           ELSE ' ' END AS IS_SCAN,
      ' ' AS IS_VIRTUAL_SCAN
    FROM v_moves m
    JOIN v_pregate p ON m.ITEM_KEY = p.ITEM_KEY
      AND (p.R_D = 'R' AND m.MOVE_TYPE = 'LIFTOFF' OR p.R_D = 'D' AND m.MOVE_TYPE = 'LIFTON')
    JOIN v_methods q ON p.OPERATION_METHOD = q.OPERATION_METHOD AND q.TRANFER_LINK_DEPOT = 'Y'
    JOIN v_charges c ON p.OPERATION_METHOD = c.CHARGE_CD AND c.TRANSPORT_TYPE <> 'B'
    LEFT JOIN v_equipment e ON e.CHE_ID <> ' ' AND m.CHE_ID = e.CHE_ID
      AND m.EXEC_TS >= e.AS_AT_TS AND m.EXEC_TS <= e.EXPIRY_TS
    LEFT JOIN v_areas a ON m.MOVE_TYPE = 'LIFTON' AND m.STACK = a.STACK
      AND m.EXEC_TS >= a.FR_DATE AND m.EXEC_TS <= a.TO_DATE
    LEFT JOIN v_areas b ON m.MOVE_TYPE = 'LIFTOFF' AND m.TO_STACK = b.STACK
      AND m.EXEC_TS >= b.FR_DATE AND m.EXEC_TS <= b.TO_DATE
    LEFT JOIN v_oversize o ON m.ITEM_KEY = o.ITEM_KEY
    LEFT JOIN v_codes s ON s.CODE_TP = 'CHUYEN_CANG' AND p.TRANSFER_REASON_CD = s.CODE_REF
    LEFT JOIN v_dangerous d ON d.CHARGE_FLG = 'Y' AND m.ITEM_KEY = d.ITEM_KEY
    WHERE m.CAT_TYPE = 'YARD' AND m.CHE_ID NOT IN ('???', 'TOP', 'A00', ' ')
      AND m.MOVE_TYPE IN ('LIFTON', 'LIFTOFF')"""
_REPORT = f"""
    SELECT *, row_number() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _REPORT_ORDER)}) AS ROW_ID
    FROM v_report_rows"""
REPORT_VIEWS = {"v_report_rows": _REPORT_ROWS, "v_report": _REPORT}


@check("yard_moves_enriched", "SELECT *, 20231001 AS ETL_DATE FROM v_report", **REPORT_VIEWS)
def _(v):
    return yard.yard_moves_enriched(v.yard, 20231001)


@check("external_transport", "SELECT *, 20231002 AS ETL_DATE FROM v_report", **REPORT_VIEWS)
def _(v):
    return yard.external_transport(yard.yard_moves_enriched(v.yard, 20231001), 20231002)


@check("yard_throughput", f"""
    SELECT {', '.join(THROUGHPUT_BY)}, count(*) AS TOTALCONT, 20231002 AS ETL_DATE
    FROM v_report_rows GROUP BY {', '.join(THROUGHPUT_BY)}""", **REPORT_VIEWS)
def _(v):
    return yard.yard_throughput(yard.report_rows(v.yard), 20231002)


@check("moves_view", """
    SELECT m.MOVE_TYPE, m.CAT_TYPE, m.IN_OUT, m.COMPLETE_TS, m.REPORT_TS, m.VES_TYPE,
      m.OPERATION_METHOD, m.TRANSFER_REASON_CD, q.TRANFER_LINK_DEPOT, p.R_D, q.OPERATION_NAME,
      p.RECEIVAL_PLACE, m.VES_ID, m.ITEM_KEY, m.EXEC_TS, m.ITEM_NO, m.FEL, m.ISO, m.LENGTH,
      m.BILL_TYPE, m.CHE_ID, m.CHE_TYPE, m.CHE_OPER, m.PLACE_OF_DELIVERY, m.PLACE_OF_RECEIPT,
      m.INTERNAL_MOVE_CD, m.HIST_FLG, m.STACK, m.X, m.Y, m.Z, m.TO_STACK, m.TO_X, m.TO_Y, m.TO_Z,
      CAST(NULL AS VARCHAR) AS TO_STACK2, CAST(NULL AS VARCHAR) AS TO_STACK3, m.CATEGORY, m.ARR_TS,
      m.DEP_TS, m.CREATED_TS, m.CREATED_BY, m.LAST_UPD_TS, m.LAST_UPD_BY, m.REPORT_MONTH,
      20231001 AS ETL_DATE
    FROM v_moves m
    JOIN v_pregate p ON m.ITEM_KEY = p.ITEM_KEY
      AND (p.R_D = 'R' AND m.MOVE_TYPE = 'LIFTOFF' OR p.R_D = 'D' AND m.MOVE_TYPE = 'LIFTON')
    LEFT JOIN v_methods q ON p.OPERATION_METHOD = q.OPERATION_METHOD""")
def _(v):
    moves = v.moves.withColumn("ETL_DATE", F.lit(20231001))
    return yard.moves_view(moves, v.pregate, v.methods)
