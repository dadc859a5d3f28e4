"""The given tables seen as the warehouse's tables: once for Spark, once as SQL.

Codes, flags and validity windows come from column values; every view covers its whole table.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayside.contracts import DANGEROUS, EQUIPMENT, MOVES, OVERSIZE, PREGATE, untyped
from quayside.functions import slice_key
from quayside.plans.yard import YardTables
from quayside.settings import materialize

DATE_COLUMNS = [f.name for f in MOVES.fields if f.dataType.typeName() == "date"]


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def day(iso: str) -> Column:
    return F.lit(iso).cast("date")


def scrambled(nth):
    """The id of the nth commit of the versioned table."""
    return nth * 611953 % 1000003


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- stage tables -------------------------------------------------------------------

    @cached_property
    def moves(self) -> DataFrame:
        return self._moves_of(self.table("lineitem"))

    def _moves_of(self, lineitem: DataFrame) -> DataFrame:
        line, shipped = F.col("l_linenumber"), F.col("l_shipdate").cast("date")
        columns = {
            "ITEM_KEY": F.col("l_orderkey").cast("string"),
            "EXEC_TS": shipped,
            "MOVE_TYPE": F.when(line == 7, "TRANS").when(F.col("l_linestatus") == "O", "LIFTON")
            .otherwise("LIFTOFF"),
            "CAT_TYPE": F.when(F.col("l_returnflag") == "N", "INTERNAL").otherwise("YARD"),
            "IN_OUT": F.when(line.isin(1, 5), "IN").when(line == 2, "OUT")
            .when(line.isin(3, 6), "LIFTON").otherwise("LIFTOFF"),
            "ITEM_NO": text("CN", F.col("l_orderkey"), "-", line, "-", F.col("l_partkey"), "-",
                            F.col("l_suppkey")),
            "FEL": F.when(F.col("l_quantity") > 25, "F").otherwise("E"),
            "ISO": text("45", F.substring(F.lit("RG34UTP"), line, F.lit(1)), "1"),
            "LENGTH": F.when(F.col("l_quantity") > 30, "40").otherwise("20"),
            "BILL_TYPE": F.col("l_returnflag"),
            "CHE_ID": F.when(F.col("l_discount") < 0.005, "TOP").when(F.col("l_discount") > 0.095, "???")
            .when(F.col("l_tax") > 0.075, " ").otherwise(text("C", F.col("l_suppkey"))),
            "CHE_TYPE": F.when(F.col("l_quantity") > 40, "RTG").otherwise("RS"),
            "CHE_OPER": text("OP", F.col("l_suppkey")),
            "PLACE_OF_DELIVERY": text("D", line),
            "PLACE_OF_RECEIPT": text("Q", line),
            "VES_ID": F.when(F.col("l_returnflag") == "R", text("V", line)),
            "VES_TYPE": F.when(F.col("l_returnflag") == "R", "F").otherwise("M"),
            "INTERNAL_MOVE_CD": text("I", line),
            "HIST_FLG": F.lit("N"),
            "COMPLETE_TS": F.date_add(shipped, 1),
            "STACK": text("S", F.col("l_partkey")),
            "X": line.cast("string"),
            "Y": F.col("l_suppkey").cast("string"),
            "Z": line.cast("string"),
            "TO_STACK": text("S", F.col("l_suppkey")),
            "TO_X": line.cast("string"),
            "TO_Y": F.col("l_partkey").cast("string"),
            "TO_Z": line.cast("string"),
            "CATEGORY": F.col("l_linestatus"),
            "ARR_TS": F.date_add(shipped, -1),
            "DEP_TS": F.date_add(shipped, 2),
            "CREATED_TS": F.date_add(shipped, -3),
            "CREATED_BY": text("user", line),
            "LAST_UPD_TS": shipped,
            "LAST_UPD_BY": text("user", line),
            "OPERATION_METHOD": text("M", F.col("l_suppkey") % 25),
            "TRANSFER_REASON_CD": text("T", line),
            "REPORT_TS": shipped,
            "REPORT_MONTH": F.date_format("l_shipdate", "yyyyMM"),
        }
        return lineitem.select(*[columns[c].alias(c) for c in MOVES.names])

    @cached_property
    def raw_moves(self) -> DataFrame:
        """The moves as they land: text, some of it padded, some dates missing or unreadable."""

        def raw(c: str) -> Column:
            if c in DATE_COLUMNS:
                landed = F.col("_days")[DATE_COLUMNS.index(c)]
            else:
                landed = F.when(F.col("Z") == "2", text("  ", F.col(c), " ")).otherwise(F.col(c))
            if c == "COMPLETE_TS":
                landed = (
                    F.when(F.col("Z") == "3", "31-DEC-00").when(F.col("Z") == "5", "garbage")
                    .when(F.col("Z") != "4", landed)
                )
            return landed.alias(c)

        days = F.transform(F.array(*DATE_COLUMNS), slice_key).alias("_days")
        landed = self._moves_of(self.table("lineitem")).select("*", days)
        return landed.select(*[raw(c) for c in untyped(MOVES).names])

    @cached_property
    def pregate(self) -> DataFrame:
        columns = {
            "R_D": F.when(F.col("o_orderstatus") == "O", "D").otherwise("R"),
            "RECEIVAL_PLACE": text("P", F.col("o_custkey") % 5),
            "PLACE_OF_DELIVERY": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
            "ITEM_KEY": F.col("o_orderkey").cast("string"),
            "TRANSFER_REASON_CD": text("T", F.col("o_custkey") % 12),
            "CRT_TS": F.col("o_orderdate").cast("date"),
            "OPERATION_METHOD": text("M", F.col("o_custkey") % 25),
        }
        return self.table("orders").select(*[columns[c].alias(c) for c in PREGATE.names])

    @cached_property
    def methods(self) -> DataFrame:
        return self.table("nation").select(
            text("M", F.col("n_nationkey")).alias("OPERATION_METHOD"),
            F.col("n_name").alias("OPERATION_NAME"),
            F.when(F.col("n_regionkey") < 3, "Y").otherwise("N").alias("TRANFER_LINK_DEPOT"),
            day("1995-01-01").alias("CRT_TS"),
        )

    @cached_property
    def charges(self) -> DataFrame:
        """Methods of region 2 are charged twice: existence joins see two matches."""
        kinds = F.when(F.col("n_regionkey") == 2, F.array(F.lit("HAND"), F.lit("LIFT"))).otherwise(
            F.array(F.lit("HAND"))
        )
        return self.table("nation").select(
            F.explode(kinds).alias("CHARGE_TYPE"),
            text("M", F.col("n_nationkey")).alias("CHARGE_CD"),
            F.when(F.col("n_regionkey") == 1, "B").otherwise("T").alias("TRANSPORT_TYPE"),
            day("1995-01-01").alias("UPD_TS"),
        )

    @cached_property
    def equipment(self) -> DataFrame:
        first = F.struct(day("1995-01-01").alias("a"), day("1998-12-31").alias("b"))
        second = F.struct(day("1998-12-31").alias("a"), day("2000-12-31").alias("b"))
        windows = F.when(F.col("s_acctbal") > 0, F.array(first, second)).otherwise(F.array(first))
        columns = {
            "COMPANY": text("N", F.col("s_nationkey")),
            "CHE_ID": text("C", F.col("s_suppkey")),
            "AS_AT_TS": F.col("w.a"),
            "EXPIRY_TS": F.col("w.b"),
            "MANAGE_BY": F.when(F.col("s_nationkey") < 12, "PORT").otherwise("CUST"),
            "INTERNAL_CHE_ID": text("I", F.col("s_suppkey")),
            "CRT_TS": F.col("w.a"),
        }
        exploded = self.table("supplier").withColumn("w", F.explode(windows))
        return exploded.select(*[columns[c].alias(c) for c in EQUIPMENT.names])

    @cached_property
    def areas(self) -> DataFrame:
        size = F.col("p_size")
        return self.table("part").select(
            F.col("p_brand").alias("AREA"),
            text("S", F.col("p_partkey")).alias("STACK"),
            day("1995-06-01").alias("FR_DATE"),
            F.date_add(day("1999-01-01"), size * 20).alias("TO_DATE"),
            F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("MANAGE_BY"),
            F.when(size <= 15, "Y").otherwise("N").alias("SCAN_AREA"),
            F.when(size <= 30, "Y").alias("IS_VIRTUAL_HEAP_STACK"),
            F.when((size >= 10) & (size <= 24), "Y").alias("FUMIGATE_AREA"),
            day("1995-06-01").alias("UPD_TS"),
        )

    @cached_property
    def oversize(self) -> DataFrame:
        return self.table("orders").filter("o_orderpriority = '1-URGENT'").select(
            F.col("o_orderkey").cast("string").alias("ITEM_KEY"),
            F.col("o_orderdate").cast("date").alias("UPD_TS"),
        ).select(*OVERSIZE.names)

    @cached_property
    def dangerous(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("ITEM_KEY"),
            F.when(F.col("o_orderpriority") == "2-HIGH", "Y").otherwise("N").alias("CHARGE_FLG"),
            F.col("o_orderdate").cast("date").alias("UPD_TS"),
        ).select(*DANGEROUS.names)

    @cached_property
    def codes(self) -> DataFrame:
        return self.table("nation").select(
            F.when(F.col("n_nationkey") < 9, "CHUYEN_CANG").otherwise("KHAC").alias("CODE_TP"),
            text("T", F.col("n_nationkey")).alias("CODE_REF"),
            day("1995-01-01").alias("UPD_TS"),
            F.col("n_name").alias("DESCR"),
        )

    @property
    def yard(self) -> YardTables:
        return YardTables(
            self.moves, self.pregate, self.methods, self.charges, self.equipment, self.areas,
            self.oversize, self.codes, self.dangerous,
        )

    # ---- dimension and its feed ---------------------------------------------------------

    @cached_property
    def dim(self) -> DataFrame:
        """Arrival places as known before 2000, plus closed versions of the valuable ones."""
        ordered = F.col("o_orderdate").cast("date")
        place = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
        place = F.when(F.col("o_orderstatus") == "P", F.lit("0-OLD")).otherwise(place)
        now = F.struct(
            (F.col("o_orderkey") * 2 + 1).alias("ID"), place.alias("PLACE_OF_DELIVERY"),
            F.lit("A").alias("TRANG_THAI_BG"), ordered.alias("NGAY_HL_BG"),
            day("2099-01-01").alias("NGAY_HH_BG"),
        )
        before = F.struct(
            (F.col("o_orderkey") * 2 + 2).alias("ID"), F.lit("0-FIRST").alias("PLACE_OF_DELIVERY"),
            F.lit("C").alias("TRANG_THAI_BG"), F.date_add(ordered, -30).alias("NGAY_HL_BG"),
            ordered.alias("NGAY_HH_BG"),
        )
        versions = F.when(F.col("o_totalprice") > 400000, F.array(now, before)).otherwise(F.array(now))
        return (
            self.table("orders").filter("o_orderdate < timestamp_ntz '2000-01-01 00:00:00'")
            .select(F.col("o_orderkey").cast("string").alias("ITEM_KEY"), F.explode(versions).alias("v"))
            .select("v.ID", "ITEM_KEY", "v.PLACE_OF_DELIVERY", "v.TRANG_THAI_BG", "v.NGAY_HL_BG",
                    "v.NGAY_HH_BG")
        )

    @cached_property
    def feed(self) -> DataFrame:
        """Arrival places as reported since 1996; a few without a key."""
        return self.table("orders").filter("o_orderdate >= timestamp_ntz '1996-01-01 00:00:00'").select(
            F.when(F.col("o_totalprice") >= 5000, F.col("o_orderkey").cast("string")).alias("ITEM_KEY"),
            F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("PLACE_OF_DELIVERY"),
        )

    # ---- day slices ---------------------------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").withColumn("slice", F.col("ts").cast("date"))

    @property
    def source_slices(self) -> DataFrame:
        return self.events.select("event_id", "event_type", "value", "slice")

    @property
    def stored_slices(self) -> DataFrame:
        """What was landed before: up to the 10th as at the source, then without the errors, from
        the 21st with other values, from the 26th nothing."""
        when = F.col("slice")
        late = (when >= "2024-01-11") & (when < "2024-01-21") & (F.col("event_type") == "error")
        value = F.when(when >= "2024-01-21", F.col("value") + 1).otherwise(F.col("value"))
        return self.source_slices.filter((when < "2024-01-26") & ~late).withColumn("value", value)

    @cached_property
    def params(self) -> DataFrame:
        return self.table("events").groupBy("event_type").agg(F.max("ts").alias("_last")).select(
            text("  ETL_DATE_", F.col("event_type"), " ").alias("MA_THAM_SO"),
            text(" ", F.date_format("_last", "yyyyMMdd")).alias("GIA_TRI"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            text("run_", F.col("user_id")).alias("DAG_ID"),
            kind.alias("JOB_NAME"),
            F.col("ts").alias("TIME_START"),
            (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("TIME_FINISH"),
            F.when(kind == "error", "F").when(kind == "signup", "Q").when(kind == "view", "")
            .otherwise("S").alias("STATUS_JOB"),
            F.when(kind.isin("click", "purchase"), "1").otherwise("0").alias("STATUS_FINISH"),
            F.when(kind == "error", F.col("props")).alias("ERROR_MESSAGE"),
            F.lit("PARALLEL").alias("JOB_TYPE"),
        )

    # ---- versioned table ----------------------------------------------------------------
    # day k of the month: commit 3k+1 appends the morning, 3k+2 the afternoon; up to day 23,
    # 3k+3 overwrites the day without its errors.  Day 20 was committed after rolling back to
    # the end of day 18, so the commits of day 19 are on no one's chain but their own.
    # The nth commit's content is n; its id is scrambled, as ids say nothing about order.

    @cached_property
    def history(self) -> DataFrame:
        base = F.datediff(F.col("slice"), day("2024-01-01")) * 3
        appended = F.struct(
            (base + F.when(F.hour("ts") < 12, 1).otherwise(2)).cast("bigint").alias("content_id"),
            F.col("value").alias("value"),
        )
        corrected = F.struct(
            (base + 3).cast("bigint").alias("content_id"), (F.col("value") * 2).alias("value")
        )
        rewritten = (F.col("slice") < "2024-01-25") & (F.col("event_type") != "error")
        written = F.when(rewritten, F.array(appended, corrected)).otherwise(F.array(appended))
        return self.events.select("slice", "event_id", "ts", F.explode(written).alias("w")).select(
            "slice", "w.content_id", "event_id", "w.value", "ts"
        )

    @cached_property
    def commits(self) -> DataFrame:
        """The commit log, kept as the small table it would be: operators read it several times."""
        ident, nth = F.col("content_id"), (F.col("content_id") - 1) % 3
        first, k = nth == 0, F.datediff(F.col("slice"), day("2024-01-01"))
        parent = (
            F.when(~first, ident - 1).when(k == 0, None).when(k == 20, 57)
            .when(k <= 24, ident - 1).otherwise(ident - 2)
        )
        corrected_at = F.col("slice").cast("timestamp_ntz") + F.expr("INTERVAL 30 HOURS")
        log = self.history.groupBy("slice", "content_id").agg(F.max("ts").alias("_last")).select(
            scrambled(ident).cast("bigint").alias("snapshot_id"),
            scrambled(parent).cast("bigint").alias("parent_id"),
            F.when(nth == 2, corrected_at).otherwise(F.col("_last")).alias("committed_at"),
            F.when(nth == 2, "overwrite").otherwise("append").alias("operation"),
            "slice",
            "content_id",
        )
        return materialize(log, "commits")

    @cached_property
    def refs(self) -> DataFrame:
        top, on = F.max_by("snapshot_id", "content_id"), F.col("slice")
        ident = F.col("content_id")
        named = self.commits.agg(
            F.struct(F.lit("main").alias("name"), F.lit("branch").alias("kind"),
                     top.alias("snapshot_id"), F.lit(None).cast("int").alias("retain_days")).alias("m"),
            F.struct(F.lit("audit").alias("name"), F.lit("branch").alias("kind"),
                     F.max_by("snapshot_id", F.when(on == "2024-01-20", ident)).alias("snapshot_id"),
                     F.lit(None).cast("int").alias("retain_days")).alias("a"),
            F.struct(F.lit("mid").alias("name"), F.lit("tag").alias("kind"),
                     F.max_by("snapshot_id", F.when(on == "2024-01-15", ident)).alias("snapshot_id"),
                     F.lit(31).alias("retain_days")).alias("t"),
        )
        return named.select(F.explode(F.array("m", "a", "t")).alias("r")).select("r.*")


# ---- the same as SQL ------------------------------------------------------------------------


def _raw_column(c: str) -> str:
    if c in DATE_COLUMNS:
        landed = f"upper(strftime({c}, '%d-%b-%y'))"
    else:
        landed = f"CASE WHEN Z = '2' THEN '  ' || {c} || ' ' ELSE {c} END"
    if c == "COMPLETE_TS":
        landed = (
            "CASE Z WHEN '3' THEN '31-DEC-00' WHEN '5' THEN 'garbage' WHEN '4' THEN NULL "
            f"ELSE {landed} END"
        )
    return f"{landed} AS {c}"


VIEW_SQL = {
    "v_moves": """
        SELECT CAST(l_orderkey AS VARCHAR) AS ITEM_KEY,
          CAST(l_shipdate AS DATE) AS EXEC_TS,
          CASE WHEN l_linenumber = 7 THEN 'TRANS' WHEN l_linestatus = 'O' THEN 'LIFTON'
               ELSE 'LIFTOFF' END AS MOVE_TYPE,
          CASE WHEN l_returnflag = 'N' THEN 'INTERNAL' ELSE 'YARD' END AS CAT_TYPE,
          CASE WHEN l_linenumber IN (1, 5) THEN 'IN' WHEN l_linenumber = 2 THEN 'OUT'
               WHEN l_linenumber IN (3, 6) THEN 'LIFTON' ELSE 'LIFTOFF' END AS IN_OUT,
          'CN' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS ITEM_NO,
          CASE WHEN l_quantity > 25 THEN 'F' ELSE 'E' END AS FEL,
          '45' || substr('RG34UTP', l_linenumber, 1) || '1' AS ISO,
          CASE WHEN l_quantity > 30 THEN '40' ELSE '20' END AS LENGTH,
          l_returnflag AS BILL_TYPE,
          CASE WHEN l_discount < 0.005 THEN 'TOP' WHEN l_discount > 0.095 THEN '???'
               WHEN l_tax > 0.075 THEN ' ' ELSE 'C' || l_suppkey END AS CHE_ID,
          CASE WHEN l_quantity > 40 THEN 'RTG' ELSE 'RS' END AS CHE_TYPE,
          'OP' || l_suppkey AS CHE_OPER,
          'D' || l_linenumber AS PLACE_OF_DELIVERY,
          'Q' || l_linenumber AS PLACE_OF_RECEIPT,
          CASE WHEN l_returnflag = 'R' THEN 'V' || l_linenumber END AS VES_ID,
          CASE WHEN l_returnflag = 'R' THEN 'F' ELSE 'M' END AS VES_TYPE,
          'I' || l_linenumber AS INTERNAL_MOVE_CD,
          'N' AS HIST_FLG,
          CAST(l_shipdate AS DATE) + 1 AS COMPLETE_TS,
          'S' || l_partkey AS STACK,
          CAST(l_linenumber AS VARCHAR) AS X,
          CAST(l_suppkey AS VARCHAR) AS Y,
          CAST(l_linenumber AS VARCHAR) AS Z,
          'S' || l_suppkey AS TO_STACK,
          CAST(l_linenumber AS VARCHAR) AS TO_X,
          CAST(l_partkey AS VARCHAR) AS TO_Y,
          CAST(l_linenumber AS VARCHAR) AS TO_Z,
          l_linestatus AS CATEGORY,
          CAST(l_shipdate AS DATE) - 1 AS ARR_TS,
          CAST(l_shipdate AS DATE) + 2 AS DEP_TS,
          CAST(l_shipdate AS DATE) - 3 AS CREATED_TS,
          'user' || l_linenumber AS CREATED_BY,
          CAST(l_shipdate AS DATE) AS LAST_UPD_TS,
          'user' || l_linenumber AS LAST_UPD_BY,
          'M' || (l_suppkey % 25) AS OPERATION_METHOD,
          'T' || l_linenumber AS TRANSFER_REASON_CD,
          CAST(l_shipdate AS DATE) AS REPORT_TS,
          strftime(l_shipdate, '%Y%m') AS REPORT_MONTH
        FROM lineitem""",
    "v_raw_moves": "SELECT " + ", ".join(_raw_column(c) for c in MOVES.names) + " FROM v_moves",
    "v_pregate": """
        SELECT CASE WHEN o_orderstatus = 'O' THEN 'D' ELSE 'R' END AS R_D,
          'P' || (o_custkey % 5) AS RECEIVAL_PLACE,
          nullif(o_orderpriority, '5-LOW') AS PLACE_OF_DELIVERY,
          CAST(o_orderkey AS VARCHAR) AS ITEM_KEY,
          'T' || (o_custkey % 12) AS TRANSFER_REASON_CD,
          CAST(o_orderdate AS DATE) AS CRT_TS,
          'M' || (o_custkey % 25) AS OPERATION_METHOD
        FROM orders""",
    "v_methods": """
        SELECT 'M' || n_nationkey AS OPERATION_METHOD, n_name AS OPERATION_NAME,
          CASE WHEN n_regionkey < 3 THEN 'Y' ELSE 'N' END AS TRANFER_LINK_DEPOT,
          DATE '1995-01-01' AS CRT_TS
        FROM nation""",
    "v_charges": """
        SELECT 'HAND' AS CHARGE_TYPE, 'M' || n_nationkey AS CHARGE_CD,
          CASE WHEN n_regionkey = 1 THEN 'B' ELSE 'T' END AS TRANSPORT_TYPE,
          DATE '1995-01-01' AS UPD_TS
        FROM nation
        UNION ALL
        SELECT 'LIFT', 'M' || n_nationkey, 'T', DATE '1995-01-01' FROM nation WHERE n_regionkey = 2""",
    "v_equipment": """
        SELECT 'N' || s_nationkey AS COMPANY, 'C' || s_suppkey AS CHE_ID, w.a AS AS_AT_TS,
          w.b AS EXPIRY_TS, CASE WHEN s_nationkey < 12 THEN 'PORT' ELSE 'CUST' END AS MANAGE_BY,
          'I' || s_suppkey AS INTERNAL_CHE_ID, w.a AS CRT_TS
        FROM supplier JOIN (VALUES (DATE '1995-01-01', DATE '1998-12-31', false),
                                   (DATE '1998-12-31', DATE '2000-12-31', true)) AS w(a, b, rich)
          ON NOT w.rich OR s_acctbal > 0""",
    "v_areas": """
        SELECT p_brand AS AREA, 'S' || p_partkey AS STACK, DATE '1995-06-01' AS FR_DATE,
          DATE '1999-01-01' + p_size * 20 AS TO_DATE, nullif(p_type, 'ECONOMY') AS MANAGE_BY,
          CASE WHEN p_size <= 15 THEN 'Y' ELSE 'N' END AS SCAN_AREA,
          CASE WHEN p_size <= 30 THEN 'Y' END AS IS_VIRTUAL_HEAP_STACK,
          CASE WHEN p_size BETWEEN 10 AND 24 THEN 'Y' END AS FUMIGATE_AREA,
          DATE '1995-06-01' AS UPD_TS
        FROM part""",
    "v_oversize": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ITEM_KEY, CAST(o_orderdate AS DATE) AS UPD_TS
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "v_dangerous": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ITEM_KEY,
          CASE WHEN o_orderpriority = '2-HIGH' THEN 'Y' ELSE 'N' END AS CHARGE_FLG,
          CAST(o_orderdate AS DATE) AS UPD_TS
        FROM orders""",
    "v_codes": """
        SELECT CASE WHEN n_nationkey < 9 THEN 'CHUYEN_CANG' ELSE 'KHAC' END AS CODE_TP,
          'T' || n_nationkey AS CODE_REF, DATE '1995-01-01' AS UPD_TS, n_name AS DESCR
        FROM nation""",
    "v_dim": """
        SELECT o_orderkey * 2 + 1 AS ID, CAST(o_orderkey AS VARCHAR) AS ITEM_KEY,
          CASE WHEN o_orderstatus = 'P' THEN '0-OLD' ELSE nullif(o_orderpriority, '5-LOW') END
            AS PLACE_OF_DELIVERY,
          'A' AS TRANG_THAI_BG, CAST(o_orderdate AS DATE) AS NGAY_HL_BG,
          DATE '2099-01-01' AS NGAY_HH_BG
        FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
        UNION ALL
        SELECT o_orderkey * 2 + 2, CAST(o_orderkey AS VARCHAR), '0-FIRST', 'C',
          CAST(o_orderdate AS DATE) - 30, CAST(o_orderdate AS DATE)
        FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' AND o_totalprice > 400000""",
    "v_feed": """
        SELECT CASE WHEN o_totalprice >= 5000 THEN CAST(o_orderkey AS VARCHAR) END AS ITEM_KEY,
          nullif(o_orderpriority, '5-LOW') AS PLACE_OF_DELIVERY
        FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'""",
    "v_events": "SELECT *, CAST(ts AS DATE) AS slice FROM events",
    "v_source": "SELECT event_id, event_type, value, slice FROM v_events",
    "v_stored": """
        SELECT event_id, event_type,
          CASE WHEN slice >= DATE '2024-01-21' THEN value + 1 ELSE value END AS value, slice
        FROM v_source
        WHERE slice < DATE '2024-01-26'
          AND NOT (slice >= DATE '2024-01-11' AND slice < DATE '2024-01-21' AND event_type = 'error')""",
    "v_params": """
        SELECT '  ETL_DATE_' || event_type || ' ' AS MA_THAM_SO,
          ' ' || strftime(max(ts), '%Y%m%d') AS GIA_TRI
        FROM events GROUP BY event_type""",
    "v_runs": """
        SELECT 'run_' || user_id AS DAG_ID, event_type AS JOB_NAME, ts AS TIME_START,
          ts + INTERVAL 1 MINUTE AS TIME_FINISH,
          CASE event_type WHEN 'error' THEN 'F' WHEN 'signup' THEN 'Q' WHEN 'view' THEN ''
               ELSE 'S' END AS STATUS_JOB,
          CASE WHEN event_type IN ('click', 'purchase') THEN '1' ELSE '0' END AS STATUS_FINISH,
          CASE WHEN event_type = 'error' THEN props END AS ERROR_MESSAGE,
          'PARALLEL' AS JOB_TYPE
        FROM events""",
    "v_history": """
        SELECT slice, CAST(date_diff('day', DATE '2024-01-01', slice) * 3
            + CASE WHEN hour(ts) < 12 THEN 1 ELSE 2 END AS BIGINT) AS content_id, event_id, value, ts
        FROM v_events
        UNION ALL
        SELECT slice, CAST(date_diff('day', DATE '2024-01-01', slice) * 3 + 3 AS BIGINT), event_id,
          value * 2, ts
        FROM v_events WHERE slice < DATE '2024-01-25' AND event_type <> 'error'""",
    "v_commits": """
        SELECT content_id * 611953 % 1000003 AS snapshot_id,
          611953 * CAST(CASE WHEN (content_id - 1) % 3 > 0 THEN content_id - 1
               WHEN content_id = 1 THEN NULL
               WHEN content_id = 61 THEN 57
               WHEN content_id <= 73 THEN content_id - 1
               ELSE content_id - 2 END AS BIGINT) % 1000003 AS parent_id,
          CASE WHEN (content_id - 1) % 3 = 2 THEN CAST(slice AS TIMESTAMP) + INTERVAL 30 HOUR
               ELSE max(ts) END AS committed_at,
          CASE WHEN (content_id - 1) % 3 = 2 THEN 'overwrite' ELSE 'append' END AS operation,
          slice, content_id
        FROM v_history GROUP BY slice, content_id""",
    "v_refs": """
        SELECT 'main' AS name, 'branch' AS kind, arg_max(snapshot_id, content_id) AS snapshot_id,
          CAST(NULL AS INTEGER) AS retain_days FROM v_commits
        UNION ALL
        SELECT 'audit', 'branch', arg_max(snapshot_id, content_id), NULL FROM v_commits WHERE slice = DATE '2024-01-20'
        UNION ALL
        SELECT 'mid', 'tag', arg_max(snapshot_id, content_id), 31 FROM v_commits WHERE slice = DATE '2024-01-15'""",
}


def with_views(body: str, **more: str) -> str:
    """``body`` with every view it needs, directly or not, as a CTE; ``more`` adds or redefines."""
    views = {**VIEW_SQL, **more}
    needed: dict[str, str] = {}

    def need(sql: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bv_\w+", sql)):
            if name in views and name not in needed:
                definition = views[name]
                # a recursive view names itself
                need(re.sub(rf"\b{name}\b", "", definition))
                needed[name] = definition

    need(body)
    if not needed:
        return body
    ctes = [f"{name} AS ({definition})" for name, definition in needed.items()]
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body
