"""The road lift-on/lift-off report and the views around it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..contracts import MOVES_VIEW, REPORT, THROUGHPUT_BY
from ..functions import either, first_match, is_reefer, null_to_blank, presence_flag
from ..operators.joins import (
    Buckets,
    code_table_lookup,
    enrich,
    existence_join,
    validity_join,
    validity_join_by_role,
)
from ..operators.numbering import global_row_id
from ..operators.projection import project, stamp

# Codes the report selects by, and the labels it prints.
LIFT_ON, LIFT_OFF = "LIFTON", "LIFTOFF"
DELIVERY, RECEIPT = "D", "R"
YES = "Y"
NO_EQUIPMENT = ("???", "TOP", "A00", " ")
BARGE = "B"
TRANSFER_CODES = "CHUYEN_CANG"
TERMINAL = "CTL"
FROM_DEPOT, BETWEEN_DEPOTS = "Hạ từ depot ", "Chuyển depot "
SCANNED, FUMIGATED = " Soi", " Khử trùng"

_AREA_COLUMNS = ["AREA", "SCAN_AREA", "FUMIGATE_AREA", "MANAGE_BY", "IS_VIRTUAL_HEAP_STACK"]


@dataclass(frozen=True)
class YardTables:
    """What the report reads, each table by its stage contract."""

    moves: DataFrame
    pregate: DataFrame
    methods: DataFrame
    charges: DataFrame
    equipment: DataFrame
    areas: DataFrame
    oversize: DataFrame
    codes: DataFrame
    dangerous: DataFrame


def by_lift(pregate: DataFrame) -> DataFrame:
    """Gate transactions with the move they belong to: a receipt is lifted off, a delivery on.

    As a column it is a second join key.  As a condition on top of ITEM_KEY it would only be
    checked after the moves of an item were brought together in one task.
    """
    lift = F.when(F.col("R_D") == RECEIPT, LIFT_OFF).when(F.col("R_D") == DELIVERY, LIFT_ON)
    return pregate.withColumn("_lift", lift)


ON_GATE = (("ITEM_KEY", "ITEM_KEY"), ("MOVE_TYPE", "_lift"))


def cargo_flags(oversize: DataFrame, charged: DataFrame) -> DataFrame:
    """How often an item is listed as oversize and as charged dangerous cargo."""
    yes, no = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    listed = oversize.select("ITEM_KEY", yes.alias("_oversize"), no.alias("_dangerous")).union(
        charged.select("ITEM_KEY", no, yes)
    )
    return listed.groupBy("ITEM_KEY").agg(
        F.sum("_oversize").alias("N_OVERSIZE"), F.sum("_dangerous").alias("N_DANGEROUS")
    )


def reported_moves(moves: DataFrame) -> DataFrame:
    """Yard lifts by real equipment.  Four further conditions the report states hold for every
    row that passes these three."""
    return moves.filter(
        (F.col("CAT_TYPE") == "YARD")
        & ~F.col("CHE_ID").isin(*NO_EQUIPMENT)
        & F.col("MOVE_TYPE").isin(LIFT_ON, LIFT_OFF)
    )


def transported_items(t: YardTables) -> DataFrame:
    """Per gate transaction everything the report wants to know about the item.

    Method, charge, transfer reason and cargo flags depend on the item and not on the move.
    Settling them here leaves one join between the moves, by far the largest table, and
    everything keyed by item.  The two cargo lists are folded into one lookup for the same
    reason, and because in a chain of joins on one key Spark could not split a hot one.  An item
    listed twice counts twice, as joining the list would have it.
    """
    depot_methods = t.methods.filter(F.col("TRANFER_LINK_DEPOT") == YES)
    by_road = t.charges.filter(F.col("TRANSPORT_TYPE") != BARGE)
    gate = t.pregate.select(
        "ITEM_KEY", "R_D", "OPERATION_METHOD", "TRANSFER_REASON_CD", "PLACE_OF_DELIVERY",
        "RECEIVAL_PLACE",
    )
    by_method = [("OPERATION_METHOD", "OPERATION_METHOD")]
    items = enrich(gate, depot_methods, by_method, ["OPERATION_NAME"], how="inner")
    items = existence_join(items, by_road, [("OPERATION_METHOD", "CHARGE_CD")])
    items = code_table_lookup(items, t.codes, TRANSFER_CODES, "TRANSFER_REASON_CD")
    flags = cargo_flags(t.oversize, t.dangerous.filter(F.col("CHARGE_FLG") == YES))
    counts = ["N_OVERSIZE", "N_DANGEROUS"]
    items = enrich(items, flags, [("ITEM_KEY", "ITEM_KEY")], counts, aggregated=True)
    times = [F.greatest(F.coalesce(n, F.lit(0)), F.lit(1)) for n in counts]
    repeated = items.withColumn("_nth", F.explode(F.sequence(F.lit(1), times[0] * times[1])))
    return by_lift(repeated).drop("_nth", "R_D")


def joined_moves(t: YardTables, buckets: Buckets | None = None) -> DataFrame:
    """Reported moves with item, equipment and yard area columns."""
    items = transported_items(t)
    from_gate = [c for c in items.columns if c not in ("ITEM_KEY", "_lift")]
    moves = enrich(reported_moves(t.moves), items, ON_GATE, from_gate, "gate", how="inner")
    named = t.equipment.filter(F.col("CHE_ID") != " ")
    moves = validity_join(
        moves, named, [("CHE_ID", "CHE_ID")], "EXEC_TS", ("AS_AT_TS", "EXPIRY_TS"),
        ["INTERNAL_CHE_ID", "COMPANY", "MANAGE_BY"], "equipment", buckets=buckets,
    )
    return validity_join_by_role(
        moves, t.areas, "MOVE_TYPE", {LIFT_ON: ("STACK", "from"), LIFT_OFF: ("TO_STACK", "to")},
        "STACK", "EXEC_TS", ("FR_DATE", "TO_DATE"), _AREA_COLUMNS, buckets=buckets,
    )


def _in_heap(side: str, use: str) -> Column:
    return (F.col(f"IS_VIRTUAL_HEAP_STACK_{side}") == YES) & (F.col(f"{use}_AREA_{side}") == YES)


def report_columns() -> dict[str, Column]:
    """The computed columns, all from the joined row: one projection."""
    lift = F.col("IN_OUT")
    scanned = [(_in_heap(side, "SCAN"), YES) for side in ("from", "to")]
    treated = [
        (_in_heap(side, use), label)
        for side in ("from", "to")
        for use, label in (("SCAN", SCANNED), ("FUMIGATE", FUMIGATED))
    ]
    # times of the report replace those of the move, in the "old" column as well
    reported_at = either(lift == LIFT_ON, F.col("DEP_TS"), F.col("ARR_TS"))
    return {
        "CHE_ID": null_to_blank(F.col("INTERNAL_CHE_ID_equipment")),
        "COMPANY": null_to_blank(F.col("COMPANY_equipment")),
        "MANAGEBY": null_to_blank(F.col("MANAGE_BY_equipment")),
        "YARD_AREA_FR": null_to_blank(F.col("AREA_from")),
        "YARD_AREA_TO": null_to_blank(F.col("AREA_to")),
        "FROM_AREA_REPORT": null_to_blank(F.col("AREA_from")),
        "TO_AREA_REPORT": null_to_blank(F.col("AREA_to")),
        "FROM_MANAGE_REPORT": null_to_blank(F.col("MANAGE_BY_from")),
        "TO_MANAGE_REPORT": null_to_blank(F.col("MANAGE_BY_to")),
        "IS_REEFER": is_reefer(F.col("ISO")),
        "IS_OOG": presence_flag(F.nullif(F.col("N_OVERSIZE_gate"), F.lit(0))),
        "IS_DANGEROUS": presence_flag(F.nullif(F.col("N_DANGEROUS_gate"), F.lit(0))),
        "PLACE_OF_DELIVERY": either(
            lift == LIFT_ON, F.col("PLACE_OF_DELIVERY_gate"), F.lit(TERMINAL)
        ),
        "PLACE_OF_RECEIPT": either(lift == LIFT_OFF, F.col("RECEIVAL_PLACE_gate"), F.lit(TERMINAL)),
        "EXEC_TS": reported_at,
        "OLD_EXEC_TS": reported_at,
        "OPERATION_NAME": F.concat(
            either(lift == "IN", F.lit(FROM_DEPOT), F.lit(BETWEEN_DEPOTS)),
            F.coalesce(F.col("DESCR_sys_gate"), F.col("OPERATION_NAME_gate")),
            first_match(treated),
        ),
        "IS_SCAN": first_match(scanned),
        "IS_VIRTUAL_SCAN": F.lit(" "),
        "REPORT_MOVE_TYPE": F.col("MOVE_TYPE"),
    }


def report_rows(t: YardTables, buckets: Buckets | None = None) -> DataFrame:
    """The report without its row numbers, which totals have no use for."""
    computed = report_columns()
    unnumbered = [c for c in REPORT.names if c not in ("ROW_ID", "ETL_DATE")]
    return joined_moves(t, buckets).select(*[
        computed[c].alias(c) if c in computed else F.col(c) for c in unnumbered
    ])


def yard_moves_enriched(t: YardTables, day: int, buckets: Buckets | None = None) -> DataFrame:
    """The report of one load day, 37 columns, numbered by ITEM_KEY.

    Rows of one item are told apart by the other columns (a move's ITEM_NO among them), so the report is written once.
    """
    rows = report_rows(t, buckets)
    others = [c for c in rows.columns if c != "ITEM_KEY"]
    numbered = global_row_id(rows, ["ITEM_KEY"], "ROW_ID", tie_break=others)
    return project(stamp(numbered, ETL_DATE=day), REPORT)


def external_transport(report: DataFrame, day: int) -> DataFrame:
    """The report's columns under a load day of their own."""
    return project(stamp(report.drop("ETL_DATE"), ETL_DATE=day), REPORT)


def moves_view(moves: DataFrame, pregate: DataFrame, methods: DataFrame) -> DataFrame:
    """Moves with their gate transaction and handling method.  The second and third target stack
    have no stated origin and are NULL."""
    gated = enrich(
        moves, by_lift(pregate), ON_GATE, ["R_D", "RECEIVAL_PLACE", "OPERATION_METHOD"], "gate",
        how="inner",
    )
    named = enrich(
        gated, methods, [("OPERATION_METHOD_gate", "OPERATION_METHOD")],
        ["OPERATION_NAME", "TRANFER_LINK_DEPOT"],
    )
    nothing = F.lit(None).cast("string")
    return project(
        named.withColumnsRenamed({"R_D_gate": "R_D", "RECEIVAL_PLACE_gate": "RECEIVAL_PLACE"})
        .withColumns({"TO_STACK2": nothing, "TO_STACK3": nothing}),
        MOVES_VIEW,
    )


def yard_throughput(transport: DataFrame, day: int) -> DataFrame:
    """Containers per combination of the report's dimensions."""
    totals = transport.groupBy(*THROUGHPUT_BY).agg(F.count("*").alias("TOTALCONT"))
    return stamp(totals, ETL_DATE=day)


def throughput_delta(totals: DataFrame, before: YardTables, after: YardTables, day: int) -> DataFrame:
    """Kept totals brought up to a new state of some slices, without counting the others again.

    ``before`` and ``after`` hold the moves of the changed slices as they were and as they are (other tables as
    they are for both: a change there touches every slice).  Rows as they were are taken from the totals, rows as they are
    added; combinations that come to nothing go.
    """
    was, now = (report_rows(t).groupBy(*THROUGHPUT_BY).agg(F.count("*").alias("_n")) for t in (before, after))
    signed = totals.select(*THROUGHPUT_BY, F.col("TOTALCONT").alias("_n")).unionByName(now).unionByName(
        was.withColumn("_n", -F.col("_n")))
    summed = signed.groupBy(*THROUGHPUT_BY).agg(F.sum("_n").alias("TOTALCONT")).filter("TOTALCONT <> 0")
    return stamp(summed, ETL_DATE=day)
