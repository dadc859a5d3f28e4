"""The report against a step-by-step reading of its rules, on hand-made rows."""

from datetime import date

import pytest

from quayside.contracts import REPORT
from quayside.plans import yard
from .conftest import bag

D = date(2024, 1, 10)
WINDOW = (date(2024, 1, 1), date(2024, 1, 31))


def move(make, rows):
    """Rows of the columns that matter; the others are NULL."""
    from quayside.contracts import MOVES

    names = ["ITEM_KEY", "MOVE_TYPE", "CAT_TYPE", "IN_OUT", "ISO", "CHE_ID", "STACK", "TO_STACK"]
    full = []
    for row in rows:
        given = dict(zip(names, row)) | {"EXEC_TS": D, "ARR_TS": date(2024, 1, 9), "DEP_TS": date(2024, 1, 12)}
        full.append(tuple(given.get(c) for c in MOVES.names))
    return make(full, MOVES)


@pytest.fixture
def tables(make):
    from quayside import contracts as c

    def of(schema, *rows):
        return make([tuple(r.get(n) for n in schema.names) for r in rows], schema)

    return yard.YardTables(
        moves=move(make, [
            ("i1", "LIFTON", "YARD", "LIFTON", "45R1", "C1", "S1", "S2"),
            ("i1", "LIFTOFF", "YARD", "LIFTOFF", "45G1", "C1", "S1", "S2"),
            ("i2", "LIFTOFF", "YARD", "IN", None, "C2", "S1", "S2"),
            ("i3", "LIFTON", "YARD", "OUT", "", "C1", "S9", "S9"),
            ("i1", "LIFTON", "INTERNAL", "LIFTON", "45R1", "C1", "S1", "S2"),
            ("i1", "TRANS", "YARD", "LIFTON", "45R1", "C1", "S1", "S2"),
            ("i1", "LIFTON", "YARD", "LIFTON", "45R1", "TOP", "S1", "S2"),
            ("i4", "LIFTON", "YARD", "LIFTON", "45R1", "C1", "S1", "S2"),
        ]),
        pregate=of(c.PREGATE,
                   dict(ITEM_KEY="i1", R_D="D", OPERATION_METHOD="M1", TRANSFER_REASON_CD="T1",
                        PLACE_OF_DELIVERY="PD", RECEIVAL_PLACE="RP"),
                   dict(ITEM_KEY="i2", R_D="R", OPERATION_METHOD="M1", PLACE_OF_DELIVERY="PD",
                        RECEIVAL_PLACE="RP"),
                   dict(ITEM_KEY="i3", R_D="D", OPERATION_METHOD="M1", TRANSFER_REASON_CD="T9"),
                   dict(ITEM_KEY="i4", R_D="D", OPERATION_METHOD="M2")),
        methods=of(c.METHODS, dict(OPERATION_METHOD="M1", OPERATION_NAME="one", TRANFER_LINK_DEPOT="Y"),
                   dict(OPERATION_METHOD="M2", OPERATION_NAME="two", TRANFER_LINK_DEPOT="N")),
        charges=of(c.CHARGES, dict(CHARGE_CD="M1", TRANSPORT_TYPE="T"), dict(CHARGE_CD="M1", TRANSPORT_TYPE="B")),
        equipment=of(c.EQUIPMENT, dict(CHE_ID="C1", COMPANY="co", AS_AT_TS=WINDOW[0], EXPIRY_TS=WINDOW[1],
                                       MANAGE_BY="mb", INTERNAL_CHE_ID="int")),
        areas=of(c.YARD_AREAS,
                 dict(AREA="A1", STACK="S1", FR_DATE=WINDOW[0], TO_DATE=WINDOW[1], MANAGE_BY="m1",
                      SCAN_AREA="Y", FUMIGATE_AREA="Y", IS_VIRTUAL_HEAP_STACK="Y"),
                 dict(AREA="A2", STACK="S2", FR_DATE=WINDOW[0], TO_DATE=WINDOW[1],
                      FUMIGATE_AREA="Y", IS_VIRTUAL_HEAP_STACK="Y")),
        oversize=of(c.OVERSIZE, dict(ITEM_KEY="i2"), dict(ITEM_KEY="i2")),
        codes=of(c.CODES, dict(CODE_TP="CHUYEN_CANG", CODE_REF="T1", DESCR="reason"),
                 dict(CODE_TP="OTHER", CODE_REF="T9", DESCR="wrong")),
        dangerous=of(c.DANGEROUS, dict(ITEM_KEY="i1", CHARGE_FLG="Y"), dict(ITEM_KEY="i2", CHARGE_FLG="N")),
    )


def test_report(tables):
    report = yard.yard_moves_enriched(tables, 20240110)
    assert report.columns == REPORT.names and len(report.columns) == 37
    rows = {(r.ITEM_KEY, r.ROW_ID): r for r in report.collect()}
    # i1 only as lifted on (a delivery); i2 twice, being listed twice as oversize; i4 has no depot method
    assert sorted(rows) == [("i1", 1), ("i2", 2), ("i2", 3), ("i3", 4)]
    r = rows["i1", 1]
    assert (r.CHE_ID, r.COMPANY, r.MANAGEBY) == ("int", "co", "mb")
    assert (r.YARD_AREA_FR, r.YARD_AREA_TO, r.FROM_MANAGE_REPORT, r.TO_MANAGE_REPORT) == ("A1", " ", "m1", " ")
    assert (r.IS_REEFER, r.IS_OOG, r.IS_DANGEROUS, r.IS_SCAN, r.IS_VIRTUAL_SCAN) == ("Y", " ", "Y", "Y", " ")
    assert (r.PLACE_OF_DELIVERY, r.PLACE_OF_RECEIPT) == ("PD", "CTL")
    assert r.EXEC_TS == r.OLD_EXEC_TS == date(2024, 1, 12)
    assert r.OPERATION_NAME == "Chuyển depot reason Soi" and r.ETL_DATE == 20240110
    r = rows["i2", 2]
    assert (r.CHE_ID, r.YARD_AREA_FR, r.YARD_AREA_TO, r.TO_MANAGE_REPORT) == (" ", " ", "A2", " ")
    assert (r.IS_REEFER, r.IS_OOG, r.IS_DANGEROUS, r.IS_SCAN) == (" ", "Y", " ", " ")
    assert r.OPERATION_NAME == "Hạ từ depot one Khử trùng" and r.EXEC_TS == date(2024, 1, 9)
    assert rows["i3", 4].OPERATION_NAME == "Chuyển depot one "


def test_views_on_the_report(tables):
    report = yard.yard_moves_enriched(tables, 20240110)
    view = yard.external_transport(report, 20240111)
    assert {r.ETL_DATE for r in view.collect()} == {20240111} and view.columns == REPORT.names
    totals = yard.yard_throughput(view, 20240111)
    assert sorted(r.TOTALCONT for r in totals.collect()) == [1, 1, 2]


def test_time_buckets_leave_the_report_alone(tables):
    from quayside.operators.joins import Buckets

    buckets = Buckets(7, "2024-01-01", "2024-02-01")
    assert bag(yard.report_rows(tables, buckets)) == bag(yard.report_rows(tables))
