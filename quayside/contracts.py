"""Column contracts: which columns, in which order and of which type, a stage must emit."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampNTZType(),
}


def contract(columns: str) -> T.StructType:
    """``"ITEM_KEY, EXEC_TS date"`` -> schema; a column without a type is a string.

    (``StructType.fromDDL`` needs a running session, contracts are wanted at import time.)
    """
    fields = []
    for entry in columns.split(","):
        name, *kind = entry.split()
        fields.append(T.StructField(name, _TYPES[kind[0] if kind else "string"]))
    return T.StructType(fields)


def stamped(schema: T.StructType, column: str = "ETL_DATE") -> T.StructType:
    """The summary form of a stage contract: the same columns plus the load day."""
    return T.StructType(schema.fields + [T.StructField(column, T.IntegerType())])


def untyped(schema: T.StructType) -> T.StructType:
    """The landing form of a stage contract: the same names, all strings."""
    return T.StructType([T.StructField(n, T.StringType()) for n in schema.names])


# Column names and their order, as the warehouse tables have them.
MOVES = contract(
    "ITEM_KEY, EXEC_TS date, MOVE_TYPE, CAT_TYPE, IN_OUT, ITEM_NO, FEL, ISO, LENGTH, BILL_TYPE,"
    "CHE_ID, CHE_TYPE, CHE_OPER, PLACE_OF_DELIVERY, PLACE_OF_RECEIPT, VES_ID, VES_TYPE,"
    "INTERNAL_MOVE_CD, HIST_FLG, COMPLETE_TS date, STACK, X, Y, Z, TO_STACK, TO_X, TO_Y, TO_Z,"
    "CATEGORY, ARR_TS date, DEP_TS date, CREATED_TS date, CREATED_BY, LAST_UPD_TS date,"
    "LAST_UPD_BY, OPERATION_METHOD, TRANSFER_REASON_CD, REPORT_TS date, REPORT_MONTH"
)
PREGATE = contract(
    "R_D, RECEIVAL_PLACE, PLACE_OF_DELIVERY, ITEM_KEY, TRANSFER_REASON_CD, CRT_TS date,"
    "OPERATION_METHOD"
)
METHODS = contract("OPERATION_METHOD, OPERATION_NAME, TRANFER_LINK_DEPOT, CRT_TS date")
CHARGES = contract("CHARGE_TYPE, CHARGE_CD, TRANSPORT_TYPE, UPD_TS date")
EQUIPMENT = contract(
    "COMPANY, CHE_ID, AS_AT_TS date, EXPIRY_TS date, MANAGE_BY, INTERNAL_CHE_ID, CRT_TS date"
)
YARD_AREAS = contract(
    "AREA, STACK, FR_DATE date, TO_DATE date, MANAGE_BY, SCAN_AREA, IS_VIRTUAL_HEAP_STACK,"
    "FUMIGATE_AREA, UPD_TS date"
)
OVERSIZE = contract("ITEM_KEY, UPD_TS date")
CODES = contract("CODE_TP, CODE_REF, UPD_TS date, DESCR")
DANGEROUS = contract("ITEM_KEY, CHARGE_FLG, UPD_TS date")

#: the nine stage tables by their warehouse name
STAGE_TABLES = {
    "CHE_PRODUCTIVITY_DETAILS": MOVES,
    "PREGATE_TRANSACT": PREGATE,
    "OPERATION_METHOD": METHODS,
    "CHARGE_CODES": CHARGES,
    "CHE_COMPANY": EQUIPMENT,
    "YARD_AREA": YARD_AREAS,
    "ITEM_OOG": OVERSIZE,
    "SYS_CODES": CODES,
    "ITEM_DANGEROUS": DANGEROUS,
}

# The report, in output order.
REPORT = contract(
    "CHE_ID, CAT_TYPE, MOVE_TYPE, REPORT_MOVE_TYPE, YARD_AREA_FR, YARD_AREA_TO,"
    "FROM_AREA_REPORT, FROM_MANAGE_REPORT, TO_AREA_REPORT, TO_MANAGE_REPORT, IS_REEFER, IS_OOG,"
    "IS_DANGEROUS, FEL, LENGTH, ISO, BILL_TYPE, CHE_OPER, CHE_TYPE, VES_ID, VES_TYPE, COMPANY,"
    "MANAGEBY, PLACE_OF_DELIVERY, PLACE_OF_RECEIPT, IN_OUT, ITEM_NO, ITEM_KEY, REPORT_MONTH,"
    "EXEC_TS date, OLD_EXEC_TS date, ROW_ID bigint, TRANSFER_REASON_CD, OPERATION_NAME, IS_SCAN,"
    "IS_VIRTUAL_SCAN, ETL_DATE int"
)

# The moves view, in output order.
MOVES_VIEW = contract(
    "MOVE_TYPE, CAT_TYPE, IN_OUT, COMPLETE_TS date, REPORT_TS date, VES_TYPE, OPERATION_METHOD,"
    "TRANSFER_REASON_CD, TRANFER_LINK_DEPOT, R_D, OPERATION_NAME, RECEIVAL_PLACE, VES_ID,"
    "ITEM_KEY, EXEC_TS date, ITEM_NO, FEL, ISO, LENGTH, BILL_TYPE, CHE_ID, CHE_TYPE, CHE_OPER,"
    "PLACE_OF_DELIVERY, PLACE_OF_RECEIPT, INTERNAL_MOVE_CD, HIST_FLG, STACK, X, Y, Z, TO_STACK,"
    "TO_X, TO_Y, TO_Z, TO_STACK2, TO_STACK3, CATEGORY, ARR_TS date, DEP_TS date,"
    "CREATED_TS date, CREATED_BY, LAST_UPD_TS date, LAST_UPD_BY, REPORT_MONTH, ETL_DATE int"
)

# What throughput is counted by.
THROUGHPUT_BY = (
    "CHE_ID CAT_TYPE MOVE_TYPE IS_SCAN IS_VIRTUAL_SCAN REPORT_MOVE_TYPE YARD_AREA_FR "
    "YARD_AREA_TO FROM_AREA_REPORT TO_AREA_REPORT FROM_MANAGE_REPORT TO_MANAGE_REPORT FEL "
    "LENGTH ISO BILL_TYPE CHE_OPER CHE_TYPE IS_REEFER IS_OOG IS_DANGEROUS VES_ID VES_TYPE "
    "COMPANY MANAGEBY PLACE_OF_DELIVERY PLACE_OF_RECEIPT IN_OUT TRANSFER_REASON_CD "
    "OPERATION_NAME REPORT_MONTH EXEC_TS"
).split()

PARAMS = contract("MA_THAM_SO, GIA_TRI")
RUN_LOG = contract(
    "DAG_ID, JOB_NAME, TIME_START timestamp, TIME_FINISH timestamp, STATUS_JOB, STATUS_FINISH,"
    "ERROR_MESSAGE, JOB_TYPE"
)
