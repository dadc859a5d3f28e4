"""Loading the dimension tables from a day's feed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators.dimension import apply_type1, apply_type2, current_rows, split_changes
from ..operators.projection import keys_not_null, one_per_key
from ..settings import materialize


@dataclass(frozen=True)
class DimensionSpec:
    """What a dimension is keyed by and keeps.  ``latest_by`` decides between feed rows of the
    same key, among equals the largest attributes; without it such rows are an error."""

    keys: tuple[str, ...]
    attributes: tuple[str, ...]
    id_col: str = "ID"
    scd_type: int = 1
    latest_by: tuple[str, ...] = field(default=())


# Columns of the four dimensions; their natural keys are the first column each, for equipment with the start of its window.
ARRIVAL_PLACE = DimensionSpec(("ITEM_KEY",), ("PLACE_OF_DELIVERY",))
DEPARTURE_PLACE = DimensionSpec(("ITEM_KEY",), ("RECEIVAL_PLACE",))
HANDLING_METHOD = DimensionSpec(("OPERATION_METHOD",), ("OPERATION_NAME", "TRANFER_LINK_DEPOT"))
EQUIPMENT = DimensionSpec(("CHE_ID", "AS_AT_TS"), ("COMPANY", "MANAGE_BY", "EXPIRY_TS"))


def load_dimension(
    dim: DataFrame, feed: DataFrame, spec: DimensionSpec, effective_date: str
) -> DataFrame:
    """The dimension after the feed.

    The change set is written out once: numbering the new rows and applying the changes both
    read it, and it is as small as what changed.
    """
    columns = [*spec.keys, *spec.attributes, *spec.latest_by]
    fed = keys_not_null(feed, spec.keys).select(*dict.fromkeys(columns))
    if spec.latest_by:
        fed = one_per_key(fed, spec.keys, spec.latest_by)
    else:  # copies fold; rows that disagree must not be chosen from in silence
        fed = fed.distinct()
        conflict = fed.groupBy(*spec.keys).count().filter("count > 1").select(*spec.keys).first()
        if conflict:
            raise ValueError(f"feed rows of one key disagree, and latest_by is not set: {conflict.asDict()}")
    stored = current_rows(dim) if spec.scd_type == 2 else dim
    changes = materialize(
        split_changes(
            stored, fed, spec.keys, spec.id_col, spec.attributes,
            deletes=spec.scd_type == 2, drop_duplicates=False,
        ),
        "dimension-changes",
    )
    if spec.scd_type == 2:
        return apply_type2(dim, changes, spec.keys, spec.id_col, effective_date)
    return apply_type1(dim, changes, spec.keys, spec.id_col, spec.attributes)
