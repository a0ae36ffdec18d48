"""Relational building blocks over DataFrames."""

from ledgerlake.operators.columns import (
    check_columns,
    flatten_structs,
    label_columns,
    normalise_timestamps,
    override_types,
    select_fields,
)
from ledgerlake.operators.fill import date_spine, zero_fill_daily
from ledgerlake.operators.keyed import first_per_key, key_totals_beside_rows, latest_per_key
from ledgerlake.operators.ordered import neighbour_value
from ledgerlake.operators.setops import tag_union, union_all, union_distinct
from ledgerlake.operators.skew import heavy_hitters, salted_join

__all__ = [
    "check_columns",
    "date_spine",
    "first_per_key",
    "flatten_structs",
    "heavy_hitters",
    "key_totals_beside_rows",
    "label_columns",
    "latest_per_key",
    "neighbour_value",
    "normalise_timestamps",
    "override_types",
    "salted_join",
    "select_fields",
    "tag_union",
    "union_all",
    "union_distinct",
    "zero_fill_daily",
]
