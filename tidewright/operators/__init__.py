"""Operators that Spark has no single call for, composed from its built-in ones."""

from tidewright.operators.checks import check, tag
from tidewright.operators.dedupe import first_per_key, upsert
from tidewright.operators.joins import any_key_left_join, fanout_sum, group_apart, null_safe_not_in, without
from tidewright.operators.keyfilter import key_bitmap, may_contain
from tidewright.operators.numbering import chunk, number_rows
from tidewright.operators.shaping import as_json_array, as_xml, json_lines, nest_by, pivot_sum
from tidewright.operators.skew import heavy_keys, salted_join
from tidewright.operators.split import split

__all__ = [
    "any_key_left_join",
    "as_json_array",
    "as_xml",
    "check",
    "chunk",
    "fanout_sum",
    "first_per_key",
    "group_apart",
    "heavy_keys",
    "json_lines",
    "key_bitmap",
    "may_contain",
    "nest_by",
    "null_safe_not_in",
    "number_rows",
    "pivot_sum",
    "salted_join",
    "split",
    "tag",
    "upsert",
    "without",
]
