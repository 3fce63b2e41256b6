"""Column functions whose meaning differs from Spark's built-ins of the same name."""

from tidewright.functions.dates import days_crossed, in_years, months_crossed, on_days
from tidewright.functions.json import json_value, scalar_at, with_scalars
from tidewright.functions.text import any_case, contains_ignoring_case, dashed_phone, title_case, visible_length

__all__ = [
    "any_case",
    "contains_ignoring_case",
    "dashed_phone",
    "days_crossed",
    "in_years",
    "json_value",
    "months_crossed",
    "on_days",
    "scalar_at",
    "title_case",
    "visible_length",
    "with_scalars",
]
