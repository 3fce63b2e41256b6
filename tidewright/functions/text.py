"""Text functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def visible_length(column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(column))


def contains_ignoring_case(column, needle: str) -> Column:
    """Case-insensitive substring match; % and _ in the needle keep their pattern meaning."""
    return F.ilike(column, F.lit(f"%{needle}%"))


def title_case(column) -> Column:
    """Trim, then upper-case the first letter of every run of letters and lower-case the others.

    Digits, apostrophes and combining marks end a run, so "o'neil" gives "O'Neil" where initcap would
    give "O'neil".
    """
    trimmed = F.regexp_replace(column, r"(?U)^\s+|\s+$", "")
    runs = F.regexp_extract_all(trimmed, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.lower(F.substr(run, F.lit(2))))),
        "",
    )


def dashed_phone(column) -> Column:
    """Ten characters become ddd-ddd-dddd; any other length stays as it is."""
    column = F.col(column) if isinstance(column, str) else column
    dashed = F.concat_ws("-", F.substring(column, 1, 3), F.substring(column, 4, 3), F.substring(column, 7, 4))
    return F.when(F.length(column) == 10, dashed).otherwise(column)


def any_case(column) -> Column:
    """The text under a collation that ignores case, so that filters, joins, groups and distinct values all do.

    Compare it with columns of the same kind; F.collate(column, "UTF8_BINARY") gives the plain text back.
    """
    return F.collate(column, "UTF8_LCASE")
