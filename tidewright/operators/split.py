"""Conditional split."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split(df: DataFrame, condition: Column, null_to_default=True) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the condition, and the rest.

    A NULL condition goes to the rest. With null_to_default=False the rest holds only rows for which the
    condition is false, and NULL ones are in neither part.
    """
    rest = ~F.coalesce(condition, F.lit(False)) if null_to_default else ~condition
    return df.filter(condition), df.filter(rest)
