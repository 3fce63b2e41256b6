"""One row per key."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.joins import group_apart


def first_per_key(
    df: DataFrame, keys: list[str], order_by: list[str] = (), latest=False, for_join=False
) -> DataFrame:
    """The first row of each key in the order of `order_by` (the last one with `latest`).

    All remaining columns break ties, so the result does not depend on how rows are spread. It is a
    minimum (maximum) over one struct per row, which every task reduces before the shuffle: a key with a
    third of all rows costs one row per task, where a window would sort them all in one place. NULL
    sorts before every value. Columns must be orderable (no maps). `for_join` spreads the result as
    group_apart does, for a join on the keys with a table in which a key is hot.
    """
    rest = [name for name in df.columns if name not in keys]
    ordered = [*order_by, *[name for name in rest if name not in order_by]]
    ordered = [name for name in ordered if name in rest]
    if not ordered:
        return df.select(*keys).distinct()
    pick = F.max if latest else F.min
    grouped = group_apart(df, *keys) if for_join else df.groupBy(*keys)
    best = grouped.agg(pick(F.struct(*ordered)).alias("_row"))
    return best.select(*[_from_row(name, keys) for name in df.columns])


def _from_row(name: str, keys: list[str]) -> Column:
    return F.col(name) if name in keys else F.col("_row")[name].alias(name)


def upsert(target: DataFrame, staged: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Staged rows replace target rows with the same key, NULL being a key like others; of several staged rows the
    latest wins.

    The merge procedures behind this step are not public; latest-row-wins is our rule.
    """
    newest = first_per_key(staged, keys, order_by, latest=True)
    listed = newest.select(*[F.col(key).alias(f"_new_{i}") for i, key in enumerate(keys)])
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_new_{i}")) for i, key in enumerate(keys)])
    kept = target.join(listed, same, "left_anti")
    return kept.unionByName(newest.select(*target.columns))
