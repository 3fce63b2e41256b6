"""Joins that would otherwise become nested loops, broadcasts of unknown size or row explosions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData


def group_apart(df: DataFrame, *keys: str) -> GroupedData:
    """Group by keys for a join on the same keys, leaving the result spread in another way.

    AQE can split a hot key of one join side only if both sides come straight from an exchange. A side
    grouped by the join key alone is spread by it already and would join without one. The added column is
    a function of the keys, so the groups are the same.
    """
    return df.groupBy(F.hash(*keys).alias("_apart"), *keys)


def distinct_apart(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of one column, spread as by group_apart."""
    return df.select(F.hash(key).alias("_apart"), key).distinct().select(key)


def without(left: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose column is not among the values of the one column of `values`; NULL is never among them.

    Written as outer join and filter: Catalyst would push an anti join below a grouping on the left side,
    and all its rows would be shuffled instead of one row per key.
    """
    key = values.columns[0]
    listed = distinct_apart(values.select(F.col(key).alias("_listed")).filter(F.col("_listed").isNotNull()), "_listed")
    return left.join(listed, F.col(column) == F.col("_listed"), "left").filter(F.col("_listed").isNull()).drop("_listed")


def any_key_left_join(
    left: DataFrame, right: DataFrame, left_key: str, right_keys: list[str], known: DataFrame | None = None
) -> DataFrame:
    """Left join on `left_key = k1 OR left_key = k2 ...`.

    An OR condition can only run as a nested loop. Here each right row appears once under each of its
    distinct keys, which makes it an equi join with the same result. Keys of the left side that no right
    row has are added to the right side with NULL columns, so that an inner join keeps every left row:
    Spark can split a hot key of either side of it, where an outer join could only split the left one.
    `known` is a frame of one column with (at least) all left keys; in a chain of such joins it keeps the
    left side, with the joins before it, from being computed twice.
    """
    keys = F.array_distinct(F.array(*[F.col(k).cast(left.schema[left_key].dataType) for k in right_keys]))
    keyed = right.withColumn("_key", F.explode(keys)).filter(F.col("_key").isNotNull())
    wanted = (left.select(left_key) if known is None else known).toDF("_key")
    missing = without(distinct_apart(wanted, "_key"), "_key", keyed.select("_key"))
    padded = keyed.unionByName(missing, allowMissingColumns=True)
    return left.join(padded, F.col(left_key).eqNullSafe(F.col("_key"))).drop("_key")


def fanout_sum(multiplier: DataFrame, valued: DataFrame, key: str, value, out: str) -> DataFrame:
    """Per key, SUM(value) over the join of both frames on the key, without building the join.

    Every row of `valued` meets every row of `multiplier` with its key, so the sum is the sum of one
    side times the row count of the other. Both sides shrink to one row per key before they meet, so a
    hot key costs its rows and not their product.
    """
    value = F.col(value) if isinstance(value, str) else value
    times = multiplier.groupBy(key).agg(F.count("*").alias("_times"))
    sums = valued.groupBy(key).agg(F.sum(value).alias("_sum"))
    return times.join(sums, key).select(key, (F.col("_sum") * F.col("_times")).alias(out))


def null_safe_not_in(left: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose column is NOT IN the single column of `values`, with SQL's treatment of NULL.

    A NULL in the list gives no rows; a NULL on the left gives no row, unless the list is empty. Spark's
    own NOT IN sends the whole list to every executor; here the list is shuffled by value, and only two counts
    of the list are shared.
    """
    values = values.toDF("_value")
    nulls = values.agg(F.count_if(F.col("_value").isNull())).scalar()
    listed = values.agg(F.count("*")).scalar()
    kept = without(left, column, values)
    return kept.filter((nulls == 0) & (F.col(column).isNotNull() | (listed == 0)))
