"""Consecutive numbers over a whole table without sorting it in one task."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.sources.scratch import Scratch

# monotonically_increasing_id() holds the partition above this many bits and the position below them.
_POSITION_BITS = 33


@F.arrow_udf(T.BooleanType())
def _row_before(flags: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The flag of the row before in the partition; NULL for its first row."""
    last = pa.nulls(1, pa.bool_())
    for own in flags:
        if len(own):
            yield pa.concat_arrays([last, own[:-1]])
            last = own[-1:]
        else:
            yield own


def number_rows(
    df: DataFrame, order_by: list[str], name: str, start: int = 1, scratch: Scratch | None = None, flag: str | None = None
) -> DataFrame:
    """Number all rows start, start+1, ... in the order of `order_by`.

    Rows are range-partitioned and sorted, written once with their place, and numbered by adding the
    sizes of the partitions before theirs. A scan position breaks ties, so equal keys spread over
    several partitions; `df` should come straight from files when its keys repeat. A caller that uses up
    the result itself passes its `scratch`, and closes it. With `flag`, a boolean column without NULLs, the result has
    `_before_<flag>` too: the flag of the row before, and false for the first one.
    """
    ranged = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order_by, "_tie")
        .sortWithinPartitions(*order_by, "_tie")
        .withColumn("_place", F.monotonically_increasing_id())
        .drop("_tie")
    )
    if flag:
        ranged = ranged.withColumn("_flag", _row_before(flag))
    scratch = scratch or Scratch(df.sparkSession, "numbered")
    placed = scratch.cut(ranged).withColumn("_part", F.shiftright("_place", _POSITION_BITS))
    # One row per partition, which is why a window over all of them and a broadcast are both safe.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # The last flag of a partition is that before the first row of the next one.
    last = F.max_by(flag, "_place") if flag else F.lit(False)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_size"), last.alias("_last"))
        .select(
            "_part",
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
            F.lag("_last", 1, False).over(W.orderBy("_part")).alias("_end"),
        )
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    number = (F.col("_before") + position + F.lit(start)).alias(name)
    flags = [F.coalesce("_flag", "_end").alias(f"_before_{flag}")] if flag else []
    return placed.join(F.broadcast(offsets), "_part").select(*df.columns, number, *flags)


def chunk(df: DataFrame, k: int, order_by: str, keep_remainder: bool, name="chunk") -> DataFrame:
    """Split into k runs of floor(n / k) rows each, in the order of a unique, non-NULL key.

    The n - k * floor(n / k) rows after the last run join the last run with keep_remainder, and are left
    out without it; the caller has to say which. Only the key column is sorted: the first key of each run is looked up, and the rows
    themselves, however long, are compared with those k keys where they lie.
    """
    with Scratch(df.sparkSession, "numbered") as scratch:
        numbered = number_rows(df.select(order_by), [order_by], "_index", 0, scratch)
        total = numbered.count()
        size = total // k
        if size == 0:
            starts = {}
        else:
            # At most k + 1 rows.
            at = numbered.filter((F.col("_index") % size == 0) & (F.col("_index") <= k * size)).collect()
            starts = {row["_index"] // size: row[order_by] for row in at}
    if starts:
        _require_unique(df, order_by, list(starts.values()), total)
    column = F.lit(None).cast("int") if size else F.lit(k - 1 if keep_remainder else None).cast("int")
    for number in sorted(starts):
        label = F.lit(number) if number < k else F.lit(k - 1 if keep_remainder else None)
        column = F.when(F.col(order_by) >= F.lit(starts[number]), label.cast("int")).otherwise(column)
    return df.withColumn(name, column).filter(F.col(name).isNotNull())


def _require_unique(df: DataFrame, key: str, values: list, total: int) -> None:
    """A key that repeats at a cut would put rows on the wrong side of it."""
    seen = df.filter(F.col(key).isin(values) | F.col(key).isNull()).groupBy(key).count()
    if not seen.filter(F.col(key).isNull() | (F.col("count") > 1)).isEmpty():
        raise ValueError(f"{key} must be unique and not NULL to cut {total} rows exactly")
