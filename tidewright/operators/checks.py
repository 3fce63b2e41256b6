"""Expectations on a table that plain files do not enforce."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.joins import distinct_apart, group_apart, without


def check(df: DataFrame, not_null=(), unique=(), references=()) -> DataFrame:
    """Counts of violating rows, one line per rule: (rule, columns, violations).

    not_null: column names. unique: lists of columns; every row beyond the first of its key counts.
    references: (column, other frame, other column); rows whose non-NULL value the other frame lacks.
    Keys are counted before any join, so a hot key is one row with a count when it meets the other side. The
    groups of the first unique key also give the NULL counts, and the values of a reference that is part of it,
    so that the rows are read and shuffled once for all of these.
    """
    parts = []
    missing = [F.count_if(F.col(name).isNull()).alias(f"_null_{name}") for name in not_null]
    base = df.groupBy(*unique[0]).agg(F.count("*").alias("_n"), *missing) if unique else None
    if not_null:
        if base is None:
            nulls = df.agg(*missing)
        else:
            nulls = base.agg(*[F.coalesce(F.sum(f"_null_{name}"), F.lit(0)).alias(f"_null_{name}") for name in not_null])
        nulls = nulls.toDF(*not_null)
        pairs = F.array(*[F.struct(F.lit(name).alias("columns"), F.col(name).alias("violations")) for name in not_null])
        exploded = nulls.select(F.explode(pairs).alias("r"))
        parts.append(exploded.select(F.lit("not_null").alias("rule"), "r.columns", "r.violations"))
    for i, keys in enumerate(unique):
        counted = df.groupBy(*keys).agg(F.count("*").alias("_n")) if i else base
        parts.append(_line(counted, "unique", ",".join(keys), F.sum(F.col("_n") - 1)))
    for column, other, other_column in references:
        rows, times = (base, F.sum("_n")) if unique and column in unique[0] else (df, F.count("*"))
        used = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(times.alias("_n"))
        dangling = without(used, "_key", other.select(other_column))
        parts.append(_line(dangling, "reference", column, F.sum("_n")))
    return reduce(DataFrame.unionByName, parts)


def _line(df: DataFrame, rule: str, columns: str, violations) -> DataFrame:
    total = df.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"))
    return total.select(F.lit(rule).alias("rule"), F.lit(columns).alias("columns"), "violations")


def tag(df: DataFrame, not_null=(), unique=(), references=(), name: str = "broken") -> DataFrame:
    """All rows, each with an array of the rules it breaks, as `rule:columns`, in the order of the arguments; empty for most.

    The rules are those of check(), and so are the numbers of rows that break them. Of the rows of one unique key the first
    stays, in the order of the remaining columns. Only offending keys are joined back to the rows, and they are grouped
    apart, so that Spark can split a hot one. The frame should come straight from files: equal rows are
    told apart by their position in the scan.
    """
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    marks = [F.when(F.col(column).isNull(), F.lit(f"not_null:{column}")) for column in not_null]
    for i, keys in enumerate(unique):
        rest = [c for c in df.columns if c not in keys]
        grouped = group_apart(rows, *keys).agg(F.min(F.struct(*rest, "_row")).alias("_first"), F.count("*").alias("_n"))
        repeated = grouped.filter(F.col("_n") > 1).select(*[F.col(k).alias(f"_k{i}_{j}") for j, k in enumerate(keys)], F.col("_first._row").alias(f"_first{i}"))
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k{i}_{j}")) for j, k in enumerate(keys)])
        rows = rows.join(repeated, same, "left")
        marks.append(F.when(F.col(f"_first{i}") != F.col("_row"), F.lit(f"unique:{','.join(keys)}")))
    for i, (column, other, other_column) in enumerate(references):
        used = distinct_apart(df.filter(F.col(column).isNotNull()), column).toDF(f"_lost{i}")
        lost = without(used, f"_lost{i}", other.select(other_column))
        rows = rows.join(lost, F.col(column) == F.col(f"_lost{i}"), "left")
        marks.append(F.when(F.col(f"_lost{i}").isNotNull(), F.lit(f"reference:{column}")))
    return rows.select(*[F.col(c) for c in df.columns], F.array_compact(F.array(*marks)).alias(name))
