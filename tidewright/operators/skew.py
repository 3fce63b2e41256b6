"""Joins on keys of which one may hold much of a table, where Spark cannot split it by itself.

AQE splits a hot key only if both sides come straight from an exchange, and of an outer join only the side that is kept.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts into which the rows of a heavy key are spread, and the most keys that are.
PARTS, MOST_HEAVY = 64, 256
#: A key is heavy if it holds more than this part of the rows.
SHARE = 1 / 1000


def heavy_keys(df: DataFrame, key: str, share: float = SHARE, most: int = MOST_HEAVY) -> list:
    """Keys that hold more than this share of the rows, by a frequent-items sketch of bounded size. A light key among
    them would do no harm, nor would a heavy one that is missed do more than load its task."""
    sketch = df.filter(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {most}, {32 * most})").alias("top"), F.count("*").alias("n"))
    row = sketch.first()
    return [item["item"] for item in row["top"] or [] if item["count"] > share * row["n"]]


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", heavy: list | None = None, parts: int = PARTS) -> DataFrame:
    """The join of both frames on the column `key`, for a left side of which some keys hold many rows; the right side
    should have few rows for each of those.

    Rows of a heavy left key are dealt over `parts` values of a salt, and the right rows of these keys are repeated for each of
    them; all other keys are joined as they are. how: inner, left, left_semi or left_anti (a right or full join would
    show the repeated rows; swap the sides for a right one). NULL keys match nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no salted {how} join")
    heavy = heavy_keys(left, key) if heavy is None else heavy
    if not heavy:
        return left.join(right, key, how)
    zero = F.lit(0)
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    salted = left.withColumn("_salt", F.when(F.col(key).isin(heavy), salt).otherwise(zero))
    every = F.when(F.col(key).isin(heavy), F.sequence(zero, F.lit(parts - 1))).otherwise(F.array(zero))
    repeated = right.withColumn("_salt", F.explode(every))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
