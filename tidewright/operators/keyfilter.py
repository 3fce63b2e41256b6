"""A bitmap of keys of fixed size, to leave out rows before a shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Half a megabyte, whatever the number of keys: it is put into the plan as one value.
BITS = 22
_CELL = 6


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def key_bitmap(df: DataFrame, key: str, bits: int = BITS) -> Column:
    """The bitmap of a column's hashes, as a scalar subquery that is computed once. NULL is a key like others."""
    place = df.select(_place(F.col(key), bits).alias("place"))
    used = place.select(F.shiftright("place", _CELL).alias("id"), F.expr(f"shiftleft(1L, cast(place & {(1 << _CELL) - 1} as int))").alias("bit"))
    used = used.groupBy("id").agg(F.bit_or("bit").alias("bits"))
    cells = df.sparkSession.range(1 << (bits - _CELL)).join(used, "id", "left")
    cell = F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return cells.agg(F.transform(F.sort_array(F.collect_list(cell)), lambda x: x["bits"])).scalar()


def may_contain(bitmap: Column, key: Column, bits: int = BITS) -> Column:
    """False only for keys that are not among those of the bitmap. Others pass the more often, the more keys it has."""
    place = _place(key, bits)
    return F.getbit(F.get(bitmap, F.shiftright(place, _CELL).cast("int")), place.bitwiseAND(F.lit((1 << _CELL) - 1)).cast("int")) == 1
