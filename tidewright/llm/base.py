"""What the corpus operators share: names, folds, rows with an identity, intermediate tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.sources.scratch import Scratch, scratch_path

#: Characters that separate words, and the same as a Java or RE2 pattern. bytes.split() cuts at the same six.
BLANKS = " \t\n\x0b\x0c\r"
BLANK = r"[\x20\x09-\x0D]"
NON_BLANK = r"[^\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """Column names that df does not have yet, whatever extra columns it brings."""
    taken = {c.lower() for c in df.columns}
    names = []
    for stem in stems:
        name = f"_{stem}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds. A null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds


def as_bytes(text: Column) -> Column:
    """The text in UTF-8, as the Python helpers take it; null is the empty text."""
    return F.coalesce(text, F.lit("")).cast("binary")


def slices(batches: Iterable[pa.RecordBatch], column: str, rows: int = 256, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches at a number of rows and of bytes in a column, to bound the memory of a step. A single
    longer value is a slice of its own."""
    for batch in batches:
        sizes = batch.column(column)
        sizes = np.asarray(pc.fill_null(pc.binary_length(sizes), 0), dtype=np.int64)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and (i - start >= rows or held + size > most_bytes):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


class Memo:
    """What a worker has computed for distinct keys: up to about 2 * most bytes of it, the recently used ones.

    When the young half is full it becomes the old half; keys met again move back. So frequent keys stay, and a
    key that was dropped is computed again. Keys of over `longest` characters are only passed through: they
    are held until the next call.
    """

    def __init__(self, most: int, longest: int = 64):
        self.most, self.longest = most, longest
        self.young, self.old, self.held, self.passing = {}, {}, 0, []

    @staticmethod
    def _cost(keys: list, values: list) -> int:
        """Bytes of some keys, their values and their places in the dictionary."""
        columns = zip(*[v for v in values if v is not None], strict=True) if values and isinstance(values[0], tuple) else [values]
        sized = [c for c in columns if isinstance(c[0], (str, bytes))] if values else []
        return (200 + 50 * len(sized)) * len(keys) + 2 * sum(map(len, keys)) + sum(sum(map(len, c)) for c in sized)

    def holding(self, keys: set, compute) -> dict:
        """A dictionary that has all these keys; compute(list of keys) gives the missing values in order."""
        for key in self.passing:
            self.held -= self._cost([key], [self.young.pop(key)])
        if self.held > self.most:
            self.old, self.young, self.held = self.young, {}, 0
        young, old = self.young, self.old
        new, again = [], []
        for key in keys.difference(young):
            (again if key in old else new).append(key)
        self.passing = [key for key in new if len(key) > self.longest]
        for own, values in ((again, [old[key] for key in again]), (new, compute(new) if new else [])):
            young.update(zip(own, values, strict=True))
            self.held += self._cost(own, values)
        return young


def count_step(count: Column) -> Column:
    """Positive counts by sixteenths of a power of two, of which there is a bounded number."""
    return F.floor(16 * F.log2(count)).cast("int")


def least_step(sizes: dict[int, int], most: int) -> int:
    """The lowest step from which on, upwards, there are no more than `most` rows; sizes: rows of each step."""
    lowest, held = 1 << 30, 0
    for step in sorted(sizes, reverse=True):
        held += sizes[step]
        if held > most:
            break
        lowest = step
    return lowest


__all__ = ["BLANK", "BLANKS", "NON_BLANK", "Memo", "Scratch", "as_bytes", "count_step", "documents", "fold", "free_names", "least_step", "scratch_path", "slices"]
