"""One huge JSON array, cut into its elements by many tasks.

A file is read in pieces that end at a closing brace, wherever lines end, so it splits like any text; where lines are short
and end so, only at these braces, as a piece costs more than its bytes. Whether such a brace closes an element depends on all text before it: on being inside of a string, and on the depth of brackets. A first
pass notes for each split what it does to either state (a small transition table), and the driver combines the tables of a
file in order, a row per split. A second pass knows the state at the begin of its split, and gives out each element
that lies whole in it where it lies. Only the two ends of a split, which belong to elements that others share, are put
together by a shuffle.

Both passes look at the pieces of a batch together, as bytes: nothing loops over strings, brackets or elements in Python.
"""

import json
from collections.abc import Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUOTE, _ESCAPE, _COLON, _OBJECT, _ARRAY, _OBJECT_END = b'"\\:{[}'
#: Keeps quotes, escapes and brackets of a text, and makes zeros of the rest.
_MARKS = bytes(c if c in b'"\\{}[]' else 0 for c in range(256))
#: What may end the pieces. The first is taken for files that have no longer piece than that with it, and the second for others.
_LINE_END, _BRACE, _LONGEST_PIECE = "},\n", "}", 1 << 20
#: Bytes that are looked at together, as a rule.
_TEXT = 1 << 20
#: What stands for an array without a key, and for what is no array.
_PLAIN, _NONE = "[", None


class _Text:
    """Pieces that follow each other, as bytes with what ends them, and where quotes and brackets are."""

    def __init__(self, pieces: pa.Array, end: str):
        joined = pc.binary_join_element_wise(pieces, "", end)
        self.data = joined.buffers()[2][: pc.sum(pc.binary_length(joined)).as_py()]
        kept = np.frombuffer(self.data.to_pybytes().translate(_MARKS), np.uint8)
        marks = np.flatnonzero(kept != 0)
        kinds = kept[marks]
        quote, escape = kinds == _QUOTE, kinds == _ESCAPE
        bracket = ~(quote | escape)
        self.quotes = marks[quote]
        #: Place and kind of the brackets, and how many quotes are before each.
        self.at, self.kind, self.before = marks[bracket], kinds[bracket], np.cumsum(quote, dtype=np.int32)[bracket]
        # A quote after an odd number of escapes goes on with a string or, outside of one, begins one. Others change sides.
        self.escaped = _escaped(self.quotes, marks[escape])
        turns = np.logical_xor.accumulate(~self.escaped)
        again = np.flatnonzero(self.escaped)
        if len(again):
            turns ^= np.concatenate([[False], ~turns[again]])[np.cumsum(self.escaped, dtype=np.int32)]
        #: Whether the text after as many quotes is inside of a string, where its begin is not; where it is, the first differ.
        self.inside = np.concatenate([[False], turns])
        self.differ = again[0] + 1 if len(again) else len(self.inside)

    def brackets(self, quoted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
        """The numbers of the brackets outside of strings, their kinds and whether they open, and whether the text ends inside
        of a string."""
        inside = self.inside
        if quoted:
            inside = np.concatenate([~inside[: self.differ], inside[self.differ :]])
        found = np.flatnonzero(~inside[self.before])
        kind = self.kind[found]
        return found, kind, (kind == _OBJECT) | (kind == _ARRAY), bool(inside[-1])

    def key(self, bracket: int) -> str:
        """The key in quotes of the array that a bracket opens, or _PLAIN."""
        last = self.before[bracket] - 1
        first = last - 1
        while first >= 0 and self.escaped[first]:
            first -= 1
        colon = self._back(self.at[bracket])
        if first < 0 or self.data[colon] != _COLON or self._back(colon) != self.quotes[last]:
            return _PLAIN
        return self.data[self.quotes[first] : self.quotes[last] + 1].to_pybytes().decode(errors="replace")

    def _back(self, place: int) -> int:
        """The last place before that is not blank."""
        place = int(place) - 1
        while place > 0 and self.data[place] in b" \t\r\n":
            place -= 1
        return place

    def cut(self, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The stretches between places, which follow each other."""
        places = np.stack([begins, ends], axis=1).astype(np.int32).ravel()
        between = pa.Array.from_buffers(pa.string(), len(places) - 1, [None, pa.py_buffer(places), self.data])
        return between.take(pa.array(np.arange(0, len(places), 2)))


def _escaped(quotes: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """For each quote, whether an odd number of escapes stands right before it."""
    out = np.zeros(len(quotes), bool)
    if len(escapes) and len(quotes):
        last = np.flatnonzero(np.diff(escapes, append=-1) != 1)
        after = escapes[last[np.diff(last, prepend=-1) % 2 == 1]] + 1
        found = np.minimum(np.searchsorted(quotes, after), len(quotes) - 1)
        out[found[quotes[found] == after]] = True
    return out


def _levels(opens: np.ndarray) -> tuple[np.ndarray, int]:
    """The depth inside of each bracket, relative to the begin, and the change of depth."""
    depth = np.cumsum(np.where(opens, np.int8(1), np.int8(-1)), dtype=np.int64)
    return depth + ~opens, int(depth[-1]) if len(depth) else 0


def _effect(text: _Text, quoted: bool) -> tuple[bool, int, dict[int, str | None]]:
    """What a text does that begins inside of a string or not: inside at its end, change of depth, and what was opened or
    closed last at each depth, relative to its begin: the key of an opened array in quotes, or _PLAIN; _NONE for others."""
    found, kind, opens, quoted = text.brackets(quoted)
    if not len(found):
        return quoted, 0, {}
    level, change = _levels(opens)
    lowest = level.min()
    last = np.zeros(level.max() - lowest + 1, np.int64)
    last[level - lowest] = np.arange(len(level))  # of equal places the last one stays
    opened = {int(lowest) + d: text.key(found[i]) if kind[i] == _ARRAY else _NONE for d, i in enumerate(last)}
    return quoted, change, opened


def _runs(batches: Iterator[pa.RecordBatch], end: str) -> Iterator[tuple[int, int, Iterator[_Text]]]:
    """(file, begin, texts) of each split of a task, in order."""

    def stretches() -> Iterator[tuple[tuple[int, int], pa.Array]]:
        for batch in batches:
            file, start = (batch.column(c).to_numpy() for c in ("file", "start"))
            value = batch.column("value")
            part = np.cumsum(pc.binary_length(value).to_numpy(), dtype=np.int64) // _TEXT
            changes = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1]) | (part[1:] != part[:-1])) + 1
            for a, b in pairwise([0, *changes.tolist(), len(file)] if len(file) else []):
                yield (int(file[a]), int(start[a])), value.slice(a, b - a)

    for key, run in groupby(stretches(), key=lambda x: x[0]):
        yield *key, (_Text(pieces, end) for _, pieces in run)


def _tables(batches: Iterator[pa.RecordBatch], end: str) -> Iterator[pa.RecordBatch]:
    """One row per split: file, start, and its transition table."""
    for file, start, run in _runs(batches, end):
        # Both states are followed side by side, text by text, until they meet.
        first, both = b"", [(False, 0, {}), (True, 0, {})]
        for text in run:
            first = first or text.data.to_pybytes().lstrip(b"\xef\xbb\xbf \t\r\n")[:1]
            effects = {quoted: _effect(text, quoted) for quoted in {quoted for quoted, _, _ in both}}
            for i, (quoted, depth, opened) in enumerate(both):
                quoted, change, more = effects[quoted]
                opened.update({depth + d: key for d, key in more.items()})
                both[i] = quoted, depth + change, opened
        table = json.dumps([first.decode(errors="replace"), *([q, d, sorted(o.items())] for q, d, o in both)])
        yield pa.RecordBatch.from_pydict({"file": [file], "start": [start], "effect": [table]})


def _states(rows: list, key: str | None) -> dict[tuple[int, int], tuple[bool, int, int, bool, bool]]:
    """(file, start) to the state at that place: inside of a string, depth, depth of the elements, whether what is open there
    is the sought array, and whether the place is inside of an element that is an object."""
    out, of, wanted = {}, None, _PLAIN if key is None else json.dumps(key, ensure_ascii=False)
    for row in sorted(rows, key=lambda r: (r["file"], r["start"])):
        first, *effects = json.loads(row["effect"])
        if row["file"] != of:
            of, quoted, depth, inside, is_object = row["file"], False, 0, False, False
            base = 1 if key is None else 2 if first != "[" else 3
        out[row["file"], row["start"]] = quoted, depth, base, inside, inside and is_object and depth > base
        quoted, change, opened = effects[int(quoted)]
        for at, found in opened:
            if depth + at == base:
                inside = found == wanted
            elif depth + at == base + 1:
                is_object = found is _NONE
        depth += change
    return out


def _elements(
    run: Iterator[_Text], quoted: bool, depth: int, base: int, inside: bool, active: bool, wanted: str
) -> Iterator[tuple[int, pa.Array]]:
    """(kind, texts) of a split: 1 for elements that lie whole in it, 0 for the end of one from before, 2 for the
    begin of one that goes on, 3 for a split inside of one element."""
    held, shared = [], active
    for text in run:
        found, kind, opens, quoted = text.brackets(quoted)
        level, change = _levels(opens)
        level += depth
        depth += change
        # What is open at the depth of the sought array changes at these places.
        turns = np.flatnonzero(level == base)
        sought = np.array([inside, *(bool(kind[i] == _ARRAY and text.key(found[i]) == wanted) for i in turns)])
        inside = bool(sought[-1])
        begins = np.flatnonzero((level == base + 1) & (kind == _OBJECT))
        begins = begins[sought[np.searchsorted(turns, begins)]]
        ends = np.flatnonzero((level == base + 1) & (kind == _OBJECT_END))
        bounds = np.sort(np.concatenate([begins, ends]))
        begin = opens[bounds]
        places = text.at[found[bounds]] + ~begin
        if active:
            held.append(text.data[: places[0] if len(places) else None].to_pybytes())
            if len(places):
                yield 0 if shared else 1, pa.array([b"".join(held)]).cast(pa.string())
                held, active, shared = [], False, False
        whole = np.flatnonzero(begin[:-1] & ~begin[1:])
        if len(whole):
            yield 1, text.cut(places[whole], places[whole + 1])
        if len(places) and begin[-1]:
            held, active = [text.data[places[-1] :].to_pybytes()], True
    if active:
        yield 3 if shared else 2, pa.array([b"".join(held)]).cast(pa.string())


def array_elements(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """The objects of the array that each file below path is, or of the arrays under one key of the document (or of each of the
    documents of an array) that it is, as text, in `value`.

    Files are UTF-8 and may have any line ends, or none. Elements other than objects are left out. In a file that is no JSON the
    elements up to its fault are given.
    """
    if key is not None and "}" in key:
        raise ValueError(f"pieces end at braces, which the key {key!r} has")
    wanted = _PLAIN if key is None else json.dumps(key, ensure_ascii=False)
    end = _LINE_END if _short_pieces(spark, path, _LINE_END) else _BRACE
    pieces = spark.read.option("lineSep", end).text(path)
    # Every piece tells its split, so the file is a hash of its path.
    pieces = pieces.select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    # A row per split, which is a hundred MB of text as a rule.
    tables = pieces.mapInArrow(lambda batches: _tables(batches, end), "file long, start long, effect string").collect()
    shared = spark.sparkContext.broadcast(_states(tables, key))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, run in _runs(batches, end):
            for kind, texts in _elements(run, *shared.value[file, start], wanted):
                yield _batch(file, start, kind, texts)

    found = pieces.mapInArrow(cut, "file long, start long, kind int, value string")
    whole = found.filter("kind = 1").select("value")
    # Two rows a split at most; a begin opens a new element.
    order = W.partitionBy("file").orderBy("start", "kind")
    ends = found.filter("kind <> 1").withColumn("element", F.sum((F.col("kind") == 2).cast("int")).over(order))
    parts = F.sort_array(F.collect_list(F.struct("start", "kind", "value")))
    joined = ends.groupBy("file", "element").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "").alias("value"))
    return whole.unionByName(joined.select("value"))


def _short_pieces(spark: SparkSession, path: str, end: str) -> bool:
    """Whether no piece of a file is longer than the longest, if such ends cut it. Longer ones are skipped here without being
    held, so a file that has one gives less text than its size."""
    file = F.col("_metadata.file_path").alias("file")
    longest = {"lineSep": end, "mapreduce.input.linerecordreader.line.maxlength": _LONGEST_PIECE}
    pieces = spark.read.options(**longest).text(path).select(F.xxhash64(file).alias("file"), F.octet_length("value").alias("bytes"))
    read = pieces.groupBy("file").agg(F.sum(F.col("bytes") + len(end)).alias("read"))
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64(file).alias("file"), "length")
    return files.join(read, "file", "left").filter(F.coalesce("read", F.lit(0)) < F.col("length")).isEmpty()


def _batch(file: int, start: int, kind: int, texts: pa.Array) -> pa.RecordBatch:
    columns = [pa.repeat(pa.scalar(x, t), len(texts)) for x, t in ((file, pa.int64()), (start, pa.int64()), (kind, pa.int32()))]
    return pa.RecordBatch.from_arrays([*columns, texts], ["file", "start", "kind", "value"])


def read_array(spark: SparkSession, path: str, element: T.StructType, key: str | None = None) -> DataFrame:
    """The same elements as rows with one column `value` of the declared type; a faulty element has NULL fields."""
    # Exploded, so that a filter on a field of the value does not parse the text on its own, beside the parse of the whole.
    return array_elements(spark, path, key).select(F.explode(F.array(F.from_json("value", element))).alias("value"))
