"""Benchmark decontamination: windows of documents that are near copies of benchmark items.

For each size of an item, the windows of so many words slide over a document. A window's SimHash is the sign of
the sum of its shingles' hash bits, each as often as it occurs, taken from running sums; it has 128 bits. Texts of the least
similarity of 0.8 differ in some 19 of them, with a standard deviation of 4; RADIUS is 2.4 of those above. The
fingerprints of items of that size are indexed by 10 blocks of 12 or 13 bits: fingerprints within RADIUS bits differ in
at most RADIUS // 10 bits of some block, so postings under every block value within that many bits find all of them.
What is found within RADIUS is verified: the similarity is the sum of the least over the sum of the greatest numbers of
occurrences of each shingle, on the words themselves.

Windows that cannot reach the similarity are not hashed: with at least 0.8 of a window's shingles in common with
an item, at least that many of its places must begin a shingle of some item, which one look at each word shows.

The benchmark is the query set: it is read in blocks of bounded size, each broadcast for one pass over the
documents. Documents are neither shuffled nor grouped.

Words are runs of letters and digits in lower case, of any script, so quotation marks and dashes of any kind part them; shingles have five words, and an item with fewer is one
shingle. A document shorter than an item is one window. Defined results: null and empty texts, and items without
a word, match nothing; repeated items and rows of the same id and text match each; of equally similar windows
the first is given; extra columns are ignored (`find_leaks`) or kept (`drop_leaks`).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.base import as_bytes, slices

SHINGLE = 5
SIMILARITY = 0.8
BITS = 128
RADIUS = 29
BLOCKS = 10
#: Characters of benchmark text, and items, in a block; as words and postings they take a few hundred MB at most.
BLOCK_CHARS, BLOCK_ITEMS = 4_000_000, 20_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: ASCII characters that part words become blanks; the bytes of other characters stay.
_PARTED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    lower = text.decode().lower()
    if not lower.isascii():
        for mark in {c for c in set(lower) if c > "\x7f" and not c.isalnum()}:
            lower = lower.replace(mark, " ")
    return lower.encode().translate(_PARTED).split()


def _chain(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k values."""
    n = len(values) - k + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(k if n > 0 else 0):
        out = (out + values[i : i + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def _bits(shingles: np.ndarray) -> np.ndarray:
    """128 bits of each shingle: its hash, and a mix of it."""
    second = (shingles ^ (shingles >> np.uint64(31))) * _MIX
    second ^= second >> np.uint64(29)
    both = np.stack([shingles, second], axis=1).astype(">u8")
    return np.unpackbits(both.view(np.uint8).reshape(-1, BITS // 8), axis=1)


def _prints(shingles: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """SimHash bits of the windows of `length` shingles at these starts."""
    low, high = int(starts.min()), int(starts.max()) + length
    sums = np.zeros((high - low + 1, BITS), dtype=np.int32)
    np.cumsum(_bits(shingles[low:high]), axis=0, out=sums[1:], dtype=np.int32)
    ones = sums[starts - low + length] - sums[starts - low]
    return (2 * ones > length).astype(np.uint8)


def _packed(prints: np.ndarray) -> np.ndarray:
    return np.packbits(prints, axis=1).view(np.uint64)


_EDGES = [round(b * BITS / BLOCKS) for b in range(BLOCKS + 1)]


def _values(prints: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The width of each block, and its value in each fingerprint."""
    for a, b in zip(_EDGES, _EDGES[1:], strict=False):
        yield b - a, prints[:, a:b].astype(np.int64) @ (1 << np.arange(b - a, dtype=np.int64))


class Postings:
    """The items of one size by block values, each under all values within the guaranteed distance."""

    def __init__(self, prints: np.ndarray):
        self.packed = _packed(prints)
        self.blocks = []
        for width, values in _values(prints):
            masks = np.flatnonzero(np.bitwise_count(np.arange(1 << width)) <= RADIUS // BLOCKS)
            near = (values[:, None] ^ masks).ravel()
            order = np.argsort(near, kind="stable")
            self.blocks.append((near[order], np.repeat(np.arange(len(values)), len(masks))[order]))

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(row, item) of all pairs within RADIUS, and the number of distinct pairs that the blocks gave."""
        pairs = []
        for (near, who), (_, values) in zip(self.blocks, _values(prints), strict=True):
            low, high = np.searchsorted(near, values), np.searchsorted(near, values, side="right")
            n = high - low
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            pairs.append(np.repeat(np.arange(len(values)), n) * len(self.packed) + who[at])
        row, item = np.divmod(np.unique(np.concatenate(pairs)), len(self.packed))
        packed = _packed(prints)
        near = np.bitwise_count(packed[row] ^ self.packed[item]).sum(axis=1) <= RADIUS
        return row[near], item[near], len(row)


class Index:
    """A block of benchmark items."""

    def __init__(self, items: list[tuple], similarity: float = SIMILARITY):
        self.similarity = similarity
        self.ids = [i for i, _ in items]
        self.words = [words_of(t) for _, t in items]
        self.vocabulary: dict[bytes, int] = {}
        for words in self.words:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        sizes: dict[int, list[int]] = {}
        for i, words in enumerate(self.words):
            if words:
                sizes.setdefault(len(words), []).append(i)
        self.sizes = sorted(sizes)
        self.of_size = {n: np.array(v) for n, v in sizes.items()}
        begun: dict[int, list[np.ndarray]] = {}
        self.postings, self.counts = {}, {}
        for n in self.sizes:
            k = min(SHINGLE, n)
            prints = []
            for i in sizes[n]:
                known = np.array([self.vocabulary[w] for w in self.words[i]], dtype=np.uint64)
                begun.setdefault(k, []).append(_chain(known, k))
                own = _chain(_hashes(self.words[i]), k)
                prints.append(_prints(own, np.array([0]), len(own))[0])
                self.counts[i] = _occurrences(self.words[i], k)
            self.postings[n] = Postings(np.array(prints, dtype=np.uint8))
        self.begun = {k: np.unique(np.concatenate(v)) for k, v in begun.items()}

    def places(self, texts: list[list[bytes]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """For each shingle length, running counts of the places that begin an item's shingle, and each text's place."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for words in texts for w in [*words, b""]], dtype=np.uint64)
        lengths = np.array([len(w) + 1 for w in texts])
        heads = np.cumsum(lengths) - lengths
        zero = np.concatenate([[0], np.cumsum(ids == 0)])
        out = {}
        for k, begun in self.begun.items():
            hit = np.zeros(len(ids), dtype=np.int64)
            whole = np.flatnonzero(zero[k:] == zero[:-k]) if len(ids) >= k else np.empty(0, dtype=np.int64)
            if len(whole):
                runs = np.stack([ids[whole + i] for i in range(k)])
                code = np.zeros(len(whole), dtype=np.uint64)
                for row in runs:
                    code = (code + row) * _MIX
                    code ^= code >> np.uint64(29)
                at = np.minimum(np.searchsorted(begun, code), len(begun) - 1)
                hit[whole[begun[at] == code]] = 1
            out[k] = np.concatenate([[0], np.cumsum(hit)]), heads
        return out

    def matches(self, texts: list[bytes]) -> Iterator[tuple[int, int, float, int, int]]:
        """(text, item, similarity, first word, words) of the best window of each item found."""
        split = [words_of(t) for t in texts]
        places = self.places(split)
        touched = set()
        for sums, heads in places.values():
            ends = np.append(heads[1:], len(sums) - 1)
            touched.update(np.flatnonzero(sums[ends] > sums[heads]).tolist())
        for t in sorted(touched):
            yield from ((t, *found) for found in self._windows(split[t], {k: sums[heads[t] :] for k, (sums, heads) in places.items()}))

    def _windows(self, words: list[bytes], sums: dict[int, np.ndarray]) -> Iterator[tuple]:
        hashed = _hashes(words)
        chains: dict[int, np.ndarray] = {}
        for n in self.sizes:
            k = min(SHINGLE, n)
            size = min(n, len(words))
            length = size - k + 1
            if length < 1 or length < self.similarity * (n - k + 1):
                continue
            starts = np.arange(len(words) - size + 1)
            hits = sums[k][starts + length] - sums[k][starts]
            starts = starts[hits >= math.ceil(self.similarity * (n - k + 1) - 1e-9)]
            if not len(starts):
                continue
            if k not in chains:
                chains[k] = _chain(hashed, k)
            best: dict[int, tuple] = {}
            for a in range(0, len(starts), 4096):
                part = starts[a : a + 4096]
                row, item, _ = self.postings[n].within(_prints(chains[k], part, length))
                for s, i in zip(part[row].tolist(), self.of_size[n][item].tolist(), strict=True):
                    alike = similarity(_occurrences(words[s : s + size], k), self.counts[i])
                    if alike >= self.similarity - 1e-12 and (i not in best or alike > best[i][1]):
                        best[i] = (i, alike, s, size)
            yield from best.values()


def _occurrences(words: list[bytes], k: int) -> Counter:
    return Counter(zip(*(words[i:] for i in range(k)), strict=False))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: shingles weigh as often as they occur."""
    both = sum(min(n, b[s]) for s, n in a.items())
    return both / (a.total() + b.total() - both) if a or b else 0.0


def _blocks(benchmark: DataFrame, item_col: str, text: str) -> Iterator[list[tuple]]:
    """The items in blocks that are small enough to broadcast; a block is the rows with one hash of the text."""
    items = benchmark.filter(F.col(text).isNotNull()).select(F.col(item_col).alias("i"), F.col(text).alias("t")).distinct()
    chars, number = items.agg(F.sum(F.length("t")), F.count("*")).first()
    count = max(1, math.ceil((chars or 0) / BLOCK_CHARS), math.ceil(number / BLOCK_ITEMS))
    for b in range(count):
        part = items.filter(F.pmod(F.xxhash64("t"), F.lit(count)) == b).orderBy("i", "t")
        rows = [(r["i"], r["t"].encode()) for r in part.toLocalIterator()]
        if rows:
            yield rows


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per document and item found in it: id, item id, similarity, first_word, n_words of the best window."""
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"i {kind}, item {item_kind}, similarity double, first_word int, n_words int"
    rows = docs.select(F.col(id_col).alias("i"), as_bytes(F.col(text)).alias("t"))
    parts = []
    for items in _blocks(benchmark, item_col, item_text):
        shared = spark.sparkContext.broadcast(Index(items))

        def run(batches: Iterator[pa.RecordBatch], shared=shared):
            index = shared.value
            for batch in slices(batches, "t", rows=1024):
                found = list(index.matches(batch.column("t").to_pylist()))
                if found:
                    at, item, alike, first, n = zip(*found, strict=True)
                    ids = batch.column("i").take(pa.array(at))
                    items = pa.array([index.ids[i] for i in item], type=schema_type)
                    yield pa.RecordBatch.from_arrays([ids, items, pa.array(alike), pa.array(first, pa.int32()), pa.array(n, pa.int32())], names)

        names = ["i", "item", "similarity", "first_word", "n_words"]
        schema_type = pa.int64() if item_kind == "bigint" else pa.int32() if item_kind == "int" else pa.string()
        parts.append(rows.mapInArrow(run, schema))
    out = parts[0] if parts else spark.createDataFrame([], schema)
    for part in parts[1:]:
        out = out.union(part)
    return out.withColumnsRenamed({"i": id_col, "item": item_col})


def _leaks(shared):
    """A column function: whether a text holds an item of this block."""

    @F.pandas_udf("boolean")
    def leaks(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), dtype=bool)
        values = texts.tolist()
        for a in range(0, len(values), 512):
            for found in shared.value.matches(values[a : a + 512]):
                out[a + found[0]] = True
        return pd.Series(out)

    return leaks


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows, with all columns, of documents that hold no benchmark item."""
    for items in _blocks(benchmark, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Index(items))
        docs = docs.filter(~_leaks(shared)(as_bytes(F.col(text))))
    return docs
