"""Phrase collocations, counted exactly in counting quotient filters.

Words that occur often enough have ids; a phrase of such words is a packed integer, which every task counts in
a filter of its own for each language and phrase length. Filters are cut into blocks by the highest bits of their quotients; a
shuffle brings the blocks of one number together, and they are merged. The permutation spreads phrases evenly, so blocks
are of one size whatever the phrases, and a frequent phrase is one entry a filter.

A phrase that occurs LEAST times has only words that do, so the others end a phrase when counting. The HEAD most
frequent words, of at most HEAD_BYTES bytes, have ids. A phrase with a frequent word beyond those is counted
as text, in the same shuffle; such words are recognised by a bitmap of fixed size, whose errors are only counted in
vain. So the bounds decide how a phrase is counted, not whether.

Each candidate is looked up by joins on its parts. Ranks are taken in two steps, over SALTS parts of a language and then
over the best of each, so that no task has more than SALTS * top rows.

Texts are lower-cased (A-Z), cut into pieces at [.,;:!?\\x0A-\\x0D] and into words at blanks and tabs. Defined
results: a null or empty text has no words; a null language is `und`; repeated rows count as often as they occur; a language without
candidates has no rows; an empty table gives none; extra columns are ignored. Long texts are counted in parts that end at a
separator. Scores are integers by decimal arithmetic, exact while counts are below 10^15.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.llm import counting_filter
from tidewright.llm.base import Scratch, as_bytes, count_step, least_step, slices

LONGEST, LEAST, TOP = 3, 10, 2000
#: A candidate goes if a longer one that holds it occurs at least this often, in percent of its own count.
COVERED_PERCENT = 50
SCALE = 1_000_000
UNKNOWN_LANGUAGE = "und"
#: Words with ids, and the bytes of one: 2^18 ids let three words fit into 54 bits; some 40 MB in a worker.
ID_BITS, HEAD_BYTES = 18, 64
#: Bits of the bitmap of other frequent words: 8 MB.
BITMAP_BITS = 26
#: Entries of a task's filters, or words of its counter, beyond which they are sent off.
MOST_HELD, MOST_WORDS = 1 << 22, 500_000
SALTS = 64
_STOP, _TAIL = -1, -2

_END = 0xFF  # no byte of UTF-8
_CUT = bytes(_END if chr(c) in ".,;:!?\n\x0b\x0c\r" else c for c in range(256))
_PART = 4 << 20


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, with a mark where a piece ends."""
    text = text.lower().translate(_CUT)  # bytes: A-Z only
    start = 0
    while start < len(text):
        end = text.find(_END, start + _PART) if len(text) - start > _PART else -1
        end = len(text) if end < 0 else end + 1
        yield text[start:end].replace(b"\xff", b" \xff ").split()
        start = end


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word, n: partial counts, and under a null word those of all words."""
    held: dict[str, Counter] = defaultdict(Counter)

    def send() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            counts.pop(b"\xff", None)
            words = [None, *counts.keys()]
            n = [counts.total(), *counts.values()]
            columns = [pa.array([lang] * len(n)), pa.array(words, type=pa.binary()).cast(pa.string()), pa.array(n, type=pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])
        held.clear()

    for batch in slices(batches, "t", rows=1024):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("t").to_pylist(), strict=True):
            for words in _parts(text):
                held[lang].update(words)
        if sum(map(len, held.values())) > MOST_WORDS:
            yield from send()
    yield from send()


def word_counts(rows: DataFrame, least: int) -> DataFrame:
    """lang, word, n: words that occur at least that often in a language, and under a null word all occurrences."""
    parts = rows.mapInArrow(_count_words, "lang string, word string, n long")
    counts = parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("word").isNull() | (F.col("n") >= least))


def _head(words: DataFrame, most: int) -> tuple[list[bytes], np.ndarray | None]:
    """The most frequent words, `most` at most, and a bitmap of the hashes of the others, None without others."""
    each = words.filter(F.col("word").isNotNull()).groupBy("word").agg(F.max("n").alias("n"))
    fits, step = F.octet_length("word") <= HEAD_BYTES, count_step(F.col("n"))
    sizes = {r[0]: r[1] for r in each.groupBy(F.when(fits, step)).count().collect()}
    others = sizes.pop(None, 0)
    lowest = least_step(sizes, most)
    others += sum(n for at, n in sizes.items() if at < lowest)
    inside = fits & (step >= lowest)
    found = each.filter(inside).select("word").toArrow().column("word").to_pylist()
    if not others:
        return sorted(w.encode() for w in found), None
    at = F.xxhash64("word").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    bits = each.filter(~inside).select(at.alias("at")).selectExpr("cast(at div 32 as int) AS cell", "shiftleft(1L, cast(at % 32 as int)) AS bit")
    cells = bits.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()  # 2^21 rows at most
    bitmap = np.zeros(1 << (BITMAP_BITS - 5), dtype=np.uint32)
    bitmap[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().astype(np.uint32)
    return sorted(w.encode() for w in found), bitmap


class _Shard:
    """What one task has counted: a filter for each language and phrase length, and phrases as text."""

    def __init__(self, words: list[bytes], bitmap: np.ndarray | None, longest: int, block_bits: int):
        self.ids = {w: i for i, w in enumerate(words)}
        self.ids[b"\xff"] = _STOP
        self.bitmap, self.longest, self.block_bits = bitmap, longest, block_bits
        self.orders = {n: counting_filter.Permutation(n * ID_BITS) for n in range(2, longest + 1)}
        self.clear()

    def clear(self) -> None:
        self.fresh: dict = defaultdict(list)
        self.filters: dict = {}
        self.texts: dict = defaultdict(Counter)
        self.n_fresh = 0

    def _other(self, word: bytes) -> int:
        """_TAIL for a word that may be frequent without an id."""
        if self.bitmap is None:
            return _STOP
        at = xxhash.xxh64_intdigest(word, 42) & ((1 << BITMAP_BITS) - 1)
        return _TAIL if int(self.bitmap[at >> 5]) >> (at & 31) & 1 else _STOP

    def add(self, lang: str, words: list[bytes]) -> None:
        get = self.ids.get
        if self.bitmap is None:
            ids = np.array([get(w, _STOP) for w in words], dtype=np.int64)
        else:
            new = {w: self._other(w) for w in set(words) if w not in self.ids}
            ids = np.array([get(w) if w in self.ids else new[w] for w in words], dtype=np.int64)
        for n in range(2, self.longest + 1):
            if len(ids) < n:
                return
            windows = [ids[k : len(ids) - n + 1 + k] for k in range(n)]
            least = np.minimum.reduce(windows)
            inside = least >= 0
            packed = np.zeros(int(inside.sum()), dtype=np.uint64)
            for w in windows:
                packed = (packed << np.uint64(ID_BITS)) | w[inside].astype(np.uint64)
            self.fresh[lang, n].append(packed)
            self.n_fresh += len(packed)
            if self.bitmap is not None:
                spoken = (least == _TAIL) & ~np.logical_or.reduce([w == _STOP for w in windows])
                self.texts[lang, n].update(b" ".join(words[k : k + n]) for k in np.flatnonzero(spoken).tolist())

    def settle(self) -> int:
        """Take fresh keys into the filters; returns the number of entries held."""
        for (lang, n), parts in self.fresh.items():
            keys = self.orders[n].forth(np.concatenate(parts))
            old = self.filters.get((lang, n), (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)))
            keys, counts = np.unique(keys, return_counts=True)
            self.filters[lang, n] = counting_filter.merge(np.concatenate([old[0], keys]), np.concatenate([old[1], counts]))
        self.fresh.clear()
        self.n_fresh = 0
        return sum(len(k) for k, _ in self.filters.values()) + sum(map(len, self.texts.values()))

    def rows(self) -> Iterator[tuple]:
        """(lang, n, block number, phrases, counts, block): a block of a filter, or the phrases as text of that number."""
        for (lang, n), (keys, counts) in self.filters.items():
            for number, block in counting_filter.blocks(keys, counts, n * ID_BITS, self.block_bits):
                yield lang, n, number, None, None, block
        for (lang, n), phrases in self.texts.items():
            dealt: dict[int, list[bytes]] = defaultdict(list)
            for phrase in phrases:
                dealt[xxhash.xxh64_intdigest(phrase) >> (64 - self.block_bits) if self.block_bits else 0].append(phrase)
            for number, own in dealt.items():
                yield lang, n, number, own, [phrases[p] for p in own], None


_SHARD = pa.schema(
    [
        ("lang", pa.string()),
        ("n", pa.int32()),
        ("block", pa.int32()),
        ("phrases", pa.list_(pa.binary())),
        ("times", pa.list_(pa.int64())),
        ("filter", pa.binary()),
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _SHARD, strict=True)], schema=_SHARD)


def phrase_counts(rows: DataFrame, words: DataFrame, longest: int, least: int, most_ids: int = 1 << ID_BITS) -> DataFrame:
    """lang, n, phrase, f: phrases of 2 to `longest` words that occur at least `least` times in a language."""
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block_bits = min((partitions - 1).bit_length(), 2 * ID_BITS)
    head, bitmap = _head(words, most_ids)
    shared = spark.sparkContext.broadcast((head, bitmap))

    def send(shard: _Shard) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for row in shard.rows():
            held.append(row)
            size += len(row[5]) if row[5] is not None else sum(map(len, row[3])) + 16 * len(row[3])
            if size > 8 << 20:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)
        shard.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in slices(batches, "t", rows=1024):
            shard = shard or _Shard(*shared.value, longest, block_bits)
            by_lang: dict[str, list[bytes]] = defaultdict(list)
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("t").to_pylist(), strict=True):
                for part in _parts(text):
                    by_lang[lang] += part
                    by_lang[lang].append(b"\xff")
                    if len(by_lang[lang]) > _PART >> 2:
                        shard.add(lang, by_lang.pop(lang))
            for lang, found in by_lang.items():
                shard.add(lang, found)
            if shard.n_fresh > MOST_HELD // 2 and shard.settle() > MOST_HELD:
                yield from send(shard)
        if shard:
            shard.settle()
            yield from send(shard)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value[0]
        orders = {n: counting_filter.Permutation(n * ID_BITS) for n in range(2, longest + 1)}
        mask = np.uint64((1 << ID_BITS) - 1)

        def rows_of() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in _SHARD.names), strict=True)

        for (lang, n, number), group in groupby(rows_of(), key=lambda r: r[:3]):
            parts, texts = [], Counter()
            for *_, own, times, block in group:
                if block is None:
                    for phrase, f in zip(own, times, strict=True):
                        texts[phrase] += f
                else:
                    parts.append(counting_filter.decode(block, n * ID_BITS - block_bits, number))
            phrases = [p.decode() for p, f in texts.items() if f >= least]
            counts = [f for f in texts.values() if f >= least]
            if parts:
                keys, sums = counting_filter.merge(*map(np.concatenate, zip(*parts, strict=True)))
                often = sums >= least
                keys = orders[n].back(keys[often])
                ids = [((keys >> np.uint64(ID_BITS * k)) & mask).tolist() for k in reversed(range(n))]
                phrases += [b" ".join([head[i] for i in own]).decode() for own in zip(*ids, strict=True)]
                counts += sums[often].tolist()
            if phrases:
                columns = [[lang] * len(phrases), pa.array([n] * len(phrases), type=pa.int32()), phrases, pa.array(counts, type=pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, list) else c for c in columns], ["lang", "n", "phrase", "f"])

    counted = rows.mapInArrow(count, "lang string, n int, block int, phrases array<binary>, times array<long>, filter binary")
    dealt = counted.repartition("lang", "n", "block").sortWithinPartitions("lang", "n", "block")
    return dealt.mapInArrow(gather, "lang string, n int, phrase string, f long")


def _part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _score(scale: int) -> Column:
    number = "cast({} as decimal(19,0))"
    return F.expr(f"({number.format('a')} * {number.format('a')} * cast({scale} as decimal(7,0))) div ({number.format('l')} * {number.format('r')})")


def scored(words: DataFrame, phrases: DataFrame, longest: int = LONGEST, scale: int = SCALE) -> DataFrame:
    """lang, phrase, a, l, r, score of each phrase, by the cut with the lowest score, the first of equals."""
    known = words.filter(F.col("word").isNotNull()).select("lang", F.col("word").alias("part"), F.col("n").alias("f"))
    known = known.unionByName(phrases.filter(F.col("n") < longest).select("lang", F.col("phrase").alias("part"), "f"))
    own = phrases.select("lang", "phrase", "n", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        _part(F.col("w"), F.lit(1), F.col("k")).alias("left"), _part(F.col("w"), F.col("k") + 1, F.col("n") - F.col("k")).alias("right"),
    )
    left = known.select("lang", F.col("part").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("part").alias("right"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", _score(scale))
    best = both.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("x"))
    return best.select("lang", "phrase", "x.a", "x.l", "x.r", "x.score")


def covered(phrases: DataFrame) -> DataFrame:
    """lang, phrase, longer: the highest count of a longer phrase that holds this one; phrases without one are left out."""
    own = phrases.filter(F.col("n") > 2).select("lang", "n", "f", F.split("phrase", " ").alias("w"))
    sizes = own.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("n") - 1)))
    places = sizes.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("size") + 1)))
    inner = places.select("lang", _part(F.col("w"), F.col("at"), F.col("size")).alias("phrase"), "f")
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST, top: int = TOP, most_ids: int = 1 << ID_BITS) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    if not 2 <= longest * ID_BITS <= 63:
        raise ValueError(f"phrases of {longest} words do not fit into 63 bits")
    scratch = Scratch(docs.sparkSession, "phrases")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), as_bytes(F.col(text)).alias("t"))
    words = scratch.cut(word_counts(rows, least))
    phrases = scratch.cut(phrase_counts(rows, words, longest, least, most_ids))
    found = scored(words, phrases, longest).join(covered(phrases), ["lang", "phrase"], "left")
    found = found.filter(F.col("longer").isNull() | (100 * F.col("longer") < COVERED_PERCENT * F.col("a"))).drop("longer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = words.filter(F.col("word").isNull()).select("lang", "n")
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
