"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting: each task adds up the n-grams of its documents per language in numpy and returns only the buckets it
met; the sums over all tasks are a grouped aggregate. The table of log probabilities has 2^16 buckets by the
number of languages, which is checked, and is broadcast. Scoring looks up the buckets of a batch of texts at once
and adds their rows up by document.

Letters are lower-cased, everything else is a blank, and runs of blanks are one; so digits and marks say nothing.

Defined results: a text that is null or has no letter is `und` with score 0, and so is every text if there is
nothing to learn from; of equally likely languages the first in alphabetical order is given; texts with a null
language are not learned from; of more than MOST_LANGS values of the language, which dirty tables have, those with
most documents are learned, of equal ones the first in alphabetical order; repeated rows count as often as they
occur; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.base import as_bytes, fold, slices

ORDERS = (1, 2, 3)
BUCKET_BITS = 16
SMOOTHING = 0.1
#: Languages that are learned, those with most documents: it bounds the broadcast table to 64 MB.
MOST_LANGS = 256
#: Distinct (language, bucket) pairs that a task holds while it counts, and n-grams that it has not added to them yet.
MOST_HELD, MOST_FRESH = 1 << 20, 1 << 22
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"

_BLANK = 32
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)
#: Characters looked at together.
_PIECE = 1 << 19
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each one between blanks and followed by zeros, and where each text begins."""
    joined = "\0\0\0".join(f" {t.lower()} " for t in texts) + "\0\0\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.zeros(len(points), dtype=bool)
    # The zeros that part the texts, not those within: a text's own zeros are blanks.
    lengths = np.array([len(t.lower()) + 5 for t in texts])
    heads = np.cumsum(lengths) - lengths
    for k in (3, 2, 1):
        ends[heads + lengths - k] = True
    points = np.where(_is_letter()[points], points, np.uint32(_BLANK))
    blank = points == _BLANK
    keep = ends | ~blank
    keep[1:] |= ~blank[:-1] | ends[:-1]
    keep[:1] = True
    places = np.cumsum(keep) - keep
    points = np.where(ends, np.uint32(0), points)[keep]
    return points, places[heads]


def ngrams(points: np.ndarray, a: int, b: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and buckets of the n-grams that begin in [a, b)."""
    part = points[a : b + order - 1]
    n = len(part) - order + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    code = np.full(n, order * int(_FACTORS[3]) & 0xFFFFFFFF, dtype=np.uint32)
    whole = np.ones(n, dtype=bool)
    for k in range(order):
        char = part[k : k + n]
        code += char * _FACTORS[k]
        whole &= char != 0
    if order == 1:
        whole &= part[:n] != _BLANK
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    at = np.flatnonzero(whole)
    return at + a, (code[at] >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t.decode() for t in batch.column("t").to_pylist()]


def count_ngrams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, bucket, n over all rows with a language; bucket -1 holds the number of documents."""

    width = (1 << BUCKET_BITS) + 1

    def run(batches: Iterator[pa.RecordBatch]):
        langs: dict[str, int] = {}
        keys, sums, fresh, size = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), [], 0

        def send() -> pa.RecordBatch:
            names, bucket = np.array([*langs, ""], dtype=object)[keys // width], keys % width
            bucket = np.where(bucket == 1 << BUCKET_BITS, -1, bucket)
            return pa.RecordBatch.from_arrays([pa.array(names, type=pa.string()), pa.array(bucket, type=pa.int32()), pa.array(sums)], ["lang", "bucket", "n"])

        def settle() -> None:
            nonlocal keys, sums, fresh, size
            new, times = np.unique(np.concatenate([np.empty(0, dtype=np.int64), *fresh]), return_counts=True)
            merged, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
            sums = np.bincount(back, weights=np.concatenate([sums, times]), minlength=len(merged)).astype(np.int64)
            keys, fresh, size = merged, [], 0

        for batch in slices(batches, "t"):
            own = np.array([langs.setdefault(x, len(langs)) for x in batch.column("l").to_pylist()])
            points, heads = characters(_texts(batch))
            fresh.append(own * width + (1 << BUCKET_BITS))
            for a in range(0, len(points), _PIECE):
                for order in ORDERS:
                    at, bucket = ngrams(points, a, min(a + _PIECE, len(points)), order)
                    fresh.append(own[np.searchsorted(heads, at, side="right") - 1] * width + bucket)
                    size += len(at)
                if size > MOST_FRESH:
                    settle()
            if len(keys) > MOST_HELD:
                yield send()
                keys, sums = keys[:0], sums[:0]
        settle()
        yield send()

    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("l"), as_bytes(F.col(text)).alias("t"))
    return rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in alphabetical order, log priors, log probabilities by bucket and language."""
    sizes = docs.filter(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).count()
    langs = sorted(r[0] for r in sizes.orderBy(F.desc("count"), "lang").limit(MOST_LANGS).collect())
    docs = docs.filter(F.col(lang).isin(langs))
    place = {x: i for i, x in enumerate(langs)}
    # Languages by buckets, which are both bounded.
    table = count_ngrams(docs, text, lang).toArrow()
    counts = np.zeros((1 << BUCKET_BITS, max(1, len(langs))))
    priors = np.ones(max(1, len(langs)))
    for name in table.column("lang").unique().to_pylist():
        rows = table.filter(pc.equal(table.column("lang"), name))
        bucket, n = rows.column("bucket").to_numpy(), rows.column("n").to_numpy()
        priors[place[name]] += n[bucket < 0].sum()
        counts[bucket[bucket >= 0], place[name]] = n[bucket >= 0]
    totals = counts.sum(axis=0)
    chances = np.log(counts + SMOOTHING) - np.log(totals + SMOOTHING * len(counts))
    return langs, np.log(priors / priors.sum()), chances.astype(np.float32)


def predict(docs: DataFrame, model: tuple, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score."""
    langs = model[0]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        _, priors, chances = shared.value
        for batch in slices(batches, "t", rows=512):
            texts = _texts(batch)
            sums = np.tile(priors, (len(texts), 1))
            seen = np.zeros(len(texts), dtype=bool)
            points, heads = characters(texts)
            for a in range(0, len(points), _PIECE):
                for order in ORDERS:
                    at, bucket = ngrams(points, a, min(a + _PIECE, len(points)), order)
                    if len(at):
                        row = np.searchsorted(heads, at, side="right") - 1
                        first = np.flatnonzero(np.diff(row, prepend=-1))
                        sums[row[first]] += np.add.reduceat(chances[bucket], first, axis=0, dtype=np.float64)
                        seen[row[first]] |= order == 1
            sums = np.exp(sums - sums.max(axis=1, keepdims=True))
            sums /= sums.sum(axis=1, keepdims=True)
            best = sums.argmax(axis=1)
            known = seen & bool(langs)
            names = [langs[i] if k else UNKNOWN for i, k in zip(best.tolist(), known.tolist(), strict=True)]
            scores = np.where(known, sums[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(names, type=pa.string()), pa.array(scores)], ["i", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("i"), as_bytes(F.col(text)).alias("t"))
    return rows.mapInArrow(run, f"i {kind}, lang_pred string, score double").withColumnRenamed("i", id_col)


def language_id(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the folds that are not held out, and predict every document."""
    held = fold(F.col(id_col), FOLDS) == HELD_OUT
    model = learn(docs.filter(~held), text, lang)
    found = predict(docs, model, id_col, text)
    return found.select(id_col, (fold(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
