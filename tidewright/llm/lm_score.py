"""LM scoring: the marginal probability of a text over all its segmentations into subword pieces.

The pieces are those of an existing vocabulary. Their unigram scores come from the training documents: each
distinct word is segmented once by the tokenizer, its pieces count as often as the word occurs, and one is added
to every count. A word's probability is the sum over all ways to write it as pieces, by a forward recursion in
log space over its characters; a character can also be written as its bytes. The model draws words and the end
of the text independently, so a text's log probability is the sum over its words, and the end.

Beside it stands the word-unigram base score, for which every word of every document needs its count in all
training documents. Counting is a grouped aggregate with partial sums per task. Each distinct word is scored on
the lattice once. The HEAD most frequent words at most are broadcast, with their counts and scores, and are looked
up where the documents lie; all other words of a document are joined with the counts and scores by a shuffle. Both
ways give the same number, so the bound only decides what is moved. The
join has one row per word on one side, and AQE splits a word that is frequent on the other; documents with many
such words are summed by document with partial sums.

Words are cut at blanks, with A-Z in lower case, and each text ends with one end token. Defined results: a null
or empty text is the end alone; without training documents every count is zero; repeated rows are trained on and
scored as often as they occur; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.base import BLANK, Scratch, as_bytes, fold, slices

FOLDS, HELD_OUT = 7, 2
#: Words broadcast with their counts, and the characters of such a word: 60 MB in a worker at most.
HEAD, HEAD_LENGTH = 200_000, 64
SPACE = "▁"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOG10 = math.log(10)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_tokenizers: dict = {}


def _tokenizer(path: str):
    import sentencepiece

    if path not in _tokenizers:
        _tokenizers[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _tokenizers[path]


def _code(points: np.ndarray) -> np.ndarray:
    """A hash of each row of code points, one column after the other, so that a prefix can be carried on."""
    out = np.zeros(len(points), dtype=np.uint64)
    for column in points.T:
        out = _step(out, column)
    return out


def _step(code: np.ndarray, char: np.ndarray) -> np.ndarray:
    code = (code + char.astype(np.uint64) + np.uint64(1)) * _MIX
    return code ^ (code >> np.uint64(31))


class Lattice:
    """Piece scores as natural logarithms, and the forward recursion over batches of words."""

    def __init__(self, pieces: list[str], is_byte: list[bool], is_text: list[bool], counts: np.ndarray, ends: int):
        usable = np.array(is_byte) | np.array(is_text)
        weights = np.where(usable, counts + 1.0, 0.0)
        total = weights.sum() + ends + 1.0
        scores = np.log(np.maximum(weights, 1e-300)) - math.log(total)
        self.end = math.log(ends + 1.0) - math.log(total)
        self.bytes = np.zeros(256)
        for i in np.flatnonzero(is_byte).tolist():
            self.bytes[int(pieces[i][3:5], 16)] = scores[i]
        text = [i for i in np.flatnonzero(is_text).tolist()]
        self.longest = max(len(pieces[i]) for i in text)
        codes = np.empty(len(text), dtype=np.uint64)
        lengths = np.array([len(pieces[i]) for i in text])
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            points = np.frombuffer("".join(pieces[text[k]] for k in at).encode("utf-32-le"), dtype=np.uint32)
            codes[at] = _code(points.reshape(-1, n))
        order = np.argsort(codes)
        self.codes, self.scores = codes[order], scores[text][order]
        if (np.diff(self.codes) == 0).any():
            raise ValueError("two pieces have one hash")

    def _score(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.scores[at], -np.inf)

    def _spelled(self, points: np.ndarray) -> np.ndarray:
        """Score of each character written as its bytes."""
        own, back = np.unique(points, return_inverse=True)
        found = [self.bytes[np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), dtype=np.uint8)].sum() for c in own.tolist()]
        return np.array(found)[back].reshape(points.shape)

    def words(self, words: list[str]) -> list[float]:
        """Natural logarithm of the marginal probability of each word, with the space before it."""
        lengths = np.array([len(w) + 1 for w in words])
        out = np.empty(len(words))
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            for a in range(0, len(at), max(1, (1 << 18) // n)):
                part = at[a : a + max(1, (1 << 18) // n)]
                joined = "".join(SPACE + words[k] for k in part.tolist())
                points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(-1, n)
                out[part] = self._forward(points)
        return out.tolist()

    def _forward(self, points: np.ndarray) -> np.ndarray:
        count, n = points.shape
        spelled = self._spelled(points)
        window = min(self.longest, n)
        # Rows: the last `window` starts, with the hash so far and the score of all segmentations up to there.
        codes = np.zeros((window, count), dtype=np.uint64)
        before = np.full((window, count), -np.inf)
        total = np.zeros(count)
        for j in range(n):
            codes[j % window] = 0
            before[j % window] = total
            live = min(j + 1, window)
            codes[:live] = _step(codes[:live], points[:, j])
            terms = before[:live] + self._score(codes[:live])
            terms = np.concatenate([terms, (total + spelled[:, j])[None]])
            top = terms.max(axis=0)
            total = top + np.log(np.exp(terms - top).sum(axis=0))
        return total


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: A-Z only, and the six blanks


def count_words(docs: DataFrame, train: str, text: str = "text") -> DataFrame:
    """word (binary), c: how often each word of any document occurs in the training documents, zero included."""
    lower = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = docs.select(F.col(train).cast("long").alias("n"), F.explode(F.split(lower, BLANK + "+")).alias("word"))
    return words.filter(F.col("word") != "").groupBy("word").agg(F.sum("n").alias("c"))


def piece_counts(words: DataFrame, path: str) -> np.ndarray:
    """How often the tokenizer writes each piece in the training words."""

    def run(batches: Iterator[pa.RecordBatch]):
        tokenizer = _tokenizer(path)
        size = tokenizer.get_piece_size()
        sums = np.zeros(size, dtype=np.int64)
        for batch in batches:
            counts = batch.column("c").to_numpy()
            for a in range(0, batch.num_rows, 4096):
                ids = tokenizer.encode(batch.column("word").slice(a, 4096).to_pylist(), num_threads=1)
                flat = np.fromiter((i for own in ids for i in own), dtype=np.int64)
                times = np.repeat(counts[a : a + 4096], [len(own) for own in ids])
                np.add.at(sums, flat, times)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], ["piece", "n"])

    found = words.filter("c > 0").select("word", "c").mapInArrow(run, "piece long, n long")
    table = found.groupBy("piece").agg(F.sum("n").alias("n")).toArrow()  # a row per piece at most
    counts = np.zeros(_tokenizer(path).get_piece_size(), dtype=np.int64)
    counts[table.column("piece").to_numpy()] = table.column("n").to_numpy()
    return counts


def lattice_of(path: str, counts: np.ndarray, ends: int) -> Lattice:
    model = _tokenizer(path)
    n = model.get_piece_size()
    is_byte = [model.is_byte(i) for i in range(n)]
    is_text = [not (is_byte[i] or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
    return Lattice([model.id_to_piece(i) for i in range(n)], is_byte, is_text, counts, ends)


def _head(words: DataFrame) -> DataFrame:
    """The most frequent words, HEAD at most: all with more occurrences than the least number that keeps to it.
    Words of over HEAD_LENGTH characters are not among them."""
    words, least = words.filter(F.length("word") <= HEAD_LENGTH), 1
    # A row per number of occurrences below 1000, and one for the rest: a fixed number of rows.
    steps = words.filter("c > 0").groupBy(F.least("c", F.lit(1000)).alias("c")).count().collect()
    held = 0
    for c, n in sorted(map(tuple, steps), reverse=True):
        if held + n > HEAD:
            least = c + 1
            break
        held += n
    if least <= 1000:
        return words.filter(F.col("c") >= least)
    return words.filter("c > 1000").orderBy(F.desc("c"), "word").limit(HEAD)


def score_words(words: DataFrame, shared) -> DataFrame:
    """word, c, score: with the base-10 logarithm of each distinct word's marginal probability."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = shared.value.words(batch.column("word").to_pylist())
            score = pa.array(np.array(found) / _LOG10)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), score], ["word", "c", "score"])

    return words.select("word", "c").mapInArrow(run, "word string, c long, score double")


def _sums(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, weights=values, minlength=n)


def lm_score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    path = path or default_path()
    scratch = Scratch(spark, "lm")
    own = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    held = fold(F.col("i"), FOLDS) == HELD_OUT
    counted = scratch.cut(count_words(own.withColumn("train", ~held), "train", "t"))
    ends = own.filter(~held).count()
    known, tokens = counted.agg(F.sum((F.col("c") > 0).cast("long")), F.sum("c")).first()
    distinct, total = (known or 0) + (ends > 0), (tokens or 0) + ends
    floor = math.log10(total + 1 * (distinct + 1))
    lattice = lattice_of(path, piece_counts(counted, path), ends)
    words = scratch.cut(score_words(counted, spark.sparkContext.broadcast(lattice)))
    scratch.drop(counted)
    # HEAD rows at most: the words, how often they occur, and their score.
    head = _head(words).select("word", "c", "score").toArrow()
    places = {w.encode(): i for i, w in enumerate(head.column("word").to_pylist())}
    gains = np.log10(head.column("c").to_numpy().astype(np.float64) + 1)
    shared = spark.sparkContext.broadcast((places, gains, head.column("score").to_numpy().astype(np.float64)))
    end_gain, end_score = math.log10(ends + 1), lattice.end / _LOG10

    def split(batches: Iterator[pa.RecordBatch]):
        places, gains, scores = shared.value
        place = places.get
        for batch in slices(batches, "t", rows=1024, most_bytes=2 << 20):
            n = batch.num_rows
            texts = [words_of(t) for t in batch.column("t").to_pylist()]
            lengths = np.array([len(t) for t in texts])
            at = np.array([place(w, -1) for t in texts for w in t], dtype=np.int64)
            of = np.repeat(np.arange(n), lengths)
            inside = at >= 0
            found, of_found = at[inside], of[inside]
            bounds = np.cumsum(lengths) - lengths
            bags: list[Counter] = [Counter() for _ in range(n)]
            for k in np.flatnonzero(~inside).tolist():
                t = of[k]
                bags[t][texts[t][k - bounds[t]]] += 1
            columns = [
                batch.column("i"),
                pa.array(lengths + 1, type=pa.int64()),
                pa.array(_sums(of_found, np.ones(len(found)), n).astype(np.int64) + (ends > 0), type=pa.int64()),
                pa.array(_sums(of_found, gains[found], n) + end_gain),
                pa.array(_sums(of_found, scores[found], n) + end_score),
                pa.array([list(b.keys()) for b in bags], type=pa.list_(pa.binary())),
                pa.array([list(b.values()) for b in bags], type=pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["i", "n_tokens", "n_known", "base", "score", "rest", "times"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"i {kind}, n_tokens long, n_known long, base double, score double, rest array<binary>, times array<long>"
    parts = own.select("i", as_bytes(F.col("t")).alias("t")).mapInArrow(split, schema)
    parts = scratch.cut(parts.withColumn("row", F.monotonically_increasing_id()))
    rare = parts.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x"))
    rare = rare.select("row", F.col("x.rest").cast("string").alias("word"), F.col("x.times").alias("n"))
    met = rare.join(words, "word").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"),
        F.sum(F.log10(F.col("c") + 1) * F.col("n")).alias("gain"),
        F.sum(F.col("score") * F.col("n")).alias("also"),
    )
    out = parts.drop("rest", "times").join(met, "row", "left")
    return out.select(
        F.col("i").alias(id_col),
        (fold(F.col("i"), FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0)) - F.col("n_tokens") * floor).alias("base_score"),
        (F.col("score") + F.coalesce("also", F.lit(0.0))).alias("score"),
    )
