"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Word vectors are learned from all texts, without labels. Words fall into 2^14 hashed buckets; each bucket has a
sparse random index vector, and a word's vector is the sum of the index vectors of the words up to two places
beside it. Each task sums its share in whole numbers and returns one row per bucket it met; the rows are summed
by a grouped aggregate with a partial sum per task, so the result is 4 MB, the same at any size and in any order.
A document is pooled to the mean of its words' unit vectors, plain and weighted by rarity, and the mean of the
products of neighbours' vectors, element by element, which tells texts that repeat themselves. Documents are
pooled once, to a table, which training and scoring read.

The network learns on the driver from a bounded sample of labelled documents (MOST_LABELLED, those with the least
hash of their id) and is calibrated: a temperature is fitted to labelled documents that it did not learn from.
Labels, language, source and id are no inputs.

Defined results: a null or empty text has the zero vector and its score; without labels to learn from, every
score is 0.5; several labels of an id count as their mean; null labels do not count; repeated rows get a score
each; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.base import Scratch, as_bytes, fold, slices

BUCKETS = 1 << 14
SIZE = 64
POOLS = 3
NON_ZERO = 4
REACH = 2
HIDDEN = 32
MOST_LABELLED = 20_000
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
THRESHOLD = 0.3
_RARITY = 1e-3
#: Tokens of a text that are pooled together.
_PIECE = 1 << 14
#: Words, and runs of digits or marks.
_TOKENS = re.compile(rb"[A-Za-z\x80-\xff]+|[^A-Za-z\x80-\xff\s]+")


def _buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the tokens of all texts, and the text that each is of."""
    found = [_TOKENS.findall(t) for t in texts]
    counts = [len(f) for f in found]
    hashed = np.fromiter(map(zlib.crc32, itertools.chain.from_iterable(found)), dtype=np.uint32, count=sum(counts))
    return (hashed >> np.uint32(5)).astype(np.int64) % BUCKETS, np.repeat(np.arange(len(texts)), counts)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero elements of each bucket's index vector."""
    random = np.random.default_rng(7)
    return random.integers(0, SIZE, (BUCKETS, NON_ZERO)), random.choice([-1.0, 1.0], (BUCKETS, NON_ZERO))


def word_sums(docs: DataFrame, text: str = "text") -> DataFrame:
    """bucket, n, v0 ... : occurrences and the sum of index vectors beside them."""
    names = [f"v{i}" for i in range(SIZE)]

    def run(batches: Iterator[pa.RecordBatch]):
        places, signs = index_vectors()
        sums, seen = np.zeros(BUCKETS * SIZE), np.zeros(BUCKETS, dtype=np.int64)
        for batch in slices(batches, "t", rows=2048):
            tokens, text_of = _buckets(batch.column("t").to_pylist())
            seen += np.bincount(tokens, minlength=BUCKETS)
            for reach in range(1, REACH + 1):
                near = text_of[reach:] == text_of[:-reach]
                left, right = tokens[:-reach][near], tokens[reach:][near]
                for word, beside in ((left, right), (right, left)):
                    at = (word * SIZE)[:, None] + places[beside]
                    sums += np.bincount(at.ravel(), weights=signs[beside].ravel(), minlength=len(sums))
        met = np.flatnonzero(seen)
        if len(met):
            own = sums.reshape(BUCKETS, SIZE)[met].astype(np.int64)
            columns = [pa.array(met, type=pa.int32()), pa.array(seen[met]), *(pa.array(own[:, i]) for i in range(SIZE))]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "n", *names])

    schema = "bucket int, n long, " + ", ".join(f"{n} long" for n in names)
    rows = docs.select(as_bytes(F.col(text)).alias("t")).mapInArrow(run, schema)
    return rows.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in ["n", *names]])


def word_vectors(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Unit vector and weight of each bucket. The table has a row per bucket at most."""
    table = word_sums(docs, text).toArrow()
    vectors, weights = np.zeros((BUCKETS, SIZE), dtype=np.float32), np.zeros(BUCKETS, dtype=np.float32)
    if table.num_rows:
        at = table.column("bucket").to_numpy()
        own = np.stack([table.column(f"v{i}").to_numpy() for i in range(SIZE)], axis=1).astype(np.float64)
        vectors[at] = own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1.0)
        n = table.column("n").to_numpy()
        weights[at] = _RARITY / (_RARITY + n / n.sum())
    return vectors, weights


def pool(docs: DataFrame, words: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, features (POOLS * SIZE floats)."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]):
        vectors, weights = shared.value
        for batch in slices(batches, "t", rows=1024):
            tokens, text_of = _buckets(batch.column("t").to_pylist())
            bounds = np.searchsorted(text_of, np.arange(batch.num_rows + 1)).tolist()
            pooled = np.zeros((batch.num_rows, POOLS, SIZE))
            for i, (first, last) in enumerate(zip(bounds, bounds[1:], strict=False)):
                weight = weights[tokens[first:last]]
                for a in range(first, last, _PIECE):
                    part = tokens[a : min(a + _PIECE, last)]
                    own = vectors[part]
                    pooled[i, 0] += own.sum(axis=0)
                    pooled[i, 1] += weight[a - first : a - first + _PIECE] @ own
                    following = vectors[tokens[a + 1 : min(a + 1 + _PIECE, last)]]
                    pooled[i, 2] += np.einsum("ij,ij->j", own[: len(following)], following)
                totals = np.array([last - first, weight.sum(dtype=np.float64), last - first - 1])
                pooled[i] /= np.maximum(totals, 1e-9)[:, None]
            flat = pa.FixedSizeListArray.from_arrays(pa.array(pooled.astype(np.float32).ravel()), POOLS * SIZE)
            yield pa.RecordBatch.from_arrays([batch.column("i"), flat.cast(pa.list_(pa.float32()))], ["i", "features"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("i"), as_bytes(F.col(text)).alias("t"))
    return rows.mapInArrow(run, f"i {kind}, features array<float>").withColumnRenamed("i", id_col)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Network:
    """Two layers: tanh, then one logit. Inputs are standardized; weights are fitted by Adam on mini-batches."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = 40, rate: float = 3e-3, decay: float = 1e-3, batch: int = 256):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        random = np.random.default_rng(11)
        self.weights = [random.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        first, second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(x))
            for a in range(0, len(x), batch):
                at = order[a : a + batch]
                inner = np.tanh(x[at] @ self.weights[0] + self.weights[1])
                error = (_sigmoid(inner @ self.weights[2] + self.weights[3]) - y[at]) / len(at)
                back = np.outer(error, self.weights[2]) * (1 - inner * inner)
                slopes = [x[at].T @ back + decay * self.weights[0], back.sum(axis=0), inner.T @ error + decay * self.weights[2], np.array([error.sum()])]
                step += 1
                for k, slope in enumerate(slopes):
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.999 * second[k] + 0.001 * slope * slope
                    move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = self.weights[k] - rate * move
        self.temperature = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        inner = np.tanh((x - self.mean) / self.scale @ self.weights[0] + self.weights[1])
        return inner @ self.weights[2] + self.weights[3]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature, of a fixed grid, that makes these labels likeliest."""
        logits = self.logits(x)
        losses = []
        grid = np.geomspace(0.25, 16, 97)
        for t in grid:
            p = np.clip(_sigmoid(logits / t), 1e-9, 1 - 1e-9)
            losses.append(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
        self.temperature = float(grid[int(np.argmin(losses))])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def learn(pooled: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> Network | None:
    """Fit and calibrate on at most MOST_LABELLED labelled documents of the folds that are not held out."""
    known = labels.filter(F.col(label).isNotNull()).groupBy(id_col).agg(F.avg(F.col(label).cast("double")).alias("y"))
    own = fold(F.col(id_col), FOLDS)
    known = known.filter(own != HELD_OUT)
    # Bounded by the parameter, and the same rows each time.
    known = known.orderBy(F.xxhash64(id_col), id_col).limit(MOST_LABELLED)
    rows = pooled.join(known, id_col).select(F.col(id_col).alias("i"), (own == CALIBRATION).alias("check"), "y", "features")
    rows = rows.orderBy("i").limit(2 * MOST_LABELLED).toArrow()
    if not rows.num_rows:
        return None
    x = np.array(rows.column("features").to_pylist(), dtype=np.float64)
    y = rows.column("y").to_numpy().astype(np.float64)
    check = rows.column("check").to_numpy()
    if check.all() or not check.any():
        check = np.zeros(len(y), dtype=bool)
    network = Network(x[~check], y[~check])
    if check.any():
        network.calibrate(x[check], y[check])
    return network


def score(pooled: DataFrame, network: Network | None, id_col: str = "doc_id") -> DataFrame:
    """id, score."""
    shared = pooled.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]):
        own = shared.value
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, POOLS * SIZE)
            found = own.scores(flat.astype(np.float64)) if own else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(found)], ["i", "score"])

    kind = pooled.schema[id_col].dataType.simpleString()
    return pooled.select(F.col(id_col).alias("i"), "features").mapInArrow(run, f"i {kind}, score double").withColumnRenamed("i", id_col)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    pooled = Scratch(docs.sparkSession, "pooled").cut(pool(docs, word_vectors(docs, text), id_col, text))
    found = score(pooled, learn(pooled, labels, id_col, label), id_col)
    return found.select(
        id_col,
        (fold(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
