"""Alignment of the tokens of two tokenizers, by interval coalescing on the bytes of the text.

Tokens of both sides are intervals of bytes. Sorted by start, with the running maximum of their ends, a new group
begins where a start reaches that maximum; within a group, tokens of one side overlap tokens of the other. The last
tokens of a group end together: they are linked.

Side A is a byte-level BPE tokenizer, on a space and the text; side B a SentencePiece BPE model, which adds that
space itself. Both cut before a space or line break that follows a visible character, so a worker aligns each distinct
stretch between such places once, many of them together in flat arrays, and a document is put together from its stretches.

Corpus-wide counts of linked pairs are a grouped sum over the partial counts of each task. The HEAD most frequent
pairs at most are broadcast with their counts, and are looked up where the documents lie; if there are more, the others are
joined by a shuffle. Both give the same numbers. Each text is encoded once: a row's distinct links are written with it.

Defined results: a null or empty text, and one whose joined tokens of either side are not the bytes of the space and the text
(it holds the sign that model B writes for a space), has no tokens and takes no part in the counts. Texts of special tokens are
plain text. Repeated rows count as often as they occur; ids may be null; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.base import Memo, Scratch, as_bytes, count_step, least_step, slices

SPACE = "▁"
#: Pairs broadcast with their counts: 17 bytes each.
HEAD = 1 << 20
#: Bytes of distinct stretches kept in a worker, twice at most, and characters that are encoded at once.
CACHED, JOINED = 64 << 20, 1 << 16
#: Distinct pairs that a task holds while it counts.
MOST_PAIRS = 1 << 21
#: A stretch that stands before those that are encoded together, so that none of them is the first.
_LEAD = " a"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: visible Latin-1 ones are their own, the others follow
    from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def coalesce(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, from 0; the tokens of a side follow each other without a gap."""
    a_start, b_start = np.append(0, a_end[:-1]), np.append(0, b_end[:-1])
    starts, ends = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    side = np.repeat([0, 1], [len(a_end), len(b_end)])
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    group = np.zeros(len(order), dtype=np.int64)
    group[order[1:]] = np.cumsum(starts[order][1:] >= reached[:-1])
    return group[: len(a_end)], group[len(a_end) :]


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of A and B tokens that share a byte: for each A token, the run of B tokens from the one
    that holds its first byte to the one that holds its last."""
    first = np.searchsorted(b_end, np.append(0, a_end[:-1]), side="right")
    last = np.searchsorted(b_end, a_end - 1, side="right")
    n = last - first + 1
    a = np.repeat(np.arange(len(a_end)), n)
    return a, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


class Aligner:
    """Two tokenizers, and what they make of the stretches of texts."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        names = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        self.a_bytes = [b""] * (names[-1][1] + 1)
        for name, i in names:
            self.a_bytes[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece of the second tokenizer goes on after a space")
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes))
        breaks = " " if any("\n" in p and len(p) > 1 for p in pieces) else r" \n"
        self.cut = re.compile(rf"(?<=\S)(?=[{breaks}])")
        self.known = Memo(CACHED)

    def stretches(self, text: str) -> list[str]:
        """Parts of the space and the text that both tokenizers encode alone as they do here."""
        return self.cut.split(" " + text)

    def _encode(self, joined: str) -> tuple[list[int], list[int]] | None:
        """Ids of both sides, if their bytes are those of the text, which begins with a space."""
        raw = joined.encode()
        a, b = self.a.encode(joined, add_special_tokens=False).ids, self.b.encode(joined[1:])
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        return a, b

    def _align(self, joined: list[str]) -> list[tuple | None]:
        """(groups as text, tokens of A, tokens of B, overlapping pairs, linked pairs as 64-bit integers) of each
        stretch but the first; None for each if they cannot be told apart by their bytes."""
        ids = self._encode("".join(joined))
        if ids is None:
            return [None] * (len(joined) - 1)
        a, b = np.array(ids[0], dtype=np.int64), np.array(ids[1], dtype=np.int64)
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_group, b_group = coalesce(a_end, b_end)
        n = int(a_group[-1]) + 1
        a_last, b_last = np.searchsorted(a_group, np.arange(n), side="right"), np.searchsorted(b_group, np.arange(n), side="right")
        links = a[a_last - 1] * len(self.b_bytes) + b[b_last - 1]
        ends = np.cumsum([len(x.encode()) for x in joined])
        # The last group of each stretch ends with it.
        heads = np.searchsorted(a_end[a_last - 1], ends) + 1
        if (a_end[a_last[heads - 1] - 1] != ends).any():
            raise ValueError("a token crosses a place at which texts are cut")
        shared = np.bincount(a_group[overlaps(a_end, b_end)[0]], minlength=n)
        a_text, b_text, a_at, b_at = list(map(str, ids[0])), list(map(str, ids[1])), [0, *a_last.tolist()], [0, *b_last.tolist()]
        groups = [f"{','.join(a_text[a_at[g] : a_at[g + 1]])}|{','.join(b_text[b_at[g] : b_at[g + 1]])}" for g in range(n)]
        before = np.cumsum(np.append(0, shared))
        heads = heads.tolist()
        return [
            (";".join(groups[x:y]), a_at[y] - a_at[x], b_at[y] - b_at[x], int(before[y] - before[x]), links[x:y].tobytes())
            for x, y in zip(heads, heads[1:], strict=False)
        ]

    def _learn(self, stretches: list[str]) -> list[tuple | None]:
        out: list[tuple | None] = [None] * len(stretches)
        # A stretch that ends in a blank, or may not come back as it is, is encoded without others.
        alone = [i for i, x in enumerate(stretches) if x[-1].isspace() or SPACE in x]
        held, size = [], 0
        apart = set(alone)
        for i, x in enumerate(stretches):
            if i not in apart:
                held.append(i)
                size += len(x)
            if held and (size > JOINED or i == len(stretches) - 1):
                found = self._align([_LEAD, *(stretches[k] for k in held)])
                if None in found:
                    alone += held
                else:
                    for k, value in zip(held, found, strict=True):
                        out[k] = value
                held, size = [], 0
        for i in alone:
            out[i] = self._align([_LEAD, stretches[i]])[0]
        return out

    def align(self, texts: list[str]) -> list[list[tuple]]:
        """The stretches of each text; none for a text without tokens."""
        split = [self.stretches(t) if t else [] for t in texts]
        known = self.known.holding(set().union(*split), self._learn)
        out = []
        for own in split:
            found = [known[x] for x in own]
            out.append([] if None in found else found)
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def load(a_path: str, b_path: str) -> Aligner:
    """One aligner per worker process."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    bounds = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([*parts, np.empty(0, dtype=np.int64)]), type=kind))


def aligned(docs: DataFrame, id_col: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per document: id, groups: an array of (a: ids of A, b: ids of B), in the order of the text."""
    paths = paths or default_paths()
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]):
        aligner = load(*paths)
        for batch in slices(batches, "t"):
            rows = []
            for found in aligner.align([t.decode() for t in batch.column("t").to_pylist()]):
                sides = [g.split("|") for f in found for g in f[0].split(";")]
                rows.append([{"a": list(map(int, a.split(","))), "b": list(map(int, b.split(",")))} for a, b in sides])
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(rows, type=kind)], ["i", "groups"])

    of = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("i"), as_bytes(F.col(text)).alias("t"))
    return out.mapInArrow(run, f"i {of}, groups array<struct<a: array<int>, b: array<int>>>").withColumnRenamed("i", id_col)


def _links(rows: DataFrame, paths: tuple[str, str], kind: str) -> DataFrame:
    """One row per document: its own figures, and its distinct linked pairs with how often they occur in it."""

    def run(batches: Iterator[pa.RecordBatch]):
        aligner = load(*paths)
        for batch in slices(batches, "t", rows=512):
            texts = aligner.align([t.decode() for t in batch.column("t").to_pylist()])
            digests = [hashlib.sha256(";".join([f[0] for f in t]).encode()).hexdigest() if t else "" for t in texts]
            sums = [[sum([f[k] for f in t]) for t in texts] for k in (1, 2, 3)]
            distinct = [np.unique(np.frombuffer(b"".join([f[4] for f in t]), dtype=np.int64), return_counts=True) for t in texts]
            columns = [
                batch.column("i"),
                *(pa.array(x, type=pa.int64()) for x in sums),
                pa.array(digests),
                _lists([p for p, _ in distinct], pa.int64()),
                _lists([n for _, n in distinct], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["i", "n_a", "n_b", "n_overlaps", "groups_sha256", "pairs", "times"])

    return rows.mapInArrow(run, f"i {kind}, n_a long, n_b long, n_overlaps long, groups_sha256 string, pairs array<long>, times array<int>")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of all rows, how often they occur, and the row of each."""
    pairs, times = batch.column("pairs"), batch.column("times")
    sizes = np.diff(np.asarray(pairs.offsets))
    return pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)


def pair_counts(links: DataFrame) -> DataFrame:
    """pair, n: how many links of the corpus link that pair of ids."""

    def count(batches: Iterator[pa.RecordBatch]):
        keys, sums = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def settle() -> None:
            nonlocal keys, sums, held, size
            keys, back = np.unique(np.concatenate([keys, *(p for p, _ in held)]), return_inverse=True)
            all_times, sums = np.concatenate([sums, *(t for _, t in held)]), np.zeros(len(keys), dtype=np.int64)
            np.add.at(sums, back, all_times)
            held, size = [], 0

        for batch in batches:
            pairs, times, _ = _flat(batch)
            held.append((pairs, times))
            size += len(pairs)
            if size > MOST_PAIRS:
                settle()
            if len(keys) > MOST_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])
                keys, sums = keys[:0], sums[:0]
        settle()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])

    return links.select("pairs", "times").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def token_alignment(docs: DataFrame, id_col: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None, head: int = HEAD) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps (pairs of A and
    B tokens that share a byte)."""
    spark = docs.sparkSession
    paths = paths or default_paths()
    scratch = Scratch(spark, "links")
    rows = docs.select(F.col(id_col).alias("i"), as_bytes(F.col(text)).alias("t"))
    kind = docs.schema[id_col].dataType.simpleString()
    links = scratch.cut(_links(rows, paths, kind))
    counts = pair_counts(links)
    side = F.col("pair") % len(load(*paths).b_bytes)
    counts = scratch.cut(counts.withColumn("b", side.cast("int")))
    # A row for each id of B: no more than its vocabulary has.
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    counts = counts.join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    sizes = {r[0]: r[1] for r in counts.groupBy(count_step(F.col("n"))).count().collect()}
    lowest = least_step(sizes, head)
    table = counts.filter(count_step(F.col("n")) >= lowest).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast([table.column(c).to_numpy() for c in ("pair", "n", "best")])

    def look_up(batches: Iterator[pa.RecordBatch]):
        keys, sums, best = shared.value
        for batch in batches:
            pairs, times, row = _flat(batch)
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            inside = keys[at] == pairs if len(keys) else np.zeros(len(pairs), dtype=bool)
            figures = np.zeros((3, batch.num_rows), dtype=np.int64)
            np.add.at(figures[0], row, times)
            np.add.at(figures[1], row[inside], times[inside] * best[at[inside]])
            np.add.at(figures[2], row[inside], times[inside] * sums[at[inside]])
            rest = np.bincount(row[~inside], minlength=batch.num_rows)
            cuts = np.cumsum(rest)[:-1]
            columns = [
                *(batch.column(c) for c in ("i", "n_a", "n_b", "n_overlaps", "groups_sha256")),
                *(pa.array(f) for f in figures),
                _lists(np.split(pairs[~inside], cuts), pa.int64()),
                _lists(np.split(times[~inside], cuts), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["i", "n_a", "n_b", "n_overlaps", "groups_sha256", "n", "best", "total", "rest", "often"])

    schema = f"i {kind}, n_a long, n_b long, n_overlaps long, groups_sha256 string, n long, best long, total long, rest array<long>, often array<long>"
    out = links.mapInArrow(look_up, schema)
    if any(step < lowest for step in sizes):
        out = scratch.cut(out.withColumn("row", F.monotonically_increasing_id()))
        rare = out.select("row", F.explode(F.arrays_zip("rest", "often")).alias("x")).select("row", F.col("x.rest").alias("pair"), "x.often")
        met = rare.join(counts.withColumnRenamed("n", "sum").withColumnRenamed("best", "is_best"), "pair").groupBy("row").agg(
            F.sum(F.when(F.col("is_best"), F.col("often")).otherwise(0)).alias("more_best"), F.sum(F.col("often") * F.col("sum")).alias("more")
        )
        out = out.join(met, "row", "left")
    else:
        out = out.withColumns({"more_best": F.lit(0), "more": F.lit(0)})
    return out.select(
        F.col("i").alias(id_col),
        "n_a",
        "n_b",
        F.col("n").alias("n_groups"),
        F.col("n").alias("n_links"),
        (F.col("best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("more", F.lit(0))).alias("count_sum"),
        "groups_sha256",
        "n_overlaps",
    )
