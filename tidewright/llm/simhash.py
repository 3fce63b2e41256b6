"""SimHash near-dedup: fingerprints of word shingles, and a self-join of the binary trie of fingerprints.

Fingerprints that occur more than once are one fingerprint with its smallest id. Two of them that differ in at
most `bits` bits agree on one of bits + 1 blocks of the 64, so the trie is rotated once for each block, and only
subtrees whose block agrees are joined with themselves; this spreads the work by (rotation, block). A subtree
is a run of sorted fingerprints, a pair of nodes two runs and the bits in which their paths differ. Pairs are
traversed breadth first as flat arrays: both nodes go down to their children together, and a pair is dropped as
soon as its bits exceed the budget, a side is empty, or all below it is in one class already.

Subtrees with too many fingerprints for a task are cut into pairs of their nodes some levels down, as a table,
until each pair fits; so a third of all rows in near copies of one text is many tasks. Each task returns the
links of a spanning forest of what it joined, not all pairs, and the classes are joined by `components`.

Defined results: a text without words has fingerprint zero, linked like any other; a null text counts as empty;
texts with fewer words than a shingle are one shingle; repeated rows link; a null id is not counted as smallest
unless no other is there; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.base import Scratch, as_bytes, free_names
from tidewright.llm.components import components, with_roots

SHINGLE = 3
BITS = 3
SEED = 42
#: Fingerprints in a pair of nodes that one task joins at most.
CELL = 1 << 15
#: Levels by which a larger pair is cut down.
LEVELS = 4
#: Pairs of nodes traversed together.
_FRONT = 1 << 17


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each UTF-8 text as an unsigned 64-bit integer."""
    out = np.zeros(len(texts), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.lower().split()  # bytes: A-Z only, and the six blanks
        if len(words) > shingle:
            grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
        else:
            grams = [b" ".join(words)] if words else []
        own = np.fromiter(map(digest, grams, itertools.repeat(SEED)), dtype=">u8")
        ones = np.zeros(64, dtype=np.int64)
        for a in range(0, len(own), 1 << 15):
            part = own[a : a + (1 << 15)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        if len(own):
            out[i] = np.packbits(2 * ones > len(own)).view(">u8")[0]
    return out


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(values.tolist(), shingle).view(np.int64))

    return run(as_bytes(text))


class _Classes:
    """Union-find over positions, in arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:  # shorten all paths
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def trie_join(codes: np.ndarray, pairs: list[tuple], classes: _Classes, member: np.ndarray, bits: int) -> None:
    """Link the members of all pairs of codes within the budget.

    codes: rotated fingerprints, sorted within each run. pairs: (depth, a_lo, a_hi, b_lo, b_hi, differing bits)
    as arrays; a pair of a run with itself stands for the pairs within it. member: each code's place in classes.
    """
    below: dict[int, np.ndarray] = {}

    def ones(depth: int) -> np.ndarray:
        if depth not in below:
            bit = (codes >> np.uint64(63 - depth)) & np.uint64(1)
            below[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int32), dtype=np.int32)])
        return below[depth]

    stack = list(pairs)
    while stack:
        depth, al, ah, bl, bh, diff = stack.pop()
        # Nothing is left to learn from runs that are one class.
        label = classes.root[member]
        change = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        known = (change[ah - 1] == change[al]) & (change[bh - 1] == change[bl]) & (label[al] == label[bl])
        al, ah, bl, bh, diff = (x[~known] for x in (al, ah, bl, bh, diff))
        if depth == 64:
            classes.link(member[al], member[bl])  # equal codes never meet twice: runs hold distinct ones
            continue
        single = (ah - al == 1) & (bh - bl == 1)
        if single.any():
            a, b = al[single], bl[single]
            near = np.bitwise_count(codes[a] ^ codes[b]) <= bits
            classes.link(member[a[near]], member[b[near]])
            al, ah, bl, bh, diff = (x[~single] for x in (al, ah, bl, bh, diff))
        if not len(al):
            continue
        count = ones(depth)
        am, bm = ah - (count[ah] - count[al]), bh - (count[bh] - count[bl])
        self = al == bl
        cross = ~self
        one = np.ones(len(al), dtype=diff.dtype)
        parts = [
            (al, am, bl, bm, diff, slice(None)),
            (am, ah, bm, bh, diff, slice(None)),
            (al, am, bm, bh, diff + one, slice(None)),
            (am, ah, bl, bm, diff + one, cross),
        ]
        al, ah, bl, bh, diff = (np.concatenate([p[i][p[5]] for p in parts]) for i in range(5))
        size_a, size_b = ah - al, bh - bl
        live = (diff <= bits) & (size_a > 0) & (size_b > 0) & ~((al == bl) & (size_a < 2))
        al, ah, bl, bh, diff = (x[live] for x in (al, ah, bl, bh, diff))
        for i in range(0, len(al), _FRONT):
            part = slice(i, i + _FRONT)
            stack.append((depth + 1, al[part], ah[part], bl[part], bh[part], diff[part]))


def _join_cells(bits: int):
    """mapInArrow function: sorted cells to links. Batches are gathered until they hold some whole cells."""
    keys = ["rot", "depth", "pa", "pb", "diff"]

    def run(table: dict[str, np.ndarray]):
        head = np.ones(len(table["x"]) + 1, dtype=bool)
        head[1:-1] = np.any([table[k][1:] != table[k][:-1] for k in keys], axis=0)
        start = np.flatnonzero(head)
        lo, hi = start[:-1], start[1:]
        codes = table["x"].view(np.uint64)
        turn = (table["rot"] * (64 // (bits + 1))).astype(np.uint64)
        back = (codes >> turn) | np.where(turn > 0, codes << (np.uint64(64) - np.maximum(turn, np.uint64(1))), np.uint64(0))
        own, member = np.unique(back, return_inverse=True)
        sides = np.concatenate([[0], np.cumsum(table["side"])])
        mid = hi - (sides[hi] - sides[lo])
        self = table["pa"][lo] == table["pb"][lo]
        al, ah = lo, np.where(self, hi, mid)
        bl, bh = np.where(self, lo, mid), hi
        diff, depth = table["diff"][lo].astype(np.int64), table["depth"][lo]
        live = (ah > al) & (bh > bl) & ~(self & (ah - al < 2))
        classes = _Classes(len(own))
        pairs = [
            (int(d), *(x[live & (depth == d)] for x in (al, ah, bl, bh, diff))) for d in np.unique(depth[live]).tolist()
        ]
        trie_join(codes, pairs, classes, member, bits)
        linked = np.flatnonzero(classes.root != np.arange(len(own)))
        if len(linked):
            signed = own.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[classes.root[linked]])], ["a", "b"])

    def cells(batches):
        held: list[dict[str, np.ndarray]] = []
        for batch in batches:
            held.append({n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names})
            if sum(len(h["x"]) for h in held) >= 2 * CELL:
                table = {n: np.concatenate([h[n] for h in held]) for n in held[0]}
                same = np.all([table[k] == table[k][-1] for k in keys], axis=0)
                last = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
                if last:
                    yield from run({n: v[:last] for n, v in table.items()})
                held = [{n: v[last:] for n, v in table.items()}]
        if held:
            yield from run({n: np.concatenate([h[n] for h in held]) for n in held[0]})

    return cells


def _children(cells: DataFrame, bits: int) -> DataFrame:
    """Cells some levels further down: a member goes to each pair of child nodes that the budget still allows."""
    span = 1 << LEVELS
    below = F.shiftrightunsigned(F.expr("shiftleft(x, depth)"), 64 - LEVELS)
    near = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(span - 1)), lambda e: F.struct(e.cast("long").alias("e"), F.bit_count(F.col("c").bitwiseXOR(e)).alias("d"))),
        lambda p: p["d"] + F.col("diff") <= bits,
    )
    down = cells.withColumn("c", below).withColumn("p", F.explode(near))
    own, other = F.col("c"), F.col("p.e")
    same = F.col("pa") == F.col("pb")
    first = F.when(same, F.least(own, other)).when(F.col("side") == 0, own).otherwise(other)
    second = F.when(same, F.greatest(own, other)).when(F.col("side") == 0, other).otherwise(own)
    side = F.when(same, F.when(own <= other, 0).otherwise(1)).otherwise(F.col("side"))
    return down.select(
        "rot",
        (F.col("depth") + LEVELS).alias("depth"),
        (F.shiftleft("pa", LEVELS) + first).alias("pa"),
        (F.shiftleft("pb", LEVELS) + second).alias("pb"),
        (F.col("diff") + F.col("p.d")).cast("int").alias("diff"),
        side.cast("int").alias("side"),
        "x",
    )


def links(prints: DataFrame, bits: int = BITS, cell: int = CELL) -> DataFrame:
    """Links a, b between distinct fingerprints (column fp) that join all within `bits` bits into one class."""
    scratch = Scratch(prints.sparkSession, "simhash")
    block = 64 // (bits + 1)
    turned = [
        F.struct(
            F.lit(i).alias("rot"),
            (F.shiftleft("fp", i * block).bitwiseOR(F.shiftrightunsigned("fp", 64 - i * block)) if i else F.col("fp")).alias("x"),
        )
        for i in range(bits + 1)
    ]
    node = F.shiftrightunsigned("r.x", 64 - block)
    cells = prints.select("fp", F.explode(F.array(*turned)).alias("r")).select(
        "r.rot",
        F.lit(block).alias("depth"),
        node.alias("pa"),
        node.alias("pb"),
        F.lit(0).alias("diff"),
        F.lit(0).alias("side"),
        "r.x",
    )
    key = ["rot", "depth", "pa", "pb", "diff"]
    done = []
    while True:
        sizes = cells.groupBy(*key).agg(F.sum(1 - F.col("side")).alias("n0"), F.sum("side").alias("n1"))
        large = sizes.filter((F.col("n0") + F.col("n1") > cell) & (F.col("depth") + LEVELS <= 64))
        if large.isEmpty():
            break
        # Pairs with an empty side have nothing to join; large ones go down some levels.
        lone = (F.col("pa") == F.col("pb")) & (F.col("n0") < 2) | (F.col("pa") != F.col("pb")) & ((F.col("n0") == 0) | (F.col("n1") == 0))
        is_large = (F.col("n0") + F.col("n1") > cell) & (F.col("depth") + LEVELS <= 64)
        sized = scratch.cut(cells.join(scratch.cut(sizes.filter(~lone)), key).withColumn("large", is_large))
        done.append(sized.filter(~F.col("large")).select(cells.columns))
        cells = scratch.cut(_children(sized.filter("large").select(cells.columns), bits))
    for part in done:
        cells = cells.union(part)
    return (
        cells.repartition("rot", "pa", "pb", "depth")
        .sortWithinPartitions(*key, "side", "x")
        .mapInArrow(_join_cells(bits), "a long, b long")
    )


def classes(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """fp, root: the distinct fingerprints that are near another, with the smallest fingerprint of their class."""
    return with_roots(components(links(prints, bits)))


def _components(rows: DataFrame, fp: str, smallest: Column, bits: int) -> DataFrame:
    """_fp, _first: for each fingerprint, the smallest of a column's values over its class."""
    scratch = Scratch(rows.sparkSession, "simhash")
    least = scratch.cut(rows.groupBy(F.col(fp).alias("_fp")).agg(F.min(smallest).alias("_least")))
    near = scratch.cut(classes(least.select(F.col("_fp").alias("fp")), bits))
    named = near.select(F.col("node").alias("_fp"), F.col("root").alias("_root"))
    joined = least.join(named, "_fp", "left").withColumn("_root", F.coalesce("_root", "_fp"))
    joined = scratch.cut(joined)
    first = joined.groupBy("_root").agg(F.min("_least").alias("_first"))
    return scratch.cut(joined.join(first, "_root").select("_fp", "_first"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id: the smallest id it reaches by links."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.cut(docs.select(F.col(id_col).alias("_id"), fingerprint_column(F.col(text), shingle).alias("_print")))
    first = _components(rows, "_print", F.col("_id"), bits)
    out = rows.join(first, rows["_print"] == first["_fp"])
    return out.select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"),
        F.col("_first").alias("component_id"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The rows, with all their columns, of which one is left for each class: that with the smallest id, the row
    read first among equal ids, and one without an id only if no other has one."""
    row, fp = free_names(docs, "row", "print")
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.cut(
        docs.withColumn(row, F.monotonically_increasing_id()).withColumn(fp, fingerprint_column(F.col(text), shingle))
    )
    rank = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col(row).alias("r"))
    first = _components(marked, fp, rank, bits).select(F.col("_first.r").alias(row)).distinct()
    return marked.join(first, row, "left_semi").drop(row, fp)
