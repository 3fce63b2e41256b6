"""SentencePiece BPE encoding in merge rounds on flat arrays, and decoding; no library call on the texts.

A text becomes words that no piece can span. The symbols of many distinct words lie in one flat array, next to
the rank of each pair. In a round, a segmented minimum finds the best rank of every word; all its places merge at
once, of overlapping ones the leftmost, the arrays are compacted, and only the pairs beside a merge are ranked
anew. Words without a pair that is a piece leave. A merge whose piece makes a better one with a neighbour is the last
of its word in that round; others bring up no pair as good as their own. So a round does for each word the
next merges of the greedy order, and the ids are those of the library.

Words are cut further between two characters that stand side by side in no piece. A word takes a round for each
distinct piece that is merged in it, however long it is.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows give repeated
results; texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.base import Memo, as_bytes, slices

SPACE = "▁"
#: Bytes of distinct words and their ids kept in a worker, twice at most.
CACHED = 48 << 20
_NONE = np.int64(1) << 62


class PieceModel:
    """The vocabulary of a BPE model file as arrays. Symbols below `size` are pieces; a character that is no piece
    has the symbol size + its code point."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        odd = "ﬁ  Ａ "
        if model.normalize(odd) != SPACE + odd.replace(" ", SPACE):
            raise ValueError("only models that keep texts as they are, with a space before, can be used here")
        n = self.size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        byte = [model.is_byte(i) for i in range(n)]
        ids = {p: i for i, p in enumerate(self.pieces) if not special[i] and not byte[i]}
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.byte_ids[[int(self.pieces[i][3:5], 16) for i in range(n) if byte[i]]] = [i for i in range(n) if byte[i]]

        # Pairs of symbols that make a piece; equal scores are equal ranks, so the place decides between them.
        scores = sorted({-model.get_score(i) for i in ids.values()})
        ranks = {s: r for r, s in enumerate(scores)}
        self.width = np.int64(n + 0x110000)
        keys, values = [], []
        joined = set()
        for piece, i in ids.items():
            joined.update((ord(a) << 21) | ord(b) for a, b in zip(piece, piece[1:], strict=False))
            for cut in range(1, len(piece)):
                pair = [ids.get(x, n + ord(x) if len(x) == 1 else None) for x in (piece[:cut], piece[cut:])]
                if None not in pair:
                    keys.append(pair[0] * int(self.width) + pair[1])
                    values.append((ranks[-model.get_score(i)], i))
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.ranks = np.array([v[0] for v in values], dtype=np.int64)[order]
        self.made = np.array([v[1] for v in values], dtype=np.int64)[order]
        self.joined = np.array(sorted(joined), dtype=np.int64)
        own = {i: ranks[-model.get_score(i)] for p, i in ids.items() if len(p) > 1}
        # Runs of spaces rank alike and behind all else: what is left of spaces in the end is cut into the longest runs, from
        # the left, and the ids of a shorter one.
        alike: dict[int, list[str]] = {}
        for piece, i in ids.items():
            if i in own:
                alike.setdefault(own[i], []).append(piece)
        tied = [piece for group in alike.values() if len(group) > 1 for piece in group]
        self.blanks = {k: model.encode(" " * (k - 1)) for k in range(1, max(map(len, tied), default=0) + 1)}
        if tied:
            self.blanks[1] = [ids[SPACE]]
            longest = len(self.blanks)
            others = [p for p in ids if SPACE * 2 in p and p not in tied]
            runs = [self.blanks[longest] * (k // longest) + self.blanks.get(k % longest, []) for k in range(2, 4 * longest)]
            if set("".join(tied)) != {SPACE} or others or own[ids[tied[0]]] < max(alike) or any(model.encode(" " * (k + 1)) != r for k, r in enumerate(runs)):
                raise ValueError("only models in which no two pieces rank alike, but for runs of spaces, can be used here")
            stay = ~np.isin(self.made, [ids[p] for p in tied])
            self.keys, self.ranks, self.made = self.keys[stay], self.ranks[stay], self.made[stay]
        # Pieces that make a better one with some neighbour: merging one may use up the next.
        self.early = np.zeros(n, dtype=bool)
        for key, (rank, _) in zip(keys, values, strict=True):
            for part in divmod(key, int(self.width)):
                if own.get(part, -1) >= rank:
                    self.early[part] = True
        self.symbols = np.arange(n, n + 0x110000, dtype=np.int64)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i

        # A control character that is in no longer piece is a word of its own; this makes words repeat more.
        lone = "".join(c for c in "\n\r\t" if not any(c in p for p in ids if len(p) > 1))
        self.words = re.compile(f"[{lone}]|{SPACE}+[^{SPACE}{lone}]*|[^{SPACE}{lone}]+" if lone else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.known = Memo(CACHED)

        # For decoding: the bytes of each id.
        surfaces = [
            bytes([int(p[3:5], 16)]) if byte[i] else b"" if model.is_control(i) else " ⁇ ".encode() if special[i] else p.replace(SPACE, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.flat = np.frombuffer(b"".join(surfaces), dtype=np.uint8)
        self.lengths = np.array([len(s) for s in surfaces], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.is_empty = self.lengths == 0
        self.leading = np.array([p.startswith(SPACE) and not byte[i] for i, p in enumerate(self.pieces)])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece that each pair makes; rank -1 where it makes none."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], -1), self.made[at]

    def _rounds(self, symbols: np.ndarray, starts: np.ndarray, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Parts of (word, symbol left of it); the words with these numbers are the runs that begin at starts."""
        out = []
        lengths = np.diff(starts, append=len(symbols))
        last = np.zeros(len(symbols), dtype=bool)
        last[starts[1:] - 1] = True
        last[-1:] = True
        following = np.append(symbols[1:], 0)
        rank, made = self._rank(symbols, following)
        rank = np.where(last, -1, rank)
        while len(words):
            best = np.minimum.reduceat(np.where(rank >= 0, rank, _NONE), starts)
            done = best == _NONE
            if done.any():
                stay = np.repeat(~done, lengths)
                out.append((np.repeat(words[done], lengths[done]), symbols[~stay]))
                symbols, rank, made, last = symbols[stay], rank[stay], made[stay], last[stay]
                words, lengths, best = words[~done], lengths[~done], best[~done]
                if not len(words):
                    break
                starts = np.cumsum(lengths) - lengths
            # All places of the best pair of their word; of places in a row every second one, from the left.
            at = np.flatnonzero(rank == np.repeat(best, lengths))
            place = np.arange(len(at))
            head = np.append(True, at[1:] != at[:-1] + 1)
            at = at[(place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0]
            if self.early[made[at]].any():
                at = at[~self._waits(symbols, rank, made, last, starts, at)]
            merges = np.diff(np.searchsorted(at, np.append(starts, len(symbols))))
            symbols[at] = made[at]
            last[at] = last[at + 1]
            stay = np.ones(len(symbols), dtype=bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))
            symbols, rank, made, last = symbols[stay], rank[stay], made[stay], last[stay]
            lengths = lengths - merges
            starts = np.cumsum(lengths) - lengths
            # The pairs that begin with the new symbol, and those that end with it.
            near = np.concatenate([at, np.maximum(at - 1, 0)])
            new, piece = self._rank(symbols[near], symbols[np.minimum(near + 1, len(symbols) - 1)])
            rank[near] = np.where(last[near], -1, new)
            made[near] = piece
        return out

    def _waits(self, symbols, rank, made, last, starts, at) -> np.ndarray:
        """Of the places to merge, those behind one of their word whose piece makes a better one with a neighbour."""
        piece = made[at]
        # The neighbour on the left may be the piece merged just before.
        left = symbols[np.maximum(at - 1, 0)]
        left[1:] = np.where(at[1:] == at[:-1] + 2, piece[:-1], left[1:])
        right = symbols[np.minimum(at + 2, len(symbols) - 1)]
        before, _ = self._rank(left, piece)
        after, _ = self._rank(piece, right)
        begins = np.zeros(len(symbols), dtype=bool)
        begins[starts] = True
        better = (before >= 0) & (before <= rank[at]) & ~begins[at]
        better |= (after >= 0) & (after <= rank[at]) & ~last[at + 1]
        word = np.searchsorted(starts, at, side="right")
        so_far = np.cumsum(better)
        first = np.searchsorted(word, word)
        return so_far - better > (so_far - better)[first]

    def _learn(self, words: list[str]) -> list[tuple[bytes, str]]:
        """Ids of distinct words, as bytes and in decimal, all rounds together."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        heads = np.cumsum([0, *(len(w) for w in words)])
        # A word ends, or is cut, where the next character never follows this one inside of a piece.
        pair = (chars[:-1] << 21) | chars[1:]
        at = np.minimum(np.searchsorted(self.joined, pair), len(self.joined) - 1)
        cut = np.ones(len(chars), dtype=bool)
        cut[1:] = self.joined[at] != pair
        cut[heads[:-1]] = True
        starts = np.flatnonzero(cut)
        symbols = self.symbols[chars]
        parts = self._rounds(symbols, starts, np.arange(len(starts)))
        run = np.concatenate([p[0] for p in parts])
        order = np.argsort(run, kind="stable")
        run, symbols = run[order], np.concatenate([p[1] for p in parts])[order]
        run, symbols = self._gathered(run, symbols)
        # Characters that are no piece become the ids of their bytes.
        odd = np.flatnonzero(symbols >= self.size)
        if len(odd):
            spelled = [self.byte_ids[np.frombuffer(chr(c).encode(), dtype=np.uint8)] for c in (symbols[odd] - self.size).tolist()]
            sizes = np.ones(len(symbols), dtype=np.int64)
            sizes[odd] = [len(x) for x in spelled]
            run, symbols = np.repeat(run, sizes), np.repeat(symbols, sizes)
            symbols[symbols >= self.size] = np.concatenate(spelled)
        bounds = np.searchsorted(run, np.searchsorted(starts, heads)).tolist()
        raw, said = symbols.astype(np.int32).tobytes(), list(map(str, symbols.tolist()))
        return [(raw[4 * a : 4 * b], ",".join(said[a:b])) for a, b in zip(bounds, bounds[1:], strict=False)]

    def _gathered(self, run: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spaces in a row become the pieces of runs of them."""
        single = symbols == self.symbols[ord(SPACE)]
        joins = np.append(False, single[1:] & single[:-1] & (run[1:] == run[:-1]))
        if not joins.any() or not self.blanks:
            return run, symbols
        place = np.arange(len(symbols))
        inside = (place - np.maximum.accumulate(np.where(joins, 0, place))) % len(self.blanks)
        heads = np.flatnonzero((inside == 0) | ~joins)
        sizes = np.where(single[heads], np.diff(heads, append=len(symbols)), 0)
        many = np.array([1, *(len(self.blanks[k]) for k in sorted(self.blanks))])[sizes]
        out = np.repeat(symbols[heads], many)
        out[np.repeat(sizes > 0, many)] = [i for size in sizes[sizes > 0].tolist() for i in self.blanks[size]]
        return np.repeat(run[heads], many), out

    def split(self, text: str) -> list[str]:
        return self.words.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, texts: Iterable[str]) -> list[tuple[np.ndarray, str]]:
        """For each text its ids and the same in decimal, joined by commas."""
        split = [self.split(t) for t in texts]
        known = self.known.holding(set().union(*split), self._learn)
        out = []
        for words in split:
            found = [known[w] for w in words]
            out.append((np.frombuffer(b"".join([f[0] for f in found]), dtype=np.int32), ",".join([f[1] for f in found])))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids. Runs of bytes that are no UTF-8 give a replacement character per byte; ids without
        a text end such a run."""
        ids = np.asarray(ids, dtype=np.int64)
        spoken = np.flatnonzero(~self.is_empty[ids])
        lead = len(spoken) > 0 and bool(self.leading[ids[spoken[0]]])
        if len(spoken) < len(ids):
            parts = np.split(ids, np.flatnonzero(self.is_empty[ids]))
            return "".join(self._decode(p) for p in parts)[1 if lead else 0 :]
        return self._decode(ids)[1 if lead else 0 :]

    def _decode(self, ids: np.ndarray) -> str:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ids) else 0
        raw = self.flat[np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(total)].tobytes()
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _replaced(raw)


def _replaced(raw: bytes) -> str:
    """UTF-8 with one replacement character for each byte that belongs to no character."""
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + n].decode())
            except UnicodeDecodeError:
                continue
            i += n
            break
        else:
            out.append("�")
            i += 1
    return "".join(out)


_models: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """One model per worker process."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [x.decode() for x in batch.column(column).to_pylist()]


def encode_column(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: id, ids (array of int), decoded text."""
    path = path or default_path()

    def run(batches):
        model = load(path)
        for batch in slices(batches, "t"):
            ids = [i for i, _ in model.encode(_texts(batch, "t"))]
            decoded = pa.array([model.decode(i) for i in ids], type=pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(ids, type=pa.list_(pa.int32())), decoded], ["i", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("i"), as_bytes(F.col(text)).alias("t")).mapInArrow(run, f"i {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("i", id_col)


def piece_digest(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: id, n_tokens, hash of the ids in decimal joined by commas, hash of the decoded text."""
    path = path or default_path()

    def run(batches):
        model = load(path)
        for batch in slices(batches, "t"):
            rows = model.encode(_texts(batch, "t"))
            columns = [
                batch.column("i"),
                pa.array([len(i) for i, _ in rows], type=pa.int64()),
                pa.array([hashlib.sha256(s.encode()).hexdigest() for _, s in rows]),
                pa.array([hashlib.sha256(model.decode(i).encode()).hexdigest() for i, _ in rows]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["i", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"i {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    out = docs.select(F.col(id_col).alias("i"), as_bytes(F.col(text)).alias("t")).mapInArrow(run, schema)
    return out.withColumnRenamed("i", id_col)
