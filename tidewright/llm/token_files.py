"""Token ids in flat binary files.

Format, one set of files per shard, in ascending order of the ids' documents:
  <shard>.bin  token ids, unsigned, little endian, one document after the other; 16 bits each if all ids of the
               tokenizer fit, else 32
  <shard>.idx  offsets, unsigned 64-bit: of each document's first token in the whole corpus, and one end
  <shard>.doc  document ids, signed 64-bit;  <shard>.nul  one byte each, 1 where the id is null

Documents are range-partitioned and sorted, and every task writes the shard of its partition while it encodes,
so neither texts nor tokens pass through the driver. The first job returns one row per shard to the driver; a prefix
sum over those gives each shard its base, and a second job writes the offsets. These rows are in no table of the
shared folder: a task that writes one has its executor start processes (chmod) for every folder and file, and each of
them holds the memory of the executor a second time, for an instant, as far as a watcher can see. A file is written under a name of its own
attempt and then renamed, so a task that runs again after a lost executor replaces it with the same content.

Encoding calls the tokenizers library once for each distinct run of letters, marks or blanks that a worker
meets, since byte-level BPE never merges across those boundaries; a text with unusual blanks or with the text of
a special token goes to the library whole.

Defined results: a null or empty text is the end id alone; rows with equal ids are ordered by a hash of their
text; null ids come first; repeated rows are written as often as they occur; an empty table gives no shard.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.base import Memo, as_bytes, scratch_path, slices

END = 0
#: Bytes of distinct runs and their ids kept in a worker, twice at most.
CACHED = 64 << 20

_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_MARKS = r".,;:!?|*#$%&()\""
#: Runs that no token crosses, by the rules of the byte-level pattern: letters, marks, other text up to the next
#: blank, blanks but for the last before a text, and that one. A run of the first two kinds, which a lookahead
#: ends, is one word of the tokenizer; the apostrophe, which can begin a word, is left to the third kind.
_RUNS = re.compile(
    rf" ?[{_LETTERS}]+(?=[ \n\t\r{_MARKS}]|$)| ?[{_MARKS}]+(?=[ \n\t\r{_LETTERS}]|$)"
    r"| ?[^ \n\t\r]+|[ \n\t\r]+(?![^ \n\t\r])|[ \n\t\r]"
)
_LATIN_END = "\u0250"
#: Characters that engines may see as blanks or not; texts with them are encoded whole.
_ODD = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")


class Encoder:
    """Text to the ids of a byte-level BPE tokenizer file, as bytes of unsigned integers of `width` bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        before = self.tokenizer.pre_tokenizer
        if self.tokenizer.normalizer or not isinstance(before, ByteLevel) or before.add_prefix_space or not before.use_regex:
            raise ValueError("only byte-level tokenizers that keep texts as they are can be used here")
        # The letters that stand for the bytes of a Latin letter, as the library itself writes them.
        plain = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: plain.pre_tokenize_str(chr(c))[0][0] for c in range(ord(_LATIN_END))}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = f"<u{self.width}"
        self.known = Memo(CACHED)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _learn(self, runs: list[str]) -> list[bytes]:
        """Words of Latin letters go to the library's model, without another search for words; other runs through
        all of it."""
        out = []
        tokenize, letters, kind = self.model.tokenize, self.letters, "H" if self.width == 2 else "I"
        for run in runs:
            word = run[1:] if run[0] == " " else run
            if word.isalpha() and max(word) < _LATIN_END:
                out.append(array(kind, [t.id for t in tokenize(run.translate(letters))]).tobytes())
            else:
                out.append(self._whole(run))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        runs = [
            None if _ODD.search(t) or any(s in t for s in self.special) else _RUNS.findall(t) for t in texts
        ]
        known = self.known.holding(set().union(*filter(None, runs)), self._learn).__getitem__
        return [
            self._whole(t) if words is None else b"".join(map(known, words))
            for t, words in zip(texts, runs, strict=True)
        ]


_encoders: dict[str, Encoder] = {}


def load(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


class _Files:
    """The files of one shard, written under the attempt's own names."""

    def __init__(self, folder: str, shard: int, *kinds: str):
        self.store, self.folder = _store(folder)
        self.store.create_dir(self.folder)
        self.shard, self.attempt = shard, uuid.uuid4().hex
        self.open = {k: self.store.open_output_stream(self._path(k, f".{self.attempt}")) for k in kinds}

    def _path(self, kind: str, suffix: str = "") -> str:
        return f"{self.folder}/{self.shard:06d}.{kind}{suffix}"

    def write(self, kind: str, data: bytes) -> None:
        self.open[kind].write(data)

    def close(self) -> None:
        for kind, stream in self.open.items():
            stream.close()
            self.store.move(self._path(kind, f".{self.attempt}"), self._path(kind))


def _map(folder: str, shard: int, kind: str, dtype: str) -> np.ndarray:
    """A file as an array, memory-mapped where the folder is a file system of this machine."""
    store, root = _store(folder)
    path = f"{root}/{shard:06d}.{kind}"
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if store.get_file_info(path).size else np.empty(0, dtype=dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text: str = "text", path: str | None = None, end: int = END) -> DataFrame:
    """Write the files to a folder that all executors share; one row per shard: shard, n_docs, n_tokens, width, base."""
    spark = docs.sparkSession
    path = path or default_path()

    def encode(batches: Iterator[pa.RecordBatch]):
        shard, encoder, files = TaskContext.get().partitionId(), load(path), None
        n_docs = n_tokens = 0
        closing = np.array([end], dtype=encoder.dtype).tobytes()
        for batch in slices(batches, "t", rows=1024, most_bytes=8 << 20):
            files = files or _Files(folder, shard, "bin", "len", "doc", "nul")
            ids = [i + closing for i in encoder.encode([t.decode() for t in batch.column("t").to_pylist()])]
            keys = batch.column("i")
            files.write("bin", b"".join(ids))
            files.write("len", np.array([len(i) // encoder.width for i in ids], dtype="<u8").tobytes())
            files.write("doc", np.asarray(keys.fill_null(0), dtype="<i8").tobytes())
            files.write("nul", np.asarray(keys.is_null().cast(pa.uint8())).tobytes())
            n_docs, n_tokens = n_docs + len(ids), n_tokens + sum(map(len, ids)) // encoder.width
        if files:
            files.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [n_docs], "n_tokens": [n_tokens], "width": [encoder.width]})

    rows = docs.select(F.col(id_col).cast("long").alias("i"), as_bytes(F.col(text)).alias("t"))
    # The hash orders equal ids; the scan position spreads rows that agree in both over several shards.
    rows = rows.withColumn("h", F.xxhash64("t")).withColumn("p", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("i", "h", "p").sortWithinPartitions("i", "h", "p").select("i", "t")
    # One row per shard, so what the driver holds is bounded by the number of tasks.
    shards = rows.mapInArrow(encode, "shard long, n_docs long, n_tokens long, width long").toArrow().sort_by("shard")
    ends = np.cumsum(np.asarray(shards["n_tokens"], dtype=np.int64))
    bases = spark.createDataFrame(shards.append_column("base", pa.array(ends - np.asarray(shards["n_tokens"], dtype=np.int64))))

    def offsets(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = _map(folder, row["shard"], "len", "<u8")
                files = _Files(folder, row["shard"], "idx")
                files.write("idx", np.array([row["base"]], dtype="<u8").tobytes())
                last = np.uint64(row["base"])
                for a in range(0, len(lengths), 1 << 20):
                    part = np.cumsum(lengths[a : a + (1 << 20)], dtype=np.uint64) + last
                    last = part[-1]
                    files.write("idx", part.astype("<u8").tobytes())
                files.close()
            yield batch

    # A task for each shard; merged by size, its one row would leave all of them to one task.
    spread = bases.repartitionByRange(max(1, shards.num_rows), "shard")
    spread.mapInArrow(offsets, bases.schema).count()
    return bases


def read_tokens(shards: DataFrame, folder: str, most: int = 4096, at_once: int = 1 << 16) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens, ids_crc32. Each task reads a range of at most
    `at_once` documents of a shard."""

    def read(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                shard, first, last = row["shard"], row["first"], min(row["first"] + at_once, row["n_docs"])
                ids, at = _map(folder, shard, "bin", f"<u{row['width']}"), _map(folder, shard, "idx", "<u8")
                keys, null = _map(folder, shard, "doc", "<i8"), _map(folder, shard, "nul", "u1")
                base = at[0]
                for a in range(first, last, most):
                    b = min(a + most, last)
                    own = at[a : b + 1]
                    local = (own - base).astype(np.int64).tolist()
                    sums = [zlib.crc32(ids[x:y].astype("<u4")) for x, y in zip(local, local[1:], strict=False)]
                    columns = [
                        pa.array(np.asarray(keys[a:b]), mask=np.asarray(null[a:b]) == 1, type=pa.int64()),
                        pa.array(np.asarray(own[:-1]).astype(np.int64)),
                        pa.array(np.diff(local), type=pa.int64()),
                        pa.array(sums, type=pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(at_once).cast("long")))
    ranges = shards.select("shard", "width", "n_docs", first.alias("first"))
    spread = ranges.repartitionByRange(max(1, ranges.count()), "shard", "first")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Write the token files of a table to the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    shards = write_tokens(docs, folder, id_col, text, path)
    return read_tokens(shards, folder).withColumnRenamed("doc_id", id_col)
