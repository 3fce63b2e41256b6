"""Token alignment, document fingerprints and collocations against SQL, brute force, the libraries and awkward rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import messy_rows
from tidewright.llm import alignment, collocations, counting_filter, fingerprints
from tidewright.llm.queries import QUERIES

SPACES = [
    "a\nb", "a \n b  c\n\n d ", "\u00a0x\u2003 y\u3000 z", "a\u0085 b", "tab\tx \t y\x1c z\x1d", "can't they'll  'tis 's", "\r\n x\r\ny",
    "a\u2581b c", "\u00e9 \u200b x\ufeff y", "<|endoftext|> <s> </s><unk>", " lead", "trail ", "\x00 \x01 x", "  ", "\u6f22\u5b57 \u304b\u306a\n\u4ea4 \U0001d11e",
]


def bag(frame):
    return Counter(map(tuple, frame.collect()))


# --- alignment ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("head", [1 << 20, 150, 0])
def test_alignment_equals_brute_force(spark, documents, messy, head):
    rows = [(i, t) for i, t, *_ in messy_rows()] + [(5000 + i, t) for i, t in enumerate(SPACES)]
    short = [(r["doc_id"], r["text"]) for r in documents.filter("n_chars < 1500").limit(50).collect()]
    for data in (rows, short):
        frame = spark.createDataFrame([(*r, "x") for r in data], "doc_id long, text string, pairs string").repartition(3)
        want = brute.aligned([t for _, t in data])
        got = alignment.token_alignment(frame, head=head)
        assert Counter(tuple(r)[:-1] for r in got.collect()) == Counter((i, *w[:-1]) for (i, _), w in zip(data, want, strict=True))
        shared = Counter((i, w[6], w[-1]) for (i, _), w in zip(data, want, strict=True) if w[-1] is not None)
        assert not shared - Counter((r[0], r[7], r[8]) for r in got.collect())


def test_groups_hold_the_ids_of_both_sides(spark):
    frame = spark.createDataFrame([(1, "Antidisestablishmentarianism, caf\u00e9 \u6f22."), (2, None), (3, "a\u2581b")], "doc_id long, text string")
    rows = {r["doc_id"]: r["groups"] for r in alignment.aligned(frame).collect()}
    assert rows[2] == rows[3] == []
    aligner = alignment.load(*alignment.default_paths())
    text = "Antidisestablishmentarianism, caf\u00e9 \u6f22."
    assert [i for g in rows[1] for i in g["a"]] == aligner.a.encode(" " + text, add_special_tokens=False).ids
    assert [i for g in rows[1] for i in g["b"]] == aligner.b.encode(text)
    for g in rows[1]:
        assert b"".join(aligner.a_bytes[i] for i in g["a"]) == b"".join(aligner.b_bytes[i] for i in g["b"]) != b""


def test_intervals_of_random_cuts():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 60)
        a, b = (np.array([*sorted(rng.sample(range(1, n), rng.randint(0, n - 1))), n]) for _ in range(2))
        a_group, b_group = alignment.coalesce(a, b)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert a_group.tolist() == [sum(c < e for c in common) for e in a] and b_group.tolist() == [sum(c < e for c in common) for e in b]
        pairs = {(i, j) for i, e in enumerate(a) for j, f in enumerate(b) if max([0, *a][i], [0, *b][j]) < min(e, f)}
        assert set(zip(*(x.tolist() for x in alignment.overlaps(a, b)), strict=True)) == pairs


def test_alignment_of_an_empty_table(nothing):
    assert alignment.token_alignment(nothing).collect() == [] == alignment.aligned(nothing).collect()


# --- fingerprints ------------------------------------------------------------------------------------------


def test_fingerprints_equal_brute_force(spark, documents, messy):
    for frame in (documents, messy, messy.filter("doc_id = 3")):
        rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
        got = Counter((*r[:5], *(round(x, 9) for x in r[5:])) for r in fingerprints.edited_fingerprints(frame).collect())
        assert got == Counter(brute.fingerprints(rows)) and len(rows) > 0


def test_many_buckets_and_equal_ids(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 2, 2, i]), " ".join(rng.choices("abcdefg", k=rng.randint(0, 9)))) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = Counter((*r[:5], *(round(x, 9) for x in r[5:])) for r in fingerprints.edited_fingerprints(frame).collect())
    assert got == Counter(brute.fingerprints(rows))


def test_sketches_merge_and_estimate(spark, documents):
    texts = [r["text"] for r in documents.filter("n_chars > 3000").limit(20).collect()]
    pairs = [(a, b) for a, b in zip(texts, [*texts[1:], ""], strict=True)] + [("one", "two words"), ("", "x")]
    frame = spark.createDataFrame(pairs, "a string, b string")
    frame = frame.select("a", "b", *[fingerprints.sketch(F.col(c)).alias(f"s{c}") for c in "ab"], fingerprints.sketch(F.concat_ws(" ", "a", "b")).alias("whole"))
    rows = frame.select("*", fingerprints.merge(F.col("sa"), F.col("sb")).alias("m"), fingerprints.containment(F.col("sa"), F.col("whole")).alias("c")).collect()
    for r in rows:
        grams = sorted({*r["sa"], *r["sb"]})
        assert r["sa"] == brute.sketch(r["a"]) and r["m"] == ([h for h in grams if h < "2"] or grams[:1])
        # A short text inside of a much longer one.
        assert len(r["sa"]) < 10 or r["c"] > 0.9


def test_fingerprints_run_no_python_and_take_empty_tables(spark, nothing):
    text = fingerprints.edited_fingerprints(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "MapIn" not in text and "ArrowEval" not in text
    assert fingerprints.edited_fingerprints(nothing).collect() == []


# --- collocations ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("ids", [1 << 18, 40, 0])
def test_collocations_equal_brute_force(spark, messy, ids, monkeypatch):
    rng = random.Random(ids)
    words = ["new", "york", "city", "the", "The", "of", "a", "caf\u00e9", "x" * 70, "\u6f22", "rare"]
    rows = [(rng.choice(["en", "de", None]), " ".join(rng.choices(words, weights=[9, 9, 5, 20, 3, 9, 9, 4, 3, 4, 1], k=rng.randint(0, 60)))) for _ in range(150)]
    rows = [(lang, t.replace(" a ", ", ").replace("of the", "of\tthe\n")) for lang, t in rows]
    rows += [(lang, t) for _, t, lang, _ in messy_rows()] + [("und", "new york city " * 40), ("xx", None), ("yy", "once only")]
    # Filters and counters are sent off in small parts.
    monkeypatch.setattr(collocations, "MOST_HELD", 200)
    monkeypatch.setattr(collocations, "MOST_WORDS", 30)
    monkeypatch.setattr(collocations, "_PART", 200)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n long, phrase string").repartition(5)
    for least, top in ((3, 2000), (10, 7)):
        got = collocations.collocations(frame, least=least, top=top, most_ids=ids)
        assert bag(got) == Counter(brute.collocations(rows, least, top))


def test_collocations_of_little(nothing, spark):
    assert collocations.collocations(nothing).collect() == []
    assert collocations.collocations(spark.createDataFrame([("en", None), (None, "")], "lang string, text string")).collect() == []
    with pytest.raises(ValueError, match="do not fit"):
        collocations.collocations(nothing, longest=4)


def test_scores_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", "a", 9 * 10**14), ("en", "b", 8 * 10**14), ("en", None, 10**15)], "lang string, word string, n long")
    phrases = spark.createDataFrame([("en", 2, "a b", 7 * 10**14)], "lang string, n int, phrase string, f long")
    row = collocations.scored(words, phrases).first()
    assert row["score"] == 10**6 * (7 * 10**14) ** 2 // (9 * 10**14 * 8 * 10**14)


# --- counting filters --------------------------------------------------------------------------------------


@pytest.mark.parametrize("bits, block_bits", [(36, 6), (54, 0), (54, 11), (7, 3), (64, 5)])
def test_filters_are_lossless_and_merge(bits, block_bits):
    rng = np.random.default_rng(bits)
    order = counting_filter.Permutation(bits)
    some = rng.integers(0, 1 << min(bits, 62), 3000, dtype=np.uint64)
    assert (order.back(order.forth(some)) == some).all()
    assert bits > 7 or sorted(order.forth(np.arange(1 << bits, dtype=np.uint64))) == list(range(1 << bits))
    shards, want = [], Counter()
    for shard in range(3):
        keys = rng.choice(some[: 500 + 400 * shard], 2000)
        keys, counts = np.unique(order.forth(keys), return_counts=True)
        counts = counts.astype(np.int64) * (1 if shard else 300)  # counts beyond a byte
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        shards.append(dict(counting_filter.blocks(keys, counts, bits, block_bits)))
    got = Counter()
    for number in set().union(*shards):
        parts = [counting_filter.decode(s[number], bits - block_bits, number) for s in shards if number in s]
        keys, counts = counting_filter.merge(*map(np.concatenate, zip(*parts, strict=True)))
        assert (np.diff(keys.astype(object)) > 0).all()
        got.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    assert got == want
    size = sum(len(b) for s in shards for b in s.values())
    assert bits < 36 or block_bits > 6 or size < 8 * sum(len(s) and 1500 for s in shards)
    assert counting_filter.blocks(np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), bits, block_bits) == []


def test_the_three_are_registered():
    assert {"op11_token_alignment", "op12_document_fingerprints", "op13_collocations"} <= QUERIES.keys()
