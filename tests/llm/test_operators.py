"""The corpus operators against SQL, brute force, the libraries they must agree with, and awkward rows."""

import glob
import hashlib
import os
import random
import re
import time
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.compare import assert_same
from tests.llm import brute
from tests.llm.conftest import SF, messy_rows
from tidewright.llm import (
    decontaminate,
    language_id,
    license_scan,
    lm_score,
    pieces,
    quality_model,
    quality_rules,
    secret_scan,
    simhash,
    token_files,
)
from tidewright.llm.base import Memo, scratch_path
from tidewright.llm.components import components
from tidewright.llm.oracle import ORACLE
from tidewright.llm.queries import QUERIES


def bag(frame):
    return Counter(map(tuple, frame.collect()))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert assert_same(QUERIES[name](spark, SF), SF, ORACLE[name]) > 0


@pytest.mark.parametrize("name", ["op1_secret_scan", "op9_quality_rules", "op10_license_scan"])
def test_native_queries_run_no_python(spark, name):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "MapIn" not in text and "ArrowEval" not in text


# Secret scan


def test_secrets_equal_brute_force(messy):
    want = Counter()
    for i, t, *_ in messy_rows():
        found, base = brute.spans(t or ""), brute.base_spans(t or "")
        counts = [sum(k == n for _, k, _ in base) for n in range(3)]
        want[(i, *counts, hashlib.sha256(brute.spelled(base).encode()).hexdigest(), brute.spelled(found))] += 1
    assert bag(secret_scan.secret_scan(messy)) == want
    assert any("entropy_base64" in row[5] for row in want) and any("entropy_hex" in row[5] for row in want)


def test_windows_of_random_strings(spark):
    random_ = random.Random(1)
    letters = secret_scan.CLASSES[1].letters
    rows = [(i, "".join(random_.choices(letters[: random_.randint(10, 67)], k=random_.randint(20, 60)))) for i in range(300)]
    got = {r[0]: r[5] for r in secret_scan.secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: brute.spelled(brute.spans(t)) for i, t in rows}
    assert 20 < sum("entropy" in s for s in got.values()) < 280


def test_allowed_strings_are_suppressed(spark):
    rows = [(1, "550E8400-E29B-41D4-A716-446655440000"), (2, "EXAMPLEkey9aZ3v9QmXw2Lr8TbYc5HnJf7P"), (3, "9aZ3v9QmXw2Lr8TbYc5HnJf7P")]
    got = {r[0]: r[5] for r in secret_scan.secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "" and got[2] == "" and got[3].startswith("entropy_base64")


def test_keys_of_all_alphabets(spark):
    """Without a digit, cut by separators, in a path beside an allowed word; and what is no key."""
    key = "9aZ3v9QmXw2Lr8TbYc5HnJf7PqWd1"
    rows = [
        ("path", f"see /sample-bucket/key={key} there"),
        ("letters", "qZvKwXjRtYbNmPlHgFdScAeUoIxWyVzTkB"),
        ("cut", "3ax6xnjp-9jd6fds4-gc373sgv-xteol0kq-57bzwm2y"),
        ("mixed", "a9f-Kq2_zR7/tW4+xB8=mN1-vC6_pL3"),
        ("lower", "qwzjxkvbpfymghdtcnsrloiaeuqzxjwkvp"),
    ]
    clean = [
        ("allowed", "/sample-bucket/example-9aZ3v9QmXw2Lr8TbYc5HnJf7P"),
        ("uuid", "id=550e8400-e29b-41d4-a716-446655440000"),
        ("number", "123456789012345678901234567890"),
        ("path", "src/main/java/org/apache/catalyst/expressions/codegen"),
        ("word", "Rindfleischetikettierungsueberwachungsaufgaben"),
    ]
    got = {r[0]: r[5] for r in secret_scan.secret_scan(spark.createDataFrame([(f"+{k}", t) for k, t in rows] + [(f"-{k}", t) for k, t in clean], "doc_id string, text string")).collect()}
    assert all(("entropy" in spans) == (k[0] == "+") for k, spans in got.items()), got


def test_many_matches_take_time_in_proportion(spark):
    """Places of thousands of matches in one text, around the bounds of blocks."""
    def run(n):
        text = "".join(f"{i:016x} " for i in range(n))
        frame = spark.createDataFrame([(1, text, len(text))], "doc_id long, text string, n_chars long")
        start = time.perf_counter()
        found, clean = secret_scan.secret_scan(frame).first(), secret_scan.redact(frame).first()
        took = time.perf_counter() - start
        assert found["n_hex"] == n and found["spans"] == ",".join(f"hex:{17 * i}:{17 * i + 16}" for i in range(n))
        assert clean["text"] == f"{secret_scan.MASK} " * n
        return took

    for n in (0, 1, 255, 256, 257, 513):
        run(n)
    run(4000)
    assert run(32_000) < 12 * run(8000)


def test_keys_of_one_case_are_found_and_masked(spark):
    keys = {
        "entropy_hex": "3F2A9C4B7E1D8065F3A2B9C8",
        "entropy_base64": "9aZ3v9QmXw2Lr8TbYc5HnJf7P",
        "entropy_lower": "3ax6xnjp29jd6fds4gc373sgvjxteol0",
        "entropy_upper": "JBSWY3DPEHPK3PXPKRSXG5BAMFZWI2LO",
    }
    rows = [(kind, f"see {key}, or so") for kind, key in keys.items()]
    rows.append(("path", "srv/data/part-0001/warehouse/tables/2024-01-01/region_eu/file-17"))
    rows.append(("word", "donaudampfschifffahrtsgesellschaftskapitaen"))
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r[0]: r[5] for r in secret_scan.secret_scan(frame).collect()}
    assert got.pop("path") == got.pop("word") == ""
    for kind, key in keys.items():
        assert f"{kind}:4:{4 + len(key)}" in got[kind].split(",")
    clean = dict(secret_scan.redact(frame).select("doc_id", "text").collect())
    assert all(clean[k] == f"see {secret_scan.MASK}, or so" for k in keys)
    # As a part of a longer run.
    run = spark.createDataFrame([(1, f"key-{keys['entropy_lower']}")], "doc_id long, text string")
    assert keys["entropy_lower"] not in secret_scan.redact(run).first()["text"]


def test_redaction_keeps_rows_and_columns(messy):
    out = secret_scan.redact(messy)
    assert out.columns == messy.columns
    want = Counter((i, None if t is None else brute.redacted(t)) for i, t, *_ in messy_rows())
    assert bag(out.select("doc_id", "text")) == want
    assert out.filter("n_chars <> length(text)").count() == 0


# Quality rules


def test_rules_equal_brute_force(messy):
    rows = [(t, "example.org" if s and "//" in s else s) for _, t, _, s in messy_rows()]
    want = Counter((r[0], *s, failed, kept) for r, (s, failed, kept) in zip(messy_rows(), brute.rules(rows), strict=True))
    got = quality_rules.quality_rules(messy)
    assert bag(got.drop("host", "host_failed")) == want


def test_a_bad_host_takes_its_documents_along(spark):
    good = "all of these words are quite different from one another you see"
    rows = [(i, good if i % 40 == 0 else "bad", "worse") for i in range(400)]
    rows += [(1000 + i, good if i % 20 else "bad", f"host{i % 7}") for i in range(700)] + [(5000, good, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {i: kept for (i, _, _), (_, _, kept) in zip(rows, brute.rules([(t, s) for _, t, s in rows]), strict=True)}
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(frame).collect()}
    assert got == want and not got[0] and got[1001] and got[5000]
    assert quality_rules.keep_good(frame).columns == frame.columns
    assert {r[0] for r in quality_rules.keep_good(frame).collect()} == {i for i, k in want.items() if k}


def test_chance_does_not_condemn_small_hosts(spark):
    """Thousands of hosts of two or three documents with one failure rate: what differs between them is chance."""
    good = "all of these words are quite different from one another you see"
    random_ = random.Random(2)
    rows = [(i, good if random_.random() > 0.3 else "bad", f"small{i // (2 + i % 2)}") for i in range(4000)]
    rows += [(10_000 + i, good if i % 10 == 0 else "bad", "worse") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["host"], r["base_failed"], r["kept"]) for r in quality_rules.quality_rules(frame).collect()}
    assert {host for host, failed, kept in got.values() if not kept and not failed} == {"worse"}
    want = [kept for _, _, kept in brute.rules([(t, s) for _, t, s in rows])]
    assert [got[i][2] for i, _, _ in rows] == want


# Near copies


def test_near_dedup_equals_brute_force(documents, messy):
    for frame in (documents, messy):
        rows = [(r["doc_id"], r["text"] or "") for r in frame.collect()]
        prints = [brute.fingerprint(t) for _, t in rows]
        classes = brute.near_classes(prints)
        least = {}
        for (i, _), c in zip(rows, classes, strict=True):
            if i is not None:
                least[c] = min(i, least.get(c, i))
        want = Counter((i, f"{p:016x}", least.get(c)) for (i, _), p, c in zip(rows, prints, classes, strict=True))
        assert bag(simhash.near_dedup(frame)) == want


def noisy(random_, n, base, flips):
    out = []
    for _ in range(n):
        value = base
        for bit in random_.sample(range(64), random_.randint(0, flips)):
            value ^= 1 << bit
        out.append(value)
    return out


@pytest.mark.parametrize("cell", [1 << 15, 40, 4])
def test_trie_join_equals_all_pairs(spark, cell):
    """Dense groups, groups at the edge of the budget, and lone fingerprints; also when groups must be cut."""
    random_ = random.Random(2)
    codes = noisy(random_, 250, 0x123456789ABCDEF0, 5) + noisy(random_, 60, (1 << 64) - 1, 9) + [random_.getrandbits(64) for _ in range(60)]
    codes = sorted(set(codes))
    signed = np.array(codes, dtype=np.uint64).view(np.int64)
    frame = spark.createDataFrame(pd.DataFrame({"fp": signed}))
    got = dict(map(tuple, components(simhash.links(frame, 3, cell)).collect()))
    groups = {}
    for k, c in enumerate(brute.near_classes(codes)):
        groups.setdefault(c, []).append(int(signed[k]))
    assert got == {x: min(g) for g in groups.values() for x in g if x != min(g)}


def test_components_of_chains_and_stars(spark):
    pairs = [(7 * a % 101, 7 * b % 101) for a, b in brute.chain(60)] + [(500, n) for n in range(501, 560)] + [(900, 900), (901, 902), (902, 901)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    found = brute.roots(1000, pairs)
    groups = {}
    for n in {x for p in pairs for x in p}:
        groups.setdefault(found[n], []).append(n)
    assert got == {n: min(g) for g in groups.values() for n in g if n != min(g)}


def test_one_document_of_a_class_stays(spark, messy):
    kept = simhash.keep_first(messy)
    assert kept.columns == messy.columns
    rows = [(r["doc_id"], r["text"] or "") for r in messy.collect()]
    least = {}
    for (i, _), c in zip(rows, brute.near_classes([brute.fingerprint(t) for _, t in rows]), strict=True):
        least[c] = min((i is None, i or 0), least.get(c, (True, 1 << 60)))
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == Counter(least.values())


# Benchmark


def edited(random_, words):
    words = list(words)
    for _ in range(random_.randint(0, 2)):
        at = random_.randrange(len(words))
        change = random_.randrange(3)
        if change == 0:
            words[at] = "changed"
        elif change == 1:
            words.insert(at, "added")
        elif len(words) > 1:
            del words[at]
    return words


def near_copies(rng, words, changes):
    """The words with so many of them replaced."""
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"new{rng.randint(0, 999)}".encode()
    return out


@pytest.mark.parametrize("size, items", [(60, 40), (150, 400)])
def test_blocks_find_what_is_similar_enough(size, items):
    """Recall of the fingerprints on windows of at least 0.8 similarity, and the candidates among unrelated items."""
    rng = random.Random(size)
    own = [[f"w{rng.randint(0, 3000)}".encode() for _ in range(size)] for _ in range(items)]
    index = decontaminate.Index([(i, b" ".join(words)) for i, words in enumerate(own)])
    found = similar = pairs = rows = 0
    for changes in range(1, size // 25 + 2):
        for i, words in enumerate(own):
            copy = near_copies(rng, words, changes)
            if decontaminate.similarity(decontaminate._occurrences(copy, 5), index.counts[i]) < 0.8:
                continue
            chain = decontaminate._chain(decontaminate._hashes(copy), 5)
            _, item, candidates = index.postings[size].within(decontaminate._prints(chain, np.array([0]), len(chain)))
            similar, found, pairs, rows = similar + 1, found + (i in item), pairs + candidates, rows + 1
    assert similar > items and found >= 0.98 * similar
    assert pairs / rows < 0.25 * items
    print(f"\n{size} words, {items} items: recall {found / similar:.4f}, {pairs / rows:.1f} candidates a window")


def test_typographic_marks_do_not_hide_a_leak(spark):
    rng = random.Random(3)
    words = [rng.choice(["zebra", "überaus", "naïve", "слово", "漢字", "plain", "Übung"]) + str(i) for i in range(60)]
    item = " ".join(words[:20]) + ' "' + " ".join(words[20:25]) + '" - ' + " ".join(words[25:])
    copy = " ".join(words[:20]) + " \u201c" + "\u00a0".join(words[20:25]) + "\u201d\u2014" + "\u2002".join(words[25:])
    rows = [(1, "before \u00ab" + copy.upper() + "\u00bb after"), (2, " ".join(reversed(words)))]
    frame, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    found = decontaminate.find_leaks(frame, table).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(1, 7)] and found[0]["similarity"] > 0.99
    assert [r["doc_id"] for r in decontaminate.drop_leaks(frame, table).collect()] == [2]


@pytest.mark.parametrize("block", [4_000_000, 4_000])
def test_leaks_equal_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    random_ = random.Random(5)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(60).collect()]
    items += [(900, "one two"), (901, ""), (902, "Alpha beta gamma delta epsilon zeta"), (903, None), (904, items[0][1])]
    rows = [tuple(r) for r in documents.select("doc_id", "text").limit(60).collect()]
    for i in range(80):
        item = random_.choice(items[:40])[1].split()
        around = random_.choice(rows[:60])[1].split()[:60]
        rows.append((10_000 + i, " ".join(around[:20] + edited(random_, item) + around[20:])))
    rows += [(5, "x one, TWO y"), (6, ""), (7, "alpha beta gamma delta epsilon"), (8, "q alpha beta; gamma delta epsilon zeta q"), (None, None), (8, "one two")]
    own = [(i, brute.leak_words(t or "")) for i, t in items]
    want = Counter((d, i, round(s, 9)) for d, t in rows for i, s in brute.leaks(t or "", own).items())
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, item string")
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(frame, table)
    assert Counter((r[0], r[1], round(r[2], 9)) for r in found.collect()) == want
    assert len(want) > 40
    kept = decontaminate.drop_leaks(frame, table)
    leaking = {t for _, t in rows if brute.leaks(t or "", own)}
    assert kept.columns == frame.columns
    assert Counter((r[0], r[1]) for r in kept.collect()) == Counter(r for r in rows if r[1] not in leaking)


# Licenses


def test_licenses_equal_brute_force(messy):
    want = Counter()
    for i, t, *_ in messy_rows():
        for name, (held, first) in brute.licenses(t or "").items():
            want[(i, name, round(held, 9), first)] += 1
    got = license_scan.license_scan(messy).collect()
    assert Counter((r[0], r[1], round(r[2], 9), r[3]) for r in got) == want
    assert len(want) >= 3


def test_templates_in_parts_and_own_templates(spark):
    template = " ".join(f"word{i}" for i in range(30))
    words = template.split()
    filler = [f"other{i}" for i in range(200)]
    rows = [
        (1, " ".join(filler + words + filler)),
        (2, " ".join(filler[:7] + words[:26] + filler)),
        (3, " ".join(filler[:7] + words[:24] + filler)),
        (4, " ".join(words[:12] + filler + words[12:])),
    ]
    found = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), templates={"own": template, "short": "a b"})
    assert {(r[0], r[1], round(r[2], 3)) for r in found.collect()} == {(1, "own", 1.0), (2, "own", round(22 / 26, 3))}


@pytest.mark.parametrize("more", [2, 5, 10, 20])
def test_edited_notices_are_found_at_every_place(spark, more):
    template = re.findall(r"\w+", license_scan.TEMPLATES["MIT-permission"].lower())
    n = len(template) - 4
    at = template.index("files") + 1
    notice = template[:at] + [f"added{i}" for i in range(more)] + template[at:]
    filler = [f"other{i}" for i in range(90)]
    rows = [(skip, " ".join(filler[: 30 + skip] + notice + filler[60:])) for skip in range(n)]
    found = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r[0], r[1], round(r[2], 9)) for r in found.collect()} == {(skip, "MIT-permission", round(19 / 23, 9)) for skip in range(n)}
    # A window without the last or first words of the notice holds less, so the place is that of one that has them all.
    for r in found.collect():
        assert r[3] <= 30 + r[0] and r[3] + 2 * n >= 30 + r[0] + len(notice) - 4
        assert r[4] >= (r[3] % n == 0)


# Token files


def test_token_files_equal_the_library(messy, documents):
    rows = [tuple(r) for r in documents.orderBy("doc_id").select("doc_id", "text").collect()]
    assert bag(token_files.token_files(documents)) == Counter(brute.token_rows(rows))
    got = token_files.token_files(messy).collect()
    want = brute.token_rows([(i, t) for i, t, *_ in messy_rows()])
    assert Counter((r[0], r[2], r[3]) for r in got) == Counter((w[0], w[2], w[3]) for w in want)
    # Documents lie one after the other, by id, null first.
    ordered = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in ordered] == list(np.cumsum([0, *(r[2] for r in ordered[:-1])]))
    ids = [r[0] for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_token_files_are_read_by_a_task_per_range(documents):
    folder = scratch_path(documents.sparkSession, "tokens")
    shards = token_files.write_tokens(documents, folder)
    assert shards.rdd.getNumPartitions() > 1 or shards.count() == 1
    ranges = shards.selectExpr("sum(cast(ceil(n_docs / 10) as long))").first()[0]
    read = token_files.read_tokens(shards, folder, most=3, at_once=10)
    assert read.rdd.getNumPartitions() == ranges > 10
    assert bag(read) == bag(token_files.read_tokens(shards, folder))


def test_token_files_are_all_that_is_written(documents, messy, nothing):
    """A table of the shards would have the executors start a process for each of its folders and files."""
    for frame in (documents, messy, nothing):
        folder = scratch_path(documents.sparkSession, "tokens")
        before = set(glob.glob(f"{os.path.dirname(folder)}/*"))
        shards = token_files.write_tokens(frame, folder).orderBy("shard").collect()
        assert set(glob.glob(f"{os.path.dirname(folder)}/*")) - before == ({folder} if shards else set())
        kinds = Counter(name.split(".", 1)[1] for name in os.listdir(folder)) if shards else {}
        assert kinds == ({k: len(shards) for k in ("bin", "len", "doc", "nul", "idx")} if shards else {})
        assert [s.base for s in shards] == [sum(s.n_tokens for s in shards[:k]) for k in range(len(shards))]
        assert sum(s.n_docs for s in shards) == frame.count()


def test_token_runs_are_those_of_the_library():
    encoder = token_files.Encoder(token_files.default_path())
    random_ = random.Random(2)
    parts = ["a", "b", "'s", "'ll", " ", "  ", "\n", "\t", "\r\n", "12", ".", "!?", "é", "漢", "<|endoftext|>", "\x1c", " ", " "]
    parts += ["'", "ﬁ", "the", "The ", "​", "́", "٣", "\x85", "\x0b", "🙂", "_", "|", "*** "]
    texts = ["".join(random_.choices(parts, k=random_.randint(0, 50))) for _ in range(3000)]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(g, encoder.dtype).tolist() for g in encoder.encode(texts)] == want


# Pieces


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_equal_the_library(processor, messy, documents):
    for frame in (documents, messy):
        want = Counter()
        for r in frame.collect():
            ids = processor.encode(r["text"] or "")
            decoded = hashlib.sha256(processor.decode(ids).encode()).hexdigest()
            want[(r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), decoded)] += 1
        assert bag(pieces.piece_digest(frame)) == want
        assert Counter((r[0], len(r[1])) for r in pieces.encode_column(frame).collect()) == Counter((w[0], w[1]) for w in want.elements())


def test_pieces_of_random_texts(processor):
    model = pieces.load(pieces.default_path())
    random_ = random.Random(1)
    letters = "abcdefgh  \n\t.,▁é漢字かなABC012☃️𝄞\x00 =+/_-ﬁ'\"{}"
    texts = ["a" * 3000, "ab" * 2000, " " * 1500, "=-" * 900] + ["".join(random_.choices(letters, k=random_.randint(1, 300))) for _ in range(1500)]
    got = model.encode(texts)
    want = [processor.encode(t) for t in texts]
    assert [i.tolist() for i, _ in got] == want
    assert [s for _, s in got] == [",".join(map(str, w)) for w in want]
    assert [model.decode(i) for i, _ in got] == [processor.decode(w) for w in want]


def test_long_runs_equal_the_library(processor):
    model = pieces.load(pieces.default_path())
    random_ = random.Random(5)
    texts = [" " * 40_000, "the" * 9000, "th" * 9000, "and" * 9000, "  x" * 5000, "thethand" * 2000, " " * 33 + "a" + " " * 47]
    texts += ["".join(random_.choices(letters, k=20_000)) for letters in ("ab", "then", "the an", "aA0+/", "▁ t")]
    for text in texts:
        assert model.encode([text])[0][0].tolist() == processor.encode(text)


def test_caches_are_bounded_by_bytes():
    model = pieces.PieceModel(pieces.default_path())
    for n in range(20):
        texts = ["".join(chr(0x4E00 + (n * 977 + i * 31 + k * k) % 20000) for k in range(3000)) for i in range(20)]
        model.encode(texts)
    # Long runs without a blank are passed through.
    assert len(model.known.young) <= 20 and model.known.held < 2 << 20
    memo = Memo(10_000)
    for n in range(2000):
        keys = {f"{n}-{i}" for i in range(5)} | {"often"}
        found = memo.holding(keys, lambda new: [key.encode() * 2 for key in new])
        assert {key: found[key] for key in keys} == {key: key.encode() * 2 for key in keys}
        assert memo.held < 13_000 and len(memo.young) < 60
    assert memo._cost(["a"], [("xy", 3, b"zzz")]) == 200 + 100 + 2 + 5 and memo._cost(["a"], [None]) < 300


def test_decoding_of_any_ids(processor):
    model = pieces.load(pieces.default_path())
    random_ = random.Random(3)
    for _ in range(2000):
        ids = [random_.randint(0, 31_999) if random_.random() < 0.5 else random_.randint(0, 262) for _ in range(random_.randint(0, 20))]
        assert model.decode(np.array(ids, dtype=np.int64)) == processor.decode(ids)


# Language model


@pytest.mark.parametrize("head", [200_000, 20])
def test_lm_scores_equal_brute_force(processor, documents, messy, monkeypatch, head):
    monkeypatch.setattr(lm_score, "HEAD", head)
    for frame in (documents.limit(80), messy):
        rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
        want = sorted(((i is None, i or 0), *w) for (i, _), w in zip(rows, brute.lm_rows(rows, processor), strict=True))
        got = sorted(((r[0] is None, r[0] or 0), *r[1:]) for r in lm_score.lm_score(frame.sparkSession.createDataFrame(rows, "doc_id long, text string")).collect())
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-10)


# Classifiers


def test_quality_of_held_out_documents(spark):
    """Trained at the scale where enough labels exist."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op4_quality_classifier"](spark, folder).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = rows[rows.quality == 1].score, rows[rows.quality == 0].score
    assert len(bad) > 5 and np.mean([(g > b) for g in good for b in bad]) > 0.9
    assert (rows.predicted == (rows.score >= 0.3)).all() and (rows.predicted == rows.quality).mean() > 0.9


def test_quality_without_labels_and_with_awkward_rows(spark, messy):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_model.quality_scores(messy, labels).collect()
    assert Counter(r[0] for r in got) == Counter(r[0] for r in messy_rows())
    assert {r[2] for r in got} == {0.5}
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, None), (3, 0), (None, 1)], "doc_id long, quality int")
    got = quality_model.quality_scores(messy, labels).collect()
    assert all(0 <= r[2] <= 1 for r in got) and len(got) == len(messy_rows())


def test_the_network_separates_and_is_calibrated():
    random_ = np.random.default_rng(0)
    x = random_.normal(size=(4000, 8))
    y = (random_.random(4000) < 1 / (1 + np.exp(-3 * x[:, 0] * x[:, 1]))).astype(float)
    network = quality_model.Network(x[:2000], y[:2000])
    network.calibrate(x[2000:3000], y[2000:3000])
    scores = network.scores(x[3000:])
    high = scores > 0.8
    assert abs(scores[high].mean() - y[3000:][high].mean()) < 0.08
    assert ((scores > 0.5) == y[3000:]).mean() > 0.7


def test_language_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op5_language_id"](spark, folder).join(docs, "doc_id").filter("held_out").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.98 and rows.score.between(0, 1).all()


def test_languages_equal_brute_force(documents, messy):
    for frame in (documents.limit(60), messy):
        rows = [(r["doc_id"], r["text"], r["lang"]) for r in frame.collect()]
        frame = frame.sparkSession.createDataFrame(rows, "doc_id long, text string, lang string")
        want = sorted((str(i), lang, score) for (i, _, _), (lang, score) in zip(rows, brute.languages(rows), strict=True))
        got = sorted((str(r[0]), r[2], r[3]) for r in language_id.language_id(frame).collect())
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=1e-3)


def test_more_languages_than_are_learned(spark, monkeypatch):
    """The ones with most documents are learned, in partial counts too."""
    monkeypatch.setattr(language_id, "MOST_LANGS", 5)
    rows = [(i, "the quick brown fox jumps", f"l{i % 40:02}") for i in range(400)] + [(1000 + i, "le chat noir", "fr") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, _, chances = language_id.learn(frame)
    assert langs == ["fr", "l00", "l01", "l02", "l03"] and chances.shape == (1 << 16, 5)
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.language_id(frame).collect()}
    assert found[1001] == "fr" and found[0] in langs and len(found) == 460
    assert sum(r["n"] for r in language_id.count_ngrams(frame).filter("bucket = -1").collect()) == 460


def test_quality_pools_equal_brute_force(documents, messy):
    for frame in (documents.limit(40), messy):
        rows = [(k, r["text"]) for k, r in enumerate(frame.collect())]
        frame = frame.sparkSession.createDataFrame(rows, "doc_id long, text string")
        got = {r["doc_id"]: r["features"] for r in quality_model.pool(frame, quality_model.word_vectors(frame)).collect()}
        for (i, _), want in zip(rows, brute.quality_features([t for _, t in rows]), strict=True):
            assert np.allclose(got[i], want, atol=2e-4), i


def test_language_of_awkward_rows(messy):
    got = language_id.language_id(messy).collect()
    by_text = Counter((r[0], r[2] == "und") for r in got)
    assert by_text == Counter((i, t is None or not any(c.isalpha() for c in t)) for i, t, *_ in messy_rows())
    learned = {lang for i, _, lang, _ in messy_rows() if lang and brute.remainder(i, 3) != 1}
    assert {r[2] for r in got} <= learned | {"und"}
    assert all(r[1] == (brute.remainder(r[0], 3) == 1) for r in got)


def test_ngrams_stay_inside_of_texts():
    texts = ["Ab 12", "", "x\0y", "né"]
    points, heads = language_id.characters(texts)
    found = Counter()
    for a in range(0, len(points), 4):  # pieces overlap rightly
        for order in language_id.ORDERS:
            at, _ = language_id.ngrams(points, a, min(a + 4, len(points)), order)
            for p in at.tolist():
                found[int(np.searchsorted(heads, p, side="right")) - 1, "".join(map(chr, points[p : p + order]))] += 1
    want = Counter()
    for i, t in enumerate([" ab ", " ", " x y ", " né "]):
        for order in language_id.ORDERS:
            want.update((i, t[k : k + order]) for k in range(len(t) - order + 1) if t[k : k + order] != " ")
    assert found == want


# Empty tables


def test_empty_tables(spark, nothing):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    frames = [
        secret_scan.secret_scan(nothing),
        secret_scan.redact(nothing),
        token_files.token_files(nothing),
        lm_score.lm_score(nothing),
        quality_model.quality_scores(nothing, labels),
        language_id.language_id(nothing),
        pieces.piece_digest(nothing),
        decontaminate.find_leaks(nothing, benchmark),
        simhash.near_dedup(nothing),
        simhash.keep_first(nothing),
        quality_rules.quality_rules(nothing),
        quality_rules.keep_good(nothing),
        license_scan.license_scan(nothing),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    assert decontaminate.find_leaks(documents, benchmark.limit(0)).count() == 0
    assert decontaminate.drop_leaks(documents, benchmark.limit(0)).count() == documents.count()
    assert language_id.language_id(documents.withColumn("lang", F.lit(None).cast("string"))).filter("lang_pred <> 'und'").count() == 0
