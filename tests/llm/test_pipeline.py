"""The pipeline against a brute-force version of each stage, on the rows that the stage before it kept."""

import hashlib
import os

import public_tokenizers
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import SF
from tidewright.sources import scratch


def test_registered(spark):
    names = entry.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "simhash_near_dedup",
        "benchmark_decontamination",
        "secret_scan",
        "sentencepiece",
    ]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


def test_pipeline_equals_brute_force(spark, documents):
    rows = sorted((r["doc_id"], r["text"], r["source"]) for r in documents.collect())
    rows = [r for r, (_, _, kept) in zip(rows, brute.rules([(t, s) for _, t, s in rows]), strict=True) if kept]
    classes = brute.near_classes([brute.fingerprint(t) for _, t, _ in rows])
    rows = [r for i, r in enumerate(rows) if classes[i] == i]
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r["item_id"], brute.leak_words(r["text"])) for r in benchmark.collect()]
    rows = [r for r in rows if not brute.leaks(r[1], items)]
    processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = set()
    for i, text, _ in rows:
        ids = processor.encode(brute.redacted(text))
        decoded = hashlib.sha256(processor.decode(ids).encode()).hexdigest()
        want.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), decoded))
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF).collect()]
    assert len(got) == len(want) and set(got) == want
    assert 0 < len(want) < documents.count()


def test_only_the_result_stays_in_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_folder", lambda _: str(tmp_path))
    corpus_pipeline.run(spark, SF)
    assert [name.split("-")[1] for name in os.listdir(tmp_path / "tidewright")] == ["sentencepiece"]


def test_stages_keep_the_columns_and_handle_awkward_rows(spark, messy):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, messy, SF)
        assert out.schema.names == messy.schema.names and out.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, messy, SF).count() == messy.count()


def test_stages_of_empty_tables(spark, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0
