"""Callers' columns under the names that operators use, and benchmarks with odd windows."""

import pytest
from pyspark.sql import functions as F

from paceline.llm import decontaminate, importance, ngram_join, pii, quality, secret_scan, stream_dedup
from tests.llm import brute

NAMES = ["base", "found", "tokens", "candidates", "runs", "n_words", "hit_words", "row", "score", "component", "locator", "Words", "key"]
ROWS = [
    (1, "mail jo@example.org and token = abcdefABCDEF1234", "en"), (2, "the quick brown fox jumps over the lazy dog", "en"),
    (3, "nothing to see here at all", None), (4, None, "de"), (5, "", "en"), (None, "the quick  brown fox jumps over the lazy dog", "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return df.select(*[F.concat(F.lit(f"my {n} "), F.col("doc_id").cast("string")).alias(n) for n in NAMES], "*")


def checks(spark, df):
    benchmark = spark.createDataFrame([(7, "quick brown fox")], "item_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 6)], "doc_id long, quality int")
    return {
        "redact": secret_scan.redact(df), "documents_with": pii.documents_with(df), "good": quality.good(df, labels, threshold=0.0),
        "decontaminate": decontaminate.decontaminate(df, benchmark), "cut": decontaminate.decontaminate(df, benchmark, remove="spans"),
        "one_of_each": ngram_join.one_of_each(df), "kept_rows": stream_dedup.kept_rows(df),
        "resample": importance.resample(df, benchmark, least_words=1, percent=100),
    }


def test_columns_stay(spark, docs):
    """Operators that filter or mend documents give back every column as it came, whatever its name."""
    for name, out in checks(spark, docs).items():
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows, name
        for r in rows:
            key = r["doc_id"]
            assert all(r[n] == (None if key is None else f"my {n} {key}") for n in NAMES), name
        assert name == "good" or len(rows) == {"documents_with": 1, "decontaminate": 4, "one_of_each": 5, "kept_rows": 4, "resample": 4}.get(name, 6), name
def test_columns_of_a_scan(spark, docs):
    kept = secret_scan.scan(docs, keep=("doc_id", "tokens", "candidates")).collect()
    assert {r.tokens for r in kept} == {r.tokens for r in docs.collect()} and {r.candidates for r in kept} == {r.candidates for r in docs.collect()}
    only = spark.createDataFrame([("token = abcdefABCDEF1234",)], "words string")
    assert secret_scan.redact(only, text="words").first().words == "[secret]"


@pytest.mark.parametrize("size", [3, 70])
@pytest.mark.parametrize("block, room", [(200_000, None), (3, None), (200_000, 400)])
def test_odd_benchmarks(spark, monkeypatch, size, block, room):
    """Windows of over 64 words, one of very long words, and one that many items share, in blocks of any size."""
    if room:
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", room)
    words = [f"w{k}" for k in range(90)]
    long = "x" * 3_000
    items = [(k, "a b c d") for k in range(30)] + [(100, " ".join(words)), (101, f"{long} y z"), (102, "q"), (103, None)]
    texts = {1: "so a b c d and", 2: " ".join(["z", *words[5:85], "z"]), 3: f"go {long} y z go", 4: "q Q", 5: None, 6: " ".join(words[:60])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for r in decontaminate.scan(docs, benchmark, size=size, block=block).collect():
        found = r.n_words, sum(s.end - s.start for s in r.hit_words), r.hit_items
        assert found == brute.contamination(texts[r.doc_id], items, size)


def test_blocks_are_packed(spark, monkeypatch):
    """A long window fills a block of its own; the others stay together."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 10_000)
    words = [(f"{k:04d} " + ("x" * 50_000 if k == 50 else "y"), ["i"]) for k in range(100)]
    rows = decontaminate.in_blocks(spark.createDataFrame(words, "words string, items array<string>"), 1_000).collect()
    assert len(rows) == 100 and len({r.block for r in rows}) <= 3
