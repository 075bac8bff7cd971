"""Every query of the subpackage on whole small tables, against brute force or SQL."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from paceline.llm import queries
from paceline.session import durable
from tests.llm import brute


@pytest.fixture(scope="module")
def folder():
    from tests.conftest import DATA

    if not DATA.exists():
        pytest.skip("no test tables")
    return str(DATA)


@pytest.fixture(scope="module")
def con(folder):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("select doc_id, text from documents").fetchall())


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.tokenizer_path())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, folder, con, name):
    df = queries.QUERIES[name](spark, folder)
    result = con.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, result.fetchall())) == sorted(repr(tuple(r[c] for c in names)) for r in df.collect())


def test_ngram_join(spark, folder, texts):
    expected = brute.groups(texts)
    found = queries.op1_ngram_join(spark, folder).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert len(found) == len(texts)


def test_bpe(spark, folder, texts, tokenizer):
    for r in queries.op2_bpe(spark, folder).collect():
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(text))


def test_chat(spark, folder, con):
    said = "<|im_end|><|im_start|>assistant ok"
    turns = {-1: [("user", said), ("assistant", said)]}
    for key, role, text in con.execute("select conv_id, role, coalesce(text, '') from conversations order by conv_id, turn").fetchall():
        turns.setdefault(key, []).append((role, text))
    found = queries.op3_chat(spark, folder).collect()
    assert len(found) == len(turns)
    for r in found:
        own = turns[r.conv_id]
        loss = "".join(t for role, t in own if role == "assistant")
        expected = len(own), brute.sha("".join(f"{role}\n{t}\n" for role, t in own)), len(loss), brute.sha(loss)
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected
        assert r.formatted_chars > sum(len(t) for _, t in own)


def test_secrets(spark, folder, texts):
    for r in queries.op5_secrets(spark, folder).collect():
        spans = brute.secrets(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == brute.counted(spans, ("assign", "access", "hex"))
        assert r.base_sha256 == brute.sha(brute.listed(spans))
        every = [s for s in r.spans.split(",") if s]
        assert {brute.listed([s]) for s in spans} <= set(every)
        assert [int(s.split(":")[1]) for s in every] == sorted(int(s.split(":")[1]) for s in every)


def test_personal_data(spark, folder, texts):
    for r in queries.op7_pii(spark, folder).collect():
        spans = brute.personal(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == brute.counted(spans, ("email", "ip", "card", "phone"))
        assert r.base_sha256 == brute.sha(brute.listed(spans))
        assert {brute.listed([s]) for s in spans} <= set(r.spans.split(",")) | {""}


def test_quality(spark, folder, con):
    """Held-out accuracy beats the larger class; folds and decisions are as the contract says."""
    labels = dict(con.execute("select doc_id, quality from labels").fetchall())
    found = queries.op8_quality(spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right >= max(Counter(labels[r.doc_id] for r in held).values())


def test_token_files(spark, folder, texts, tokenizer):
    start = 0
    found = {r.doc_id: r for r in queries.op9_token_files(spark, folder).collect()}
    for key in sorted(texts):
        ids = [*tokenizer.encode(texts[key] or "", add_special_tokens=False).ids, 2]
        r = found[key]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)


def test_shards(spark, folder, texts):
    found = queries.op10_feistel_shards(spark, folder).collect()
    for r in found:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
    counts = Counter(r.shard for r in found)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    assert {(r.shard, r.slot) for r in found} == {(s, k) for s, n in counts.items() for k in range(n)}


def test_pipeline(spark, folder, texts, con, tokenizer):
    """Each stage against brute force on its own input; the classifier's stage against its own scores."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, items = docs.columns, con.execute("select item_id, text from benchmark").fetchall()
    kept = texts
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = durable(stage(spark, docs, folder))
        rows = docs.collect()
        now = {r.doc_id for r in rows}
        if number == 0:
            scores = {r.doc_id: r.score for r in queries.op8_quality(spark, folder).collect()}
            assert now == {k for k in kept if scores[k] >= 0.3}
        elif number == 1:
            assert now == {keep for keep, _ in brute.equal_texts(kept).values()}
        elif number == 2:
            assert now == {group for _, group in brute.groups(kept, percent=80, size=5).values()}
        elif number == 3:
            assert now == {k for k, t in kept.items() if not brute.contamination(t, items)[1]}
        else:
            for r in rows:
                assert r.ids == tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert len(rows) == len(now), name
        assert number == 4 or docs.columns == columns
        kept = {k: t for k, t in kept.items() if k in now}
