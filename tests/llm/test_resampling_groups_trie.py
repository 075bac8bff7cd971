"""Importance resampling, SimHash groups and the prefix trie against brute force, and their edges."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.llm import batches, importance, prefix_trie, queries, simhash
from tests.llm import brute
from tests.llm.test_edges import DOCS, LONG, ROWS, clashing

TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


def texts_of(count, seed, vocabulary=60):
    pick = random.Random(seed)
    return {k: " ".join(f"w{int(vocabulary * pick.random() ** 2)}" for _ in range(pick.randrange(80))) for k in range(count)}


@pytest.mark.parametrize("longest", [1, 3])
def test_importance(spark, longest):
    rows, target = texts_of(300, 1), list(texts_of(20, 2, 30).values())
    expected = brute.importance(rows, target, longest, buckets=50, least=5, percent=30)
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    settings = {"longest": longest, "buckets": 50, "least_words": 5, "percent": 30}
    found = {r.doc_id: (r.n_features, r.weight, r.score, r.rank) for r in importance.ranked(df, wanted, **settings).collect()}
    assert found == expected
    drawn = importance.resample(clashing(df, "score", "_number", "rank"), wanted, **settings)
    assert drawn.columns == ["doc_id", "text", "score", "_number", "rank"]
    assert {r.doc_id for r in drawn.collect()} == {k for k, v in expected.items() if v[3]}


def test_runs_over_blocks(monkeypatch):
    """A run that crosses blocks of a long text is counted once."""
    text = " ".join(texts_of(1, 3).values()) + " " + "x" * 90 + " Ä1 b,c" * 30
    monkeypatch.setattr(importance, "word_blocks", lambda t: batches.word_blocks(t, 11))
    found = [importance.runs(text.encode(), 4)]
    total = sum((c for _, c in found[0]), start=type(next(iter(importance.runs(b"a")))[1])())
    assert total == brute.Counter(brute.zlib.crc32(r.encode()) for r in brute.runs(text, 4))


def test_importance_edges(spark, docs):
    """Null and repeated keys, texts without words, a long text, an empty target and no rows."""
    none = spark.createDataFrame([], "text string")
    found = importance.ranked(clashing(docs, "key", "place", "n"), none, least_words=1, percent=100).collect()
    assert len(found) == len(ROWS) and all(r.weight == 0 for r in found if not r.n_words)
    assert sorted(r.rank for r in found if r.n_words) == [1, 2, 3, 4, 5] and all(r.rank is None for r in found if not r.n_words)
    assert {r.n_features for r in found} == {0, 9, 50_001}
    assert importance.ranked(docs.limit(0), none).collect() == []
    assert importance.resample(docs.limit(0), none).columns == docs.columns
    ties = spark.createDataFrame([(None, "a b")] * 3 + [(k, None) for k in range(3)], "doc_id long, text string")
    order = importance.ranked(ties, none, least_words=0, percent=100).orderBy("rank").collect()
    assert len(order) == 6 and [r.rank for r in order] == [1, 2, 3, 4, 5, 6]


def test_simhash_on_the_tables(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    prints = {k: brute.simhash(t) for k, t in texts.items()}
    expected = {k: (f"{prints[k]:016x}", low) for k, low in brute.near_groups(prints).items()}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op12_simhash(spark, data).collect()} == expected


def flipped(count, centres, flips, seed):
    """Fingerprints around centres, distinct."""
    pick = np.random.default_rng(seed)
    values = np.repeat(pick.integers(0, 2**63, size=centres, dtype=np.uint64), count // centres)
    for _ in range(flips):
        values = values ^ (np.uint64(1) << pick.integers(0, 64, size=len(values), dtype=np.uint64))
    return np.unique(values)


def distributed(spark, values, **settings):
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long").repartition(3)
    rows = simhash.close_links(df, **settings).collect()
    return [tuple(sorted((r.a, r.b))) for r in rows]


@pytest.mark.parametrize("centres, flips, bits", [(1, 4, 2), (40, 3, 2), (900, 2, 2), (1, 2, 0), (30, 3, 5)])
def test_all_pairs_over_shards(spark, monkeypatch, centres, flips, bits):
    """Pairs over many shards are those of brute force, each once; links hold the same groups together."""
    monkeypatch.setattr(simhash, "SMALL_SHARD", 100)
    monkeypatch.setattr(simhash, "LEAF", 7)
    values = flipped(900, centres, flips, seed=centres + flips)
    near = np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= bits, 1)
    expected = [tuple(sorted((int(values[a].view(np.int64)), int(values[b].view(np.int64))))) for a, b in zip(*np.nonzero(near))]
    found = distributed(spark, values, bits=bits, groups=False)
    assert sorted(found) == sorted(expected)
    links = distributed(spark, values, bits=bits)
    assert grouped(values, links) == grouped(values, expected) and len(links) <= 4 * len(values)


def grouped(values, links):
    home = {int(v): int(v) for v in values.view(np.int64)}

    def find(k):
        while home[k] != k:
            k = home[k]
        return k

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        home[high] = low
    return {k: find(k) for k in home}


def test_simhash_edges(spark, docs):
    found = simhash.similarity_groups(clashing(docs, "fingerprint", "key", "component")).collect()
    by_text = {(r.doc_id, r.fingerprint, r.component_id) for r in found}
    fox, long = f"{brute.simhash(ROWS[0][1]):016x}", f"{brute.simhash(LONG):016x}"
    assert len(found) == len(ROWS)
    assert by_text == {(1, fox, 1), (2, fox, 1), (None, fox, 1), (6, long, 6), *((k, "0" * 16, 3) for k in (None, 3, 4, 5))}
    assert simhash.similarity_groups(docs.limit(0)).collect() == []
    lost = spark.createDataFrame([(None, "a b"), (None, "a  b")], "doc_id long, text string")
    assert {r.component_id for r in simhash.similarity_groups(lost).collect()} == {None}
    pairs = simhash.near_pairs(spark.createDataFrame([(1, "a b c"), (2, "A b c"), (3, "d")], "doc_id long, text string"))
    assert pairs.collect() == []


def test_fingerprints_over_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "word_blocks", lambda t: batches.word_blocks(t, 9))
    for text in ("", "a", "a b", "A" * 30 + " b", " ".join(texts_of(1, 4).values()), "é\x0b\x1cx " * 40, "a b a b a b a b"):
        assert simhash.fingerprint(text.encode()) == brute.simhash(text)


def talks(count, seed, length=9):
    """Conversations that share beginnings, with copies and some of no turns."""
    pick = random.Random(seed)
    return {
        k: [(pick.choice(["user", "assistant"]), "yes " * pick.randrange(3)) for _ in range(pick.choice([0, 1, 2, length]))]
        for k in range(count)
    }


def trie_rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("band", [2, 3, 4096])
def test_trie(spark, monkeypatch, band):
    """Many shards and bands give what one look at all prefixes gives."""
    monkeypatch.setattr(prefix_trie, "SMALL_SHARD", 20)
    said = talks(150, seed=7)
    said |= {200 + k: [("user", "deep"), *[("assistant", "yes")] * 7] for k in range(4)} | {300: [("user", "deep")] * 11}
    turns = [(k, n, r, t) for k, own in said.items() for n, (r, t) in enumerate(own)]
    placed = prefix_trie.coded_turns(spark.createDataFrame(turns, TURNS).repartition(3))
    every = spark.createDataFrame([(k,) for k in said], "conv long")
    assert trie_rows(prefix_trie.trie_of(placed, every, band=band)) == brute.trie(said)


def test_trie_of_one_list_in_every_shard(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SMALL_SHARD", 1)
    said = {k: [("user", "a")] * k for k in range(1, 8)}
    turns = [(k, n, r, t) for k, own in said.items() for n, (r, t) in enumerate(own)]
    assert trie_rows(prefix_trie.prefix_trie(spark.createDataFrame(turns, TURNS))) == brute.trie(said)


def test_trie_edges(spark, small_groups):
    """Null turns come first, null role and text are empty, ties have one order, and a long conversation is cut in ranges."""
    turns = [(1, 1, "b", "y z"), (1, None, None, None), (2, 5, "", ""), (2, 6, "b", "y z"), (None, 0, "user", "lost"), (3, 0, "x", None), (3, 0, "b", "")]
    turns += [(4, 0, "b", ""), (4, 0, "x", None), (5, 0, "user", LONG)] + [(6, k, "user", f"turn {k}") for k in range(60)]
    df = clashing(spark.createDataFrame(turns, TURNS), "pos", "digest", "words", "id")
    tied = sorted([("x", ""), ("b", "")], key=lambda t: brute.hashlib.sha256(f"{len(t[0])}:{t[0]}{t[1]}".encode()).digest())
    said = {
        1: [("", ""), ("b", "y z")], 2: [("", ""), ("b", "y z")], 3: tied, 4: tied,
        5: [("user", LONG)], 6: [("user", f"turn {k}") for k in range(60)],
    }
    assert trie_rows(prefix_trie.prefix_trie(df)) == brute.trie(said)
    assert prefix_trie.prefix_trie(df.limit(0)).collect() == []


def test_rebuilt_conversations(spark):
    """A base that is absent or shorter gives what it has; a conversation may end up without turns."""
    turns = [(20, k, "user", f"b{k}") for k in range(2)] + [(c, k, "user", f"o{c} {k}") for c in (*range(21, 40), 41, 45) for k in range(c % 5)]
    df = spark.createDataFrame(turns, TURNS)
    own = {}
    for c, _, role, text in turns:
        own.setdefault(c, []).append((role, text))
    said = {}
    for c in own:
        h = brute.zlib.crc32(str(c).encode()) % 4
        said[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    found = prefix_trie.trie_of(*queries.rebuilt(prefix_trie.coded_turns(df)))
    assert trie_rows(found) == brute.trie(said) and any(not s for s in said.values())
