"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from paceline.llm import (
    bpe, chat, decontaminate, ngram_join, pii, quality, queries, secret_scan, sharding, stream_dedup, token_files,
)
from tests.llm import brute

DOCS = "doc_id long, text string, lang string"
LONG = "word " * 30_000 + "x" * 60_000 + " 12" * 20_000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog", "en"),
    (1, "the quick brown fox jumps over the lazy dog", "en"),
    (2, "The  quick brown fox jumps over the lazy dog", None),
    (None, "the quick brown fox jumps over the lazy dog ", "en"),
    (3, None, "en"),
    (4, "", None),
    (5, " \t\n", "de"),
    (6, LONG, "en"),
    (None, None, None),
]
BENCHMARK = "item_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(7, "Quick, brown FOX"), (8, None), (None, "..."), (9, "quick brown fox")], BENCHMARK)


def labels_of(spark, rows=((1, 1), (2, 0), (None, 1), (3, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int")


def clashing(docs, *names):
    return docs.select("*", *[F.lit("mine").alias(n) for n in names])


def test_groups(spark, docs, nothing):
    found = sorted(ngram_join.similarity_groups(clashing(docs, "node", "number", "component")).collect(), key=str)
    assert len(found) == len(ROWS)
    by_key = {(r.doc_id, r.n_shingles, r.component_id) for r in found}
    assert {(1, 7, 1), (2, 7, 1), (None, 7, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (None, 0, None)} <= by_key
    assert ngram_join.similarity_groups(nothing).collect() == []
    kept = ngram_join.one_of_each(clashing(docs, "_number"))
    assert kept.columns == [*docs.columns, "_number"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 5, 6]


def test_short_texts_are_one_ngram(spark):
    rows = [(1, "a b"), (2, "A  B"), (3, "a"), (4, "a b c"), (5, "b a")]
    found = ngram_join.similarity_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 4), 5: (1, 5)}


def test_groups_at_the_threshold_and_in_chains(spark):
    """Sets of exactly 90 % similarity link, one n-gram less does not, and links chain."""
    base = [f"w{k}" for k in range(40)]  # 38 n-grams
    rows = {1: base, 2: base[:-2], 3: [*base, "y", "z"], 4: base[:-4], 5: ["q", *base[4:]], 6: base[6:]}
    texts = {k: " ".join(v) for k, v in rows.items()}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_groups(df).collect()}
    assert found == brute.groups(texts)


def test_large_groups_of_near_copies(spark):
    """Every two of many near copies share prefix n-grams; the groups are those of brute force."""
    base = [f"v{k}" for k in range(150)]
    texts = {}
    for k in range(120):
        words = list(base)
        for j in range(k % 6):
            words[(k * 7 + j * 31) % 150] = f"edit{k}x{j}"
        texts[k] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    expected = brute.groups(texts)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_groups(df).collect()}
    assert found == expected
    # the same where common n-grams are spread over all tasks
    spread = ngram_join.joined(df.withColumnRenamed("doc_id", "node"), hot=0)
    assert {r.node: (r.n_shingles, r.component) for r in spread.collect()} == expected


def test_bpe(spark, docs, nothing):
    path = queries.tokenizer_path()
    coded = bpe.decode(bpe.encode(clashing(docs, "IDS", "decoded"), path), path)
    assert sorted(coded.columns) == sorted([*docs.columns, "ids", "decoded"])
    found = coded.collect()
    assert len(found) == len(ROWS)
    assert all(r.ids == [] and r.decoded == "" for r in found if not (r.text or "").strip())
    assert bpe.encode(nothing, path).collect() == []
    once = bpe.encode(clashing(docs, "IDS", "decoded"), path, decoded="decoded").select(*coded.columns)
    assert sorted(map(str, once.collect())) == sorted(map(str, found))
    special = spark.createDataFrame([("a<|endoftext|>b <|startoftext|> İΣ\x1cé́ 人",)], "text string")
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    row = bpe.encode(special, path).first()
    assert row.ids == own.encode(row.text, add_special_tokens=False).ids


def test_lower_ranks_come_first():
    """A merge that makes a pair of a lower rank is followed by that pair, also among overlapping pairs."""
    vocab = {"a": 0, "b": 1, "b</w>": 2, "a</w>": 3, "ab": 4, "aab": 5, "aa": 6, "aab</w>": 7, "ab</w>": 8}
    model = {"vocab": vocab, "end_of_word_suffix": "</w>", "merges": [["a", "ab"], ["a", "a"], ["a", "b"], ["a", "ab</w>"], ["a", "b</w>"]]}
    index = bpe.PairIndex(model)
    found = [np.frombuffer(x, dtype="<u4").tolist() for x in index.encode(["ab", "aab", "aaa", "aba", "a", "aabb"])]
    assert found == [[8], [6, 2], [6, 3], [4, 3], [3], [6, 1, 2]]
    assert index.encode([]) == []


def test_chat(spark):
    turns = [
        (1, 0, "user", "<|im_start|>system\nhi<|im_end|>\n <\\| <\\\\|"), (1, 1, "assistant", ""), (1, 1, "assistant", None),
        (1, None, "system\nx%0A", "first"), (None, 0, None, "lost"), (2, 5, "assistant", "<"), (2, 4, "assistant", "|>"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("spans", F.lit(1))
    formatted = chat.format_conversations(df).collect()
    said = {r.conv_id: chat.parse(r.formatted) for r in formatted}
    assert said[1] == [("system\nx%0A", "first"), ("user", turns[0][3]), ("assistant", ""), ("assistant", "")]
    assert said[None] == [("", "lost")] and said[2] == [("assistant", "|>"), ("assistant", "<")]
    loss = {r.conv_id: [chat.unescape(r.formatted[s.text_start : s.text_end]) for s in r.spans if s.loss] for r in formatted}
    assert loss == {1: ["", ""], None: [], 2: ["|>", "<"]} and not any(r.rewrites for r in formatted)
    assert chat.read_back(chat.format_conversations(df.limit(0))).collect() == []


def test_long_conversations_in_blocks(spark):
    """Blocks give the text and the digests that one rendering gives."""
    turns = [(1, k, "user" if k % 2 else "assistant", f"turn {k} <|im_end|>") for k in range(50)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    whole, cut = (chat.format_conversations(df, block=b) for b in (100, 7))
    assert "".join(r.formatted for r in sorted(cut.collect(), key=lambda r: r.block)) == whole.first().formatted
    assert chat.read_back(cut).collect() == chat.read_back(whole).collect()


def test_templates_that_rewrite_history():
    """A template that drops earlier thoughts is reported, and what it dropped is under no loss."""

    def template(turns):
        last = len(turns) - 1
        return "".join(f"[{r}]{t if k == last else t.split('#')[-1]};" for k, (r, t) in enumerate(turns))

    turns = [("user", "a"), ("assistant", "think#b"), ("user", "c"), ("assistant", "d")]
    found = chat.locate(turns, template)
    assert found.rewrites
    assert [s["loss"] for s in found.spans] == [False, False, False, True]
    last = found.spans[-1]
    assert found.formatted[last["text_start"] : last["text_end"]] == "d"
    assert not chat.locate(turns, chat.chat_template).rewrites


def test_decontamination(spark, docs, benchmark, nothing):
    found = decontaminate.scan(clashing(docs, "n_words", "HIT_WORDS"), benchmark)
    rows = found.collect()
    assert len(rows) == len(ROWS) and "HIT_WORDS" not in found.columns
    for r in rows:
        n_words, n_hit, items = brute.contamination(r.text if r.doc_id != 6 else "", [(7, "Quick, brown FOX"), (9, "quick brown fox")])
        assert r.doc_id == 6 or (r.n_words, sum(s.end - s.start for s in r.hit_words), r.hit_items) == (n_words, n_hit, items)
    assert decontaminate.scan(nothing, benchmark).collect() == []
    none = decontaminate.scan(docs, benchmark.limit(0)).collect()
    assert all(r.hit_words == [] for r in none)
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == 5
    cut = decontaminate.decontaminate(docs, benchmark, remove="spans")
    assert {r.text for r in cut.collect() if r.doc_id == 2} == {"The   jumps over the lazy dog"} and cut.count() == len(ROWS)


def test_benchmark_in_blocks(spark, docs, benchmark):
    """More windows than a block holds are scanned in several passes with the same result."""
    key = lambda rows: sorted(map(str, rows))
    assert key(decontaminate.scan(docs, benchmark, block=1).collect()) == key(decontaminate.scan(docs, benchmark).collect())


def test_secrets(spark, docs, nothing):
    found = secret_scan.scan(clashing(docs, "base", "tokens"), keep=("doc_id", "lang", "base")).collect()
    assert len(found) == len(ROWS) and all(r.base == [] for r in found)
    assert secret_scan.summary(secret_scan.scan(nothing)).collect() == []
    tricky = ["token=token: secret='0123456789abcdef'", "é password = \"abcdefghijkl\" AKIAAKIA0123456789", None, "api-key:aaaaaaaaaaaa API_KEY:aaaaaaaaaaaa"]
    df = spark.createDataFrame(list(enumerate(tricky)), "doc_id long, text string")
    for r in secret_scan.summary(secret_scan.scan(df)).collect():
        assert r.base_sha256 == brute.sha(brute.listed(brute.secrets(tricky[r.doc_id])))
    masked = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert masked[2] is None and masked[3] == "api-key:aaaaaaaaaaaa [secret]"


def test_random_tokens_stand_out(spark):
    """Random tokens are found among words of the same length, and words are not."""
    import random

    pick = random.Random(3)
    words = ["".join(pick.choice(["an", "er", "tion", "the", "ing"]) for _ in range(12)) for _ in range(800)]
    keys = ["".join(pick.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(44)) for _ in range(40)]
    rows = [(k, f"so {w} it") for k, w in enumerate(words)] + [(1000 + k, f"so {w} it") for k, w in enumerate(keys)]
    found = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hits = {r.doc_id for r in found if r.found}
    assert all(k >= 1000 for k in hits) and len(hits) >= 25
    assert all((s.start, s.end) == (3, 47) for r in found for s in r.found)


def test_random_tokens_glued_to_names_and_paths(spark):
    """A run that no encoding holds is cut into parts that one does, with the places of the parts."""
    import random

    pick = random.Random(5)
    words = ["".join(pick.choice(["an", "er", "tion", "the", "ing"]) for _ in range(12)) for _ in range(800)]
    glued = ["AUTH={}", "session_id={}", "/v1/my-hook/T0a_{}", "a+b_c/{}==", "x=/{}=y-z+q"]
    rows, keys = [(k, f"so {w} it") for k, w in enumerate(words)], {}
    for k in range(100):
        key = "".join(pick.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(44))
        text = "so " + glued[k % len(glued)].format(key) + " it"
        rows.append((1000 + k, text))
        keys[1000 + k] = text.index(key), text.index(key) + len(key)
    found = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    whole = [r.doc_id for r in found if any(s.start <= keys.get(r.doc_id, (-1, 0))[0] and s.end >= keys[r.doc_id][1] for s in r.found)]
    assert all(sum(d % len(glued) == k for d in whole) >= 12 for k in range(len(glued)))
    assert not any(r.found for r in found if r.doc_id < 1000)


def test_random_tokens_of_few_symbols_and_hot_words(spark):
    """Digits and letters in one case are found too; one word in a third of the rows changes nothing, and short words are none."""
    import random

    pick = random.Random(7)
    syllables = ["an", "er", "tion", "the", "ing", "schl", "heit", "mou", "qu", "pf"]
    words = ["".join(pick.choice(syllables) for _ in range(n)) for n in (6, 12) for _ in range(400)]
    draw = lambda letters: "".join(pick.choice(letters) for _ in range(60))
    keys = [draw(x) for x in (secret_scan.DIGITS, secret_scan.LOWER, secret_scan.UPPER, secret_scan.UPPER + "234567") for _ in range(60)]
    hot = "thequickbrownfoxjumpsoverthelazydogandsofortharkviewzoompackets"  # as even as a random token
    rows = [(k, f"so {w} it") for k, w in enumerate(words)] + [(10_000 + k, f"so {w} it") for k, w in enumerate(keys)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    much = spark.range(500).select((F.col("id") + 20_000).alias("doc_id"), F.lit(f"so {hot} it").alias("text"))
    for table in (df, df.unionByName(much)):
        hits = {r.doc_id for r in secret_scan.scan(table).collect() if r.found and r.doc_id < 20_000}
        found = [sum(10_000 + 60 * k <= d < 10_060 + 60 * k for d in hits) for k in range(4)]
        assert min(found) >= 40 and sum(d < 10_000 for d in hits) <= 20, (found, sum(d < 10_000 for d in hits))


def test_dedup(spark, docs, nothing):
    found = stream_dedup.exact_dedup(clashing(docs, "KEPT", "digest")).collect()
    assert len(found) == len(ROWS)
    fox = [r for r in found if (r.text or "").lower().startswith("the")]
    # The most code points first: the row without a key has as many as row 2, but a null key comes last.
    assert [(r.doc_id, r.kept, r.group_size) for r in found if r.keep_id == 2] == [(2, True, 1)]
    same = [r for r in fox if r.group_size == 3]
    assert len(same) == 3 and sum(r.kept for r in same) == 1 and {r.keep_id for r in same} == {None}
    empty = [r for r in found if not (r.text or "").strip()]
    assert {(r.keep_id, r.group_size) for r in empty} == {(5, 4)}
    assert stream_dedup.exact_dedup(nothing).collect() == []
    kept = stream_dedup.kept_rows(docs)
    assert kept.columns == docs.columns and kept.count() == 4


def test_dedup_checks_whole_texts(spark):
    """A digest that many texts share still gives the groups of equal texts; batches do not matter."""
    texts = {k: f"text {k % 7}" + " " * (k % 3) for k in range(40)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    weak = lambda content: F.substring(F.sha2(content, 256), 1, 1)
    for digest, files in ((weak, 100), (stream_dedup.sha256, 1)):
        found = stream_dedup.exact_dedup(df, digest=digest, batch_files=files).collect()
        assert {r.doc_id: (r.keep_id, r.group_size) for r in found} == brute.equal_texts(texts)


def test_state_goes_on_with_later_files(spark, tmp_path):
    """What came in an earlier run is known to the next one."""
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "state")
    for rows in ([(1, "a b"), (2, "c")], [(3, "ab"), (4, "c  ")]):
        stream_dedup.land(spark.createDataFrame(rows, "doc_id long, text string"), store)
        stream_dedup.update_state(spark, store, checkpoint)
    assert {(r.keep_id, r.copies) for r in stream_dedup.read_state(spark, checkpoint).collect()} == {(1, 2), (4, 2)}


def test_personal_data(spark, docs, nothing):
    found = pii.scan(clashing(docs, "base", "runs", "row"), keep=("doc_id", "row")).collect()
    assert len(found) == len(ROWS)
    assert pii.summary(pii.scan(nothing)).collect() == []
    tricky = [
        "a@b.c_d@e.f a@b@c.d x@y", "1.2.3.4.5.6.7.8 300.1.2.3.4 000255.1.1.1", None, "4111 1111 1111 1111 1 +1 (988) 555-2485.",
        "é+12345678 4111111111111111-4111111111111111", "+1234567 +123456789012345 +1234567890123456",
    ]
    df = spark.createDataFrame(list(enumerate(tricky)), "doc_id long, text string")
    for r in pii.summary(pii.scan(df)).collect():
        assert r.base_sha256 == brute.sha(brute.listed(brute.personal(tricky[r.doc_id]))), tricky[r.doc_id]


def test_contexts_find_unseen_identifiers(spark):
    """What stands where known identifiers stand is found; what stands beside common words is not."""
    rows = [(k, f"write to mail: user{k}@mail{k}.com soon or buy {k}{k}00 of the {k}99pieces") for k in range(40)]
    rows += [(100, "write to mail: user7(at)mail7 soon"), (101, "the 12345pieces"), (102, "mail of 55555")]
    found = pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hits = {(r.doc_id, s.start, s.end) for r in found for s in r.found}
    assert hits == {(100, 15, 29)}
    some = spark.createDataFrame([(1, "a@b.cd", "x"), (2, "none", None), (3, None, "y")], "doc_id long, text string, lang string")
    assert [r.doc_id for r in pii.documents_with(some).collect()] == [1]


def test_neighbours_of_known_identifiers_stay_open(spark):
    """Tokens beside a fixed span, parts glued to one and long ones are found; a run is cut into its tokens."""
    rows = [(k, f"issued badge: user{k}@mail{k}.com soon") for k in range(40)]
    long = "Q7" * 40
    odd = {
        100: ("issued badge: EMP-20931 jo@x.org now", {(14, 23)}), 101: ("issued badge: EMP-20932 2024-01-02 now", {(14, 23)}),
        102: (f"issued badge: {long} soon", {(14, 94)}), 103: ("issued badge: EMP-20933|jo@x.org now", {(14, 23)}),
        104: ("of jo@x.org EMP-20934 soon", {(12, 21)}), 105: ("of EMP-20935 here", set()), 106: ("issued badge: 12 34 567 now", {(14, 23)}),
    }
    rows += [(k, text) for k, (text, _) in odd.items()]
    found = {r.doc_id: {(s.start, s.end) for s in r.found} for r in pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: found[k] for k in odd} == {k: spans for k, (_, spans) in odd.items()}
    assert not any(found[k] for k in range(40))


def test_contexts_pass_on_until_they_settle(spark):
    """A chain of contexts, each known by the identifiers that the one before it found, is followed to its end."""
    rows = [(k, f"mail: u{k}@x{k}.org done") for k in range(40)] + [(1000 + k, f"mail: ID-1{k:02d} done") for k in range(4)]
    for step, name in enumerate("abcdef", 1):
        rows += [(1000 + 100 * step + k, f"step{name}: ID-{step}{k % 4:02d} end{name}") for k in range(40)]
        rows += [(2000 + 10 * step + k, f"step{name}: ID-{step + 1}{k:02d} end{name}") for k in range(4)]
    found = {r.doc_id for r in pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.found}
    assert found >= {k for k, text in rows if k >= 1000}


def test_very_long_runs_are_no_burden(spark):
    text = "1" * 150_000 + " " + "a" * 150_000 + " " + "1 " * 50_000 + "a.1@" * 20_000 + "+1" * 30_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.scan(df).count() == 1 and secret_scan.scan(df).count() == 1


def test_quality(spark, docs, nothing):
    labels = labels_of(spark)
    model = quality.fit(docs, labels)
    found = quality.score(clashing(docs, "SCORE"), model)
    assert "SCORE" not in found.columns and found.count() == len(ROWS)
    assert len({r.score for r in found.collect() if not (r.text or "").strip()}) == 1
    assert quality.score(nothing, model).collect() == []
    unlearned = quality.fit(docs, labels_of(spark, [(None, None)]))
    assert all(r.score == 0.5 for r in quality.score(docs, unlearned).collect())
    assert quality.good(clashing(docs, "_score"), labels).columns == docs.columns


def test_held_out_rows_are_not_learned_from(spark):
    keys = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit(1).alias("quality"))
    taken = quality.sample(keys, keys.select("doc_id", "quality"), rows=100).select("key").collect()
    held = {r.doc_id for r in keys.where(quality.held_out()).collect()}
    assert len(taken) == 100 and not held & {r.key for r in taken}


def test_token_files(spark, docs, nothing, tmp_path):
    folder, path = str(tmp_path / "ids"), queries.tokenizer_path()
    manifest = token_files.write_token_files(clashing(docs, "read"), folder, path)
    found = token_files.starts(manifest, token_files.read_token_files(manifest, folder, with_ids=True)).collect()
    assert len(found) == len(ROWS) and sum(r.n_tokens for r in found) == sum(r.tokens for r in manifest.collect())
    in_order = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == [None, None, 1, 1, 2, 3, 4, 5, 6]
    assert [r.start for r in in_order] == [sum(x.n_tokens for x in in_order[:k]) for k in range(len(in_order))]
    some = token_files.read_token_files(manifest, folder, spark.createDataFrame([(6,), (3,)], "doc_id long")).collect()
    assert {r.doc_id for r in some} == {3, 6}
    empty = token_files.write_token_files(nothing, str(tmp_path / "none"), path)
    assert token_files.read_token_files(empty, str(tmp_path / "none")).collect() == []


def test_frames_are_checked_and_read_alone(tmp_path):
    """A reader touches only the frames it needs, and sees damage; any zstandard tool reads the ids."""
    import pyarrow as pa
    import zstandard

    file = tmp_path / "x.zst"
    ids = [np.arange(n, dtype="<u4").tobytes() for n in (5, 0, token_files.FRAME_IDS + 3, 2)]
    with open(file, "wb") as out:
        writer = token_files.Writer(out)
        for key, found in enumerate(ids):
            writer.add(key, found)
        writer.close()
    with pa.OSFile(str(file)) as source:
        reader = token_files.Reader(source)
        assert [reader.ids(k) for k in range(4)] == ids and len(reader.frames) == 4
    data = bytearray(file.read_bytes())
    assert zstandard.ZstdDecompressor().stream_reader(bytes(data), read_across_frames=True).read() == b"".join(ids)
    data[int(reader.starts[0]) + 12] ^= 1
    file.write_bytes(data)
    with pa.OSFile(str(file)) as source:
        reader = token_files.Reader(source)
        assert reader.ids(3) == ids[3]
        with pytest.raises((ValueError, zstandard.ZstdError)):
            reader.ids(0)


def test_shards(spark, docs, nothing):
    found = sharding.shuffled_shards(clashing(docs, "SHARD", "place", "_read"), ["doc_id"], 4, seed=1)
    rows = found.collect()
    assert "SHARD" not in found.columns and sorted(r.row_number for r in rows) == list(range(len(ROWS)))
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.row_number)] == [None, None, 1, 1, 2, 3, 4, 5, 6]
    assert sorted((r.shard, r.slot) for r in rows) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1), (3, 0), (3, 1)]
    assert sharding.shuffled_shards(nothing, ["doc_id"], 4).collect() == []


@pytest.mark.parametrize("rows,width,height", [(1, 1, 1), (7, 3, 4), (1000, 0, 0), (101, 11, 13), (64, 8, 8)])
def test_permutations(spark, rows, width, height):
    """Every value of the domain once, also where many values have to walk on; seeds differ."""
    chosen = sharding.Permutation.of(rows, seed=3)
    if width:
        chosen = sharding.Permutation(rows, 3, 6, width, height)
    numbers = spark.range(rows)
    places = [r.p for r in numbers.select(chosen.place(F.col("id")).alias("p")).collect()]
    assert sorted(places) == list(range(rows))
    if rows > 100:
        other = sharding.Permutation(rows, 4, 6, chosen.width, chosen.height)
        assert places != [r.p for r in numbers.select(other.place(F.col("id")).alias("p")).collect()]


def test_written_shards(spark, tmp_path):
    rows = sharding.shuffled_shards(spark.range(100).withColumnRenamed("id", "doc_id"), ["doc_id"], 3)
    sharding.write_shards(rows, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert {Row(r.doc_id, r.shard, r.slot) for r in back.collect()} == {Row(r.doc_id, r.shard, r.slot) for r in rows.collect()}
