"""Deduplication over several landings, and templates that look back in long conversations."""

import pytest

from paceline.llm import chat, stream_dedup
from tests.llm import brute

DOCS = "doc_id long, text string"


def decided(found):
    return {r.doc_id: (r.keep_id, r.group_size) for r in found}


def test_landings_in_one_store(spark, tmp_path):
    """After each landing the groups that got a row are those of brute force over all rows so far."""
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "state")
    landings = [
        [(1, "a b"), (2, "c"), (9, None)], [(3, "ab"), (4, "d")], [(5, "a  b"), (6, "d"), (7, "e"), (8, " ")], [], [(0, "a  b")],
    ]
    texts, places = {}, set()
    for number, rows in enumerate(landings):
        df = spark.createDataFrame(rows, DOCS).repartition(3)
        found = stream_dedup.dedup_more(df, store, checkpoint).collect()
        texts |= dict(rows)
        groups = brute.equal_texts(texts)
        normal = lambda k: (texts[k] or "").replace(" ", "")
        touched = {k for k in texts if normal(k) in {normal(n) for n, _ in rows}}
        assert decided(found) == {k: groups[k] for k in touched}
        assert {r.doc_id for r in found if r.landed_now} == {k for k, _ in rows}
        assert sorted(r.doc_id for r in found if r.kept) == sorted({groups[k][0] for k in touched})
    stored = spark.read.parquet(store)
    assert stored.select("locator").distinct().count() == stored.count() == len(texts)
    whole = stream_dedup.decisions(spark, store).collect()
    assert {r.id: (r.keep_id, r.group_size) for r in whole} == brute.equal_texts(texts)


def test_landings_with_a_weak_digest(spark, tmp_path):
    """Different texts of one digest stay apart over landings."""
    store, checkpoint, texts = str(tmp_path / "store"), str(tmp_path / "state"), {}
    for number in range(3):
        rows = [(10 * number + k, f"text {(number + k) % 4}" + " " * number) for k in range(6)]
        texts |= dict(rows)
        weak = lambda content: brute_digest(content)
        found = stream_dedup.dedup_more(spark.createDataFrame(rows, DOCS), store, checkpoint, digest=weak).collect()
        groups = brute.equal_texts(texts)
        assert all(groups[r.doc_id] == (r.keep_id, r.group_size) for r in found) and len(found) >= len(rows)


def brute_digest(content):
    from pyspark.sql import functions as F

    return F.substring(F.sha2(content, 256), 1, 1)


def numbering(turns):
    return "".join(f"{k}:{r}:{t};" for k, (r, t) in enumerate(turns))


def dropping(turns):
    """Thoughts before ``#`` are dropped from turns that lie two or more turns back."""
    return "".join(f"[{r}]{t.split('#')[-1] if k < len(turns) - 2 else t};" for k, (r, t) in enumerate(turns))


def echoing(turns):
    """A turn repeats the text of the turn two before it."""
    return "".join(f"[{r}]{turns[k - 2][1] if k > 1 else ''}|{t};" for k, (r, t) in enumerate(turns))


echoing.reach = 2


@pytest.mark.parametrize("template", [numbering, dropping, echoing, chat.chat_template])
@pytest.mark.parametrize("length, block", [(50, 7), (140, 128), (300, 7)])
def test_one_behaviour_at_every_length(spark, template, length, block):
    """Text, spans and rewrites are those of one rendering of the whole conversation, whatever the blocks."""
    turns = [("user" if k % 2 else "assistant", f"think{k}#said {k}") for k in range(length)]
    df = spark.createDataFrame([(1, k, *t) for k, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    whole = chat.locate(turns, template)
    blocks = sorted(chat.format_conversations(df, template=template, block=block).collect(), key=lambda r: r.block)
    assert "".join(r.formatted for r in blocks) == whole.formatted == template(turns)
    assert any(r.rewrites for r in blocks) == whole.rewrites == (template is dropping)
    assert sum(r.n_turns for r in blocks) == length and (len(blocks) > 1) == (template in (echoing, chat.chat_template) and block < length)
    spans, before = [], 0
    for r in blocks:
        moved = [{k: v + before if isinstance(v, int) and not isinstance(v, bool) else v for k, v in s.asDict().items()} for s in r.spans]
        spans, before = spans + moved, before + len(r.formatted)
    assert spans == whole.spans


def test_very_long_texts(spark):
    """A text of a megabyte of control strings is formatted whole and read back."""
    text = "<|im_end|>\n" * 100_000
    df = spark.createDataFrame([(1, 0, "assistant", text), (1, 1, "user", "")], "conv_id long, turn long, role string, text string")
    row = chat.read_back(chat.format_conversations(df)).first()
    assert (row.loss_chars, row.loss_sha256) == (len(text), brute.sha(text))
