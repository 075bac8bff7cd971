"""Benchmark decontamination: a broadcast set of test n-grams, scanned for in every document.

Words are runs of a-z, 0-9 and characters beyond ASCII, after A-Z were lowered. A window is
``size`` consecutive words of an item; an item of fewer words is one window. Windows are
compared by a rolling hash and every hit is verified word by word.

The windows of a benchmark are taken in blocks of at most ``block`` windows, so what is
broadcast at a time has a fixed bound; a larger benchmark means more passes inside the same
task, not more memory and not a shuffle of the documents.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.batches import packed, slices, small_batches, unpacked, with_columns, without
from paceline.operators.history import RunningSum, with_history
from paceline.session import durable

SIZE = 10
#: Windows in a broadcast block, and their bytes at most; words may be long, so both bound it.
BLOCK_WINDOWS, BLOCK_BYTES = 200_000, 64 << 20
#: Every byte to itself, A-Z to a-z, and ASCII characters that are in no word to a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SPAN = "array<struct<start:int,end:int>>"
RESULT = {"n_words": "long", "hit_words": SPAN, "hit_items": "array<string>"}
FACTOR = 0x9E3779B97F4A7C15


def words_of(text: bytes):
    return text.translate(FOLD).split()


def windows_of(benchmark: DataFrame, item="item_id", text="text", size=SIZE) -> DataFrame:
    """(words, items): each distinct window and the items it comes from, as strings."""

    def split(batches):
        for batch in batches:
            names = batch.column(item).cast(pa.string()).to_pylist()
            for first, texts in slices(batch, text):
                found = set()
                for row, words in enumerate(map(words_of, texts), first):
                    for k in range(max(1, len(words) - size + 1) if words else 0):
                        found.add((b" ".join(words[k : k + size]).decode(), names[row] or ""))
                listed = sorted(found)
                columns = [pa.array([x[k] for x in listed], pa.string()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["words", "item"])

    rows = benchmark.select(F.col(f"`{item}`").alias(item), F.col(f"`{text}`").alias(text))
    pairs = rows.mapInArrow(split, "words string, item string")
    return pairs.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def in_blocks(windows: DataFrame, block: int, most_bytes=None) -> DataFrame:
    """The windows with the ``block`` they belong to: at most ``block`` windows each, and one window more than BLOCK_BYTES.

    A window costs its bytes and its share of a block; the costs of the windows before it say which block is
    full, so one long window fills a block of its own and changes no other.
    """
    room = most_bytes or BLOCK_BYTES
    cost = F.octet_length("words") + F.octet_length(F.array_join("items", ",")) + F.lit(-(-room // block))
    costed = windows.withColumn("cost", cost.cast("long"))
    return with_history(costed, [], ["words"], [RunningSum("before", "cost")]).select(
        "words", "items", F.floor(F.col("before") / room).alias("block")
    )


@dataclass
class Block:
    """Windows by length: sorted hashes, the word numbers in the same order, and the items."""

    vocabulary: dict
    by_length: dict

    @classmethod
    def of(cls, windows):
        vocabulary, rows = {}, {}
        for words, items in windows:
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words.encode().split(b" ")]
            rows.setdefault(len(ids), []).append((ids, items))
        by_length = {}
        for length, found in sorted(rows.items()):
            ids = np.array([x[0] for x in found], dtype=np.int64)
            hashes = rolling(ids.reshape(-1), length)[::length]
            order = np.argsort(hashes, kind="stable")
            by_length[length] = hashes[order], ids[order], [found[k][1] for k in order]
        return cls(vocabulary, by_length)

    def hits(self, ids):
        """(position, length, items) of every window that occurs in the word numbers; -1 is in no window."""
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        for length, (hashes, windows, items) in self.by_length.items():
            if len(ids) < length:
                continue
            starts = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not len(starts):
                continue
            seen = rolling(ids, length)[starts]
            low, high = np.searchsorted(hashes, seen, "left"), np.searchsorted(hashes, seen, "right")
            for k in np.flatnonzero(high > low):
                for row in range(low[k], high[k]):  # more than one only where hashes collide
                    if np.array_equal(ids[starts[k] : starts[k] + length], windows[row]):
                        yield int(starts[k]), length, items[row]


def rolling(ids, length):
    """A hash of every run of ``length`` numbers, by its first position."""
    values = ids.astype(np.uint64) + np.uint64(1)
    total = np.zeros(max(0, len(ids) - length + 1), dtype=np.uint64)
    for k in range(length):
        mixed = values[k : k + len(total)] * np.uint64(pow(FACTOR, k + 1, 2**64))
        total += mixed ^ (mixed >> np.uint64(29))
    return total


def merged(spans):
    """Overlapping and touching spans as one."""
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def scan(docs: DataFrame, benchmark: DataFrame, text="text", item="item_id", size=SIZE, block=BLOCK_WINDOWS) -> DataFrame:
    """The documents with ``n_words``, ``hit_words`` (merged spans of word positions) and ``hit_items``.

    Null and empty texts have no words and no hits; an item without words has no window; items of equal
    text are all named; a null item name counts as ''. Columns of the three names are replaced. Rows keep
    their partitions: nothing is shuffled but the windows.
    """
    small_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    windows = durable(in_blocks(windows_of(benchmark, item, size=size), block))
    blocks = windows.agg(F.max("block").alias("last")).first()["last"]
    docs = without(docs, RESULT).select(
        "*", F.lit(None).cast("long").alias("n_words"), F.array().cast(SPAN).alias("hit_words"),
        F.array().cast("array<string>").alias("hit_items"),
    )
    for number in range((blocks or 0) + 1):
        rows = windows.where(F.col("block") == number).select("words", "items")
        table = context.broadcast(Block.of((r["words"], r["items"]) for r in rows.toLocalIterator()))
        docs = docs.mapInArrow(lambda batches, table=table: scanned(batches, table.value, text), docs.schema)
    return docs


def scanned(batches, table, text):
    get = table.vocabulary.get
    for batch in batches:
        counts, spans, items = [], batch.column("hit_words").to_pylist(), batch.column("hit_items").to_pylist()
        for first, texts in slices(batch, text):
            numbers, starts = [], []
            for words in map(words_of, texts):
                starts.append(len(numbers))
                counts.append(len(words))
                numbers.extend([get(w, -1) for w in words])
                numbers.append(-1)  # no window runs on into the next text
            places = np.array(starts)
            for position, length, names in table.hits(np.array(numbers, dtype=np.int64)):
                row = int(np.searchsorted(places, position, "right")) - 1
                start = position - starts[row]
                spans[first + row].append({"start": start, "end": start + length})
                items[first + row] = items[first + row] + names
        spans = [x and [{"start": a, "end": b} for a, b in merged((s["start"], s["end"]) for s in x)] for x in spans]
        span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield with_columns(batch, {
            "n_words": pa.array(counts, pa.int64()),
            "hit_words": pa.array(spans, span_type),
            "hit_items": pa.array([x and sorted(set(x)) for x in items], pa.list_(pa.string())),
        })


def summary(scanned_docs: DataFrame, key="doc_id") -> DataFrame:
    """One row per document: counts of words, hit words and items, and the items' digest."""
    spans = F.aggregate("hit_words", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long"))
    return scanned_docs.select(
        key, "n_words", spans.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.size("hit_words") > 0).alias("contaminated"),
    )


def cut(text: str, spans):
    """The text without these spans of word positions."""
    places = [m.span() for m in WORD.finditer(text)]
    out, last = [], 0
    for s in spans:
        out.append(text[last : places[s["start"]][0]])
        last = places[s["end"] - 1][1]
    return "".join([*out, text[last:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove="documents", text="text", item="item_id", size=SIZE) -> DataFrame:
    """The documents without contamination, with the columns they came with.

    ``remove="documents"`` drops every document with a hit; ``"spans"`` cuts the hit words and
    what stands between them out of the text and keeps the rest.
    """
    names = docs.columns
    found = scan(packed(docs, text), benchmark, "text", item, size)
    if remove == "documents":
        return unpacked(found.where(F.size("hit_words") == 0), names, text)

    def clean(batches):
        for batch in batches:
            texts, spans = batch.column("text").to_pylist(), batch.column("hit_words").to_pylist()
            yield with_columns(batch, {"text": pa.array([cut(t, s) if s else t for t, s in zip(texts, spans)], pa.string())})

    moved = found.select(*[c for c in found.columns if c != "text"], "text")
    return unpacked(moved.mapInArrow(clean, moved.schema), names, text)
