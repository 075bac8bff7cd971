"""Importance resampling: draw the rows of a corpus that look most like a target corpus.

A 256-byte table lowers A-Z and blanks separators in the UTF-8 bytes of a text, ``bytes.split``
gives its words, and a run of words is known by the CRC-32 of the words joined by spaces, which
is chained from the run that is one word shorter. Runs are counted in a fixed number of buckets,
in Counters within tasks and by Spark across them. A bucket's gain is the logarithm of how much
more often the target has it; a text weighs the mean gain of its runs. Gumbel noise from a hash
of the key makes the highest scores a draw without replacement in proportion to the weights.

Texts are read twice, once for the counts of the corpus and once for the weights. What reaches
the driver and is broadcast is one number for each bucket, whatever the corpus.
"""

import math
from collections import Counter
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.batches import free_name, slices, small_batches, word_blocks
from paceline.llm.decontaminate import FOLD
from paceline.llm.sharding import numbered
from paceline.llm.stream_dedup import checked_broadcast
from paceline.session import durable

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
#: Gains, weights and scores are whole numbers: thousandths of a natural logarithm.
SCALE = 1000


def runs(text: bytes, longest=LONGEST):
    """(words, Counter of the CRC-32 of every run of 1 to ``longest`` words) for each block of a text."""
    before = []
    for words in word_blocks(text.translate(FOLD)):
        own, words = len(words), before + words
        old = len(before)
        crcs = list(map(crc32, words))
        found = Counter(crcs[old:])
        spaced = [b" " + w for w in words] if longest > 1 else []
        for length in range(2, longest + 1):
            crcs = list(map(crc32, spaced[length - 1 :], crcs))
            found.update(crcs[max(0, old - length + 1) :])  # a run is counted in the block of its last word
        before = words[len(words) - longest + 1 :] if 1 < longest <= len(words) else words if longest > 1 else []
        yield own, found


def bucket_counts(docs: DataFrame, text="text", longest=LONGEST, buckets=BUCKETS) -> dict:
    """bucket -> how many runs of all texts fall into it; at most ``buckets`` numbers."""
    small_batches(docs.sparkSession)

    def count(batches):
        total = Counter()
        for batch in batches:
            for _, texts in slices(batch, "text"):
                for t in texts:
                    for _, found in runs(t, longest):
                        for crc, n in found.items():
                            total[crc % buckets] += n
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int64()), pa.array(total.values(), pa.int64())], names=["bucket", "n"])

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "bucket long, n long")
    return {r["bucket"]: r["n"] for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(source: dict, target: dict, buckets=BUCKETS) -> list:
    """For each bucket the floor of 1000 ln of its smoothed share in the target over that in the source."""
    all_source, all_target = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    ratio = lambda b: (target.get(b, 0) + 1.0) * all_source / ((source.get(b, 0) + 1.0) * all_target)
    return [math.floor(SCALE * math.log(ratio(b))) for b in range(buckets)]


def weights(docs: DataFrame, table: list, text="text", longest=LONGEST) -> DataFrame:
    """The rows without the text, with ``n_words``, ``n_features`` and ``weight``; the rows must not have these."""
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != text]
    schema = docs.select([f"`{c}`" for c in kept]).schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def weigh(batches):
        table = shared.value
        buckets = len(table)
        for batch in batches:
            for first, texts in slices(batch, text):
                sizes, features, means = [], [], []
                for t in texts:
                    n_words = n_features = total = 0
                    for words, found in runs(t, longest):
                        n_words += words
                        n_features += found.total()
                        total += sum(table[crc % buckets] * n for crc, n in found.items())
                    sizes.append(n_words)
                    features.append(n_features)
                    means.append(total // n_features if n_features else 0)
                part = batch.slice(first, len(texts))
                added = [pa.array(x, pa.int64()) for x in (sizes, features, means)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *added], names=schema.names)

    return docs.mapInArrow(weigh, schema)


def noise(key, seed=SEED):
    """Gumbel noise of a key (a column): the floor of -1000 ln(-ln u), where u comes from a hash of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))), 256)
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-SCALE * F.log(-F.log((number + 0.5) / F.lit(4294967296.0))))


def ranked(docs: DataFrame, target: DataFrame, key="doc_id", text="text", **settings) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of every row; settings are those of ``draw``.

    Of the N rows with at least ``least_words`` words the floor(percent * N / 100) with the highest
    score have ranks 1, 2, 3 ..., all other rows a null rank. Ties go to the smaller key, null last;
    rows equal in both follow each other in any order. A null or empty text has no words and weight
    0; a null key is hashed as the text ``null``, rows that share a key share its noise. An empty
    table gives an empty one; an empty target counts as one without runs. Other columns are not
    carried.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return draw(rows, target, **settings).withColumnRenamed("key", key)


def resample(docs: DataFrame, target: DataFrame, key="doc_id", text="text", **settings) -> DataFrame:
    """The rows that ``ranked`` gives a rank, with the columns they came with."""
    names = docs.columns
    number = free_name(docs, "_number")
    landed = durable(docs.withColumn(number, F.monotonically_increasing_id()))
    rows = landed.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(number).alias("number"))
    drawn = draw(rows, target, **settings).where(F.col("rank").isNotNull()).select(F.col("number").alias(number))
    return landed.join(checked_broadcast(durable(drawn)), number, "left_semi").select([f"`{c}`" for c in names])


def draw(
    rows: DataFrame, target: DataFrame, target_text="text", percent=PERCENT, least_words=LEAST_WORDS,
    longest=LONGEST, buckets=BUCKETS, seed=SEED,
) -> DataFrame:
    """Rows of key and text with what ``ranked`` adds instead of the text.

    Scores are sorted by range, so no task gets more than its share of them however many are equal.
    """
    table = gains(bucket_counts(rows, "text", longest, buckets), bucket_counts(target, target_text, longest, buckets), buckets)
    scored = durable(weights(rows, table, "text", longest).withColumn("score", F.col("weight") + noise(F.col("key"), seed)))
    fit = F.col("n_words") >= least_words
    drawn = scored.where(fit).count() * percent // 100
    ordered = scored.where(fit).withColumns({"down": -F.col("score"), "unkeyed": F.col("key").isNull()})
    placed = numbered(ordered, ["down", "unkeyed", "key"], "place").drop("down", "unkeyed")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).cast("long")
    unfit = scored.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).drop("place").unionByName(unfit)
