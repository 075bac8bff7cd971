"""A corpus pipeline out of the operators of ``paceline.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the
last keep the columns of ``documents``; the last one returns ids.
"""

from pyspark.sql import functions as F

from paceline.llm import bpe, decontaminate, ngram_join, quality, stream_dedup
from paceline.llm.queries import digests, table, tokenizer_path
from paceline.session import durable

NEAR_WORDS, NEAR_PERCENT = 5, 80


def good_quality(spark, docs, sf_dir):
    """Documents whose quality score reaches the threshold."""
    return quality.good(docs, table(spark, sf_dir, "labels"))


def distinct_texts(spark, docs, sf_dir):
    """One document of each set of texts that are equal but for white space."""
    return stream_dedup.kept_rows(docs)


def distinct_ngrams(spark, docs, sf_dir):
    """One document of each group of near copies, by sets of five-word n-grams at a similarity of 0.8 or more."""
    return ngram_join.one_of_each(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


def uncontaminated(spark, docs, sf_dir):
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark, docs, sf_dir):
    """Ids of every text, and digests of the ids and of what they decode to."""
    decoded = bpe.encode(docs, tokenizer_path(), decoded="decoded")
    return digests(decoded, F.col("lang"), F.col("source"), F.col("ids"))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", distinct_texts),
    ("n-gram Jaccard join", distinct_ngrams),
    ("benchmark decontamination", uncontaminated),
    ("BPE encoding and decoding", encoded),
]
#: A trained classifier and a BPE are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage over ``documents``; every stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
