"""A quality classifier on learned subword embeddings.

A word's vector is the mean of the hashed vectors of the word and of its character n-grams;
a document's is the mean over its words and over its pairs of neighbouring words (of which
only whether the two are the same is told). A softmax layer turns it into two classes. Both
layers are trained by stochastic gradient descent in numpy on a bounded sample of labelled
rows, in one task. As the layers are linear up to the softmax, scoring needs one number per
bucket, and one number per distinct word can be remembered.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.batches import slices, small_batches, with_columns, without
from paceline.session import durable

#: The bound of the training sample: rows with the smallest hash of the key are taken.
TRAIN_ROWS = 6000
FOLDS = 5
THRESHOLD = 0.3
KNOWN_WORDS = 200_000
KNOWN_CHARS = 64


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    shortest: int = 2
    longest: int = 4
    dimensions: int = 8
    epochs: int = 12
    rate: float = 0.4
    seed: int = 7


FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(values, buckets):
    values = (values ^ (values >> np.uint64(31))) * FACTOR
    return ((values ^ (values >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)


def subwords(words, settings):
    """(buckets, word numbers) of every distinct word's own feature and its character n-grams."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), lengths)
    found, owners = [], []
    total = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, settings.longest + 1):
        total = total[: len(codes) - n + 1] * FACTOR + codes[n - 1 :]
        if n >= settings.shortest:
            whole = owner[: len(total)] == owner[n - 1 :]
            found.append(mixed(total[whole] + np.uint64(n), settings.buckets))
            owners.append(owner[: len(total)][whole])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(codes)) - starts[owner]
    powers = np.cumprod(np.concatenate([[1], np.full(int(lengths.max()), int(FACTOR), dtype=np.uint64)]).astype(np.uint64))
    found.append(mixed(np.add.reduceat(codes * powers[place], starts) ^ FACTOR, settings.buckets))
    owners.append(np.arange(len(words)))
    return np.concatenate(found), np.concatenate(owners)


def repeats(words):
    """How many words are followed by themselves."""
    return sum(map(str.__eq__, words, words[1:]))


def features(text, settings):
    """(buckets, weights) of a document, weights summing to 1; none without words."""
    words = text.split()
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    distinct = {w: k for k, w in enumerate(dict.fromkeys(words))}
    counts = np.bincount([distinct[w] for w in words], minlength=len(distinct)).astype(float)
    buckets, owner = subwords(list(distinct), settings)
    weights = (counts / np.bincount(owner))[owner]
    same = repeats(words)
    buckets = np.concatenate([buckets, [settings.buckets, settings.buckets + 1]])
    weights = np.concatenate([weights, [same, len(words) - 1 - same]])
    ids, at = np.unique(buckets, return_inverse=True)
    return ids, np.bincount(at, weights) / (2 * len(words) - 1)


def train(texts, labels, settings=Settings()):
    """(one number per bucket, bias): log odds of label 1, as the mean over a document's features.

    Steps are divided by the squared length of the document's weights, so a step moves long and
    short documents alike.
    """
    random = np.random.default_rng(settings.seed)
    size = settings.buckets + 2
    vectors = random.uniform(-1, 1, (size, settings.dimensions)) / settings.dimensions
    output, bias = np.zeros((settings.dimensions, 2)), np.zeros(2)
    rows = []
    for text, label in zip(texts, labels):
        ids, weights = features(text, settings)
        rows.append((ids.astype(np.int32), weights.astype(np.float32), int(label)))
    steps, total = 0, max(1, settings.epochs * len(rows))
    for _ in range(settings.epochs):
        for k in random.permutation(len(rows)):
            ids, weights, label = rows[k]
            rate = settings.rate * (1 - steps / total)
            steps += 1
            hidden = weights @ vectors[ids]
            scores = hidden @ output + bias
            odds = np.exp(scores - scores.max())
            error = odds / odds.sum()
            error[label] -= 1
            back = output @ error
            output -= rate * np.outer(hidden, error)
            bias -= 0.1 * rate * error
            if len(ids):
                vectors[ids] -= np.outer(rate * weights / max(weights @ weights, 1e-3), back)
    return vectors @ (output[:, 1] - output[:, 0]), float(bias[1] - bias[0])


class Scorer:
    """Scores texts; remembers one number for each word."""

    def __init__(self, table, bias, settings):
        self.table, self.bias, self.settings, self.known = table, bias, settings, {}

    def __call__(self, texts):
        split = [t.split() for t in texts]
        new = list({w for words in split for w in words}.difference(self.known))
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known = {w: self.known[w] for words in split for w in words if w in self.known}
        if new:
            buckets, owner = subwords(new, self.settings)
            means = np.bincount(owner, self.table[buckets]) / np.bincount(owner)
            self.known.update(zip(new, means.tolist()))
        get, same, other = self.known.__getitem__, float(self.table[-2]), float(self.table[-1])
        out = []
        for words in split:
            odds = self.bias
            if words:
                equal = repeats(words)
                total = sum(map(get, words)) + equal * same + (len(words) - 1 - equal) * other
                odds += total / (2 * len(words) - 1)
            out.append(1 / (1 + np.exp(-np.clip(odds, -500, 500))))
        for word in new:
            if len(word) > KNOWN_CHARS:
                del self.known[word]
        return out


def held_out(key="doc_id"):
    """True for rows that are never learned from; a null key counts as an empty one."""
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))) % FOLDS == 0


def sample(docs: DataFrame, labels: DataFrame, key="doc_id", text="text", label="quality", rows=TRAIN_ROWS) -> DataFrame:
    """(key, text, label) of at most ``rows`` labelled documents outside the held-out fold.

    Which labels are taken depends on their keys alone. Null labels and keys are left out.
    """
    usable = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
    usable = usable.where(F.col("key").isNotNull() & F.col("label").isin(0, 1) & ~held_out("key"))
    chosen = usable.orderBy(F.xxhash64("key"), "key", "label").limit(rows)
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(durable(chosen)), "key")


def fit(docs: DataFrame, labels: DataFrame, settings=Settings(), rows=TRAIN_ROWS, **columns):
    """(one number per bucket, bias), trained in one task on the bounded sample."""
    small_batches(docs.sparkSession)
    chosen = sample(docs, labels, rows=rows, **columns)
    # A key may stand in several documents; the bound holds for them, too.
    bounded = chosen.orderBy(F.xxhash64("key"), "key", "text", "label").limit(rows)

    def work(batches):
        found = sorted(
            (x for b in batches for x in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), b.column("label").to_pylist())),
            key=lambda x: (x[0], x[1], x[2]),
        )
        table, bias = train([x[1] for x in found], [x[2] for x in found], settings)
        data = [[table.astype("<f8").tobytes()], [bias], [len(found)]]
        yield pa.RecordBatch.from_arrays([pa.array(data[0], pa.binary()), pa.array(data[1], pa.float64()), pa.array(data[2], pa.int64())], names=["numbers", "bias", "rows"])

    model = durable(bounded.coalesce(1).mapInArrow(work, "numbers binary, bias double, rows long")).first()
    if model is None:  # nothing to learn from: every text may stay
        return np.zeros(settings.buckets + 2), 0.0
    return np.frombuffer(bytes(model["numbers"]), dtype="<f8"), model["bias"]


def score(docs: DataFrame, model, settings=Settings(), text="text", column="score") -> DataFrame:
    """Add the probability of label 1 for each whole text; texts without words get the prior alone.

    A column of that name is replaced; rows stay where they are.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        scorer = Scorer(*shared.value, settings)
        for batch in batches:
            scores = []
            for _, texts in slices(batch, text):
                scores += scorer([t.decode() for t in texts])
            yield with_columns(batch, {column: pa.array(scores, pa.float64())})

    docs = without(docs, [column])
    return docs.mapInArrow(work, docs.select("*", F.lit(0.0).alias(column)).schema)


def good(docs: DataFrame, labels: DataFrame, threshold=THRESHOLD, settings=Settings()) -> DataFrame:
    """The documents whose score reaches the threshold, with the columns they came with, but for one named ``_score``."""
    scored = score(without(docs, ["_score"]), fit(docs, labels, settings), settings, column="_score")
    return scored.where(F.col("_score") >= threshold).drop("_score")
