"""SimHash fingerprints and the groups of those that differ in few bits, by vantage-point trees.

A tree node holds one fingerprint, the vantage, and a radius: fingerprints within the radius are
on its near side, all others on its far side. By the triangle inequality, fingerprints within
``bits`` of a query can only be on a side that the query's own distance from the vantage leaves
possible. A small tree fitted on a sample cuts the whole set into shards. Every distinct
fingerprint lives in one shard and is also sent, as a query, to each later shard that lies
within ``bits`` of it, so every pair meets in exactly one task. There a tree over the shard
finds exact pairs.

Groups need no list of pairs. A task keeps what it has linked so far and stops asking a subtree
that is one group already for members of that group; it hands on one link for each fingerprint.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.batches import slices, small_batches, word_blocks
from paceline.llm.ngram_join import components
from paceline.session import durable

WORDS = 3
BITS = 2
SEED = 42
#: Every byte to itself, A-Z to a-z, and ASCII white space to a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
#: Fingerprints of a shard (8 bytes each in its task), and the least that make one of their own where there is room for more tasks.
SHARD_ROWS, SMALL_SHARD = 1 << 20, 2_000
#: Sampled fingerprints for each shard; the sample decides where shards are cut, never what is found.
SAMPLE = 64
LEAF = 48
CHUNK = 256
COMPARED = 1 << 20
SAMPLE_RANGE = 1 << 30


def fingerprint(text: bytes, size=WORDS, seed=SEED) -> int:
    """64 bits, each set if it is in over half of the hashes of the text's shingles, repeats included."""
    counts, total, before = np.zeros(64, dtype=np.int64), 0, []
    for words in word_blocks(text.translate(FOLD)):
        words = before + words
        digests = hashes(words, size, seed)
        counts += votes(digests)
        total += len(digests)
        before = words[len(words) - size + 1 :] if len(words) >= size else words
    if not total and before:
        digests, total = hashes(before, len(before), seed), 1
        counts = votes(digests)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def hashes(words, size, seed):
    """XXH64 of every run of ``size`` words joined by spaces, as big-endian bytes."""
    if len(words) < size:
        return []
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_digest
    return [digest(joined[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist())]


def votes(digests):
    bits = np.unpackbits(np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, key="doc_id", text="text", size=WORDS, seed=SEED) -> DataFrame:
    """(key, fingerprint long) of every row; texts without words, null ones too, have fingerprint 0."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text"))

    def work(batches):
        for batch in batches:
            for first, texts in slices(batch, "text"):
                found = np.array([fingerprint(t, size, seed) for t in texts], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(found.view(np.int64))], names=[key, "fingerprint"]
                )

    return rows.mapInArrow(work, rows.select(f"`{key}`").schema.add("fingerprint", "long"))


def distances(a, b):
    return np.bitwise_count(a ^ b)


class Tree:
    """A vantage-point tree over distinct fingerprints.

    ``points`` is put in the order of the tree: node k covers points[first[k] : last[k]], and is a
    leaf if ``near[k]`` is negative.
    """

    def __init__(self, points, leaf=LEAF, seed=0):
        self.points = np.array(points, dtype=np.uint64)
        self.first, self.last, self.near, self.far, self.vantage, self.radius = [], [], [], [], [], []
        pick = np.random.default_rng(seed)
        todo = [self._node(0, len(self.points))]
        while todo:
            node = todo.pop()
            first, last = self.first[node], self.last[node]
            if last - first <= leaf:
                continue
            own = self.points[first:last]
            vantage, radius = self._vantage(own, pick)
            inside = distances(own, vantage) <= radius
            middle = first + int(inside.sum())
            self.points[first:last] = np.concatenate([own[inside], own[~inside]])
            self.vantage[node], self.radius[node] = vantage, radius
            self.near[node], self.far[node] = self._node(first, middle), self._node(middle, last)
            todo += [self.near[node], self.far[node]]

    def _node(self, first, last):
        for column, value in zip((self.first, self.last, self.near, self.far, self.vantage, self.radius), (first, last, -1, -1, 0, 0)):
            column.append(value)
        return len(self.first) - 1

    @staticmethod
    def _vantage(points, pick):
        """Of a few points the one from which distances spread most, and a radius that leaves something on both sides."""
        tried = points[pick.integers(len(points), size=6)]
        some = points[pick.integers(len(points), size=min(len(points), 256))]
        vantage = tried[np.argmax([distances(some, v).std() for v in tried])]
        far = distances(points, vantage).astype(np.int64)
        return vantage, min(int(np.median(far)), int(far.max()) - 1)

    def leaves(self):
        return [k for k, near in enumerate(self.near) if near < 0]

    def sides(self, node, queries, bits):
        """Which queries may have points within ``bits`` of them on the near side, and which on the far side."""
        d = distances(queries, self.vantage[node]).astype(np.int64)
        return d <= self.radius[node] + bits, d > self.radius[node] - bits

    def reached(self, queries, bits):
        """(query index, leaf) for every leaf within ``bits``; with 0 bits the one leaf where a point belongs."""
        rows, places, todo = [], [], [(0, np.arange(len(queries)))]
        while todo:
            node, own = todo.pop()
            if not len(own):
                continue
            if self.near[node] < 0:
                rows.append(own)
                places.append(np.full(len(own), node))
                continue
            near, far = self.sides(node, queries[own], bits)
            todo += [(self.near[node], own[near]), (self.far[node], own[far])]
        return (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (rows, places))


class ShardJoin:
    """Exact pairs within ``bits`` among a shard's points, and between them and points of other shards.

    ``groups`` keeps only which points hang together; otherwise pairs are kept as found.
    """

    def __init__(self, points, bits, groups=True):
        self.tree, self.bits, self.groups = Tree(points), bits, groups
        self.values, self.home = self.tree.points, len(points)
        self.parent, self.pairs = np.arange(len(points)), []
        self.whole = np.zeros(len(self.tree.first), dtype=bool)

    def find(self, k):
        root = self.parent[k]
        while True:
            up = self.parent[root]
            if (up == root).all():
                self.parent[k] = root
                return root
            root = up

    def link(self, a, b):
        if not self.groups:
            self.pairs.append((self.values[a], self.values[b]))
            return
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
            np.minimum.at(self.parent, a, b)

    def one_group(self, node):
        """Whether all points of a node are known to hang together; once true it stays so."""
        tree = self.tree
        if not self.whole[node] and tree.near[node] >= 0 and self.whole[tree.near[node]] and self.whole[tree.far[node]]:
            a, b = self.find(np.array([tree.first[node], tree.last[node] - 1]))
            self.whole[node] = a == b
        return self.whole[node]

    def within(self):
        """All pairs among the shard's points: children before their parents, then from side to side."""
        tree = self.tree
        for node in reversed(range(len(tree.first))):  # children have higher numbers
            first, last = tree.first[node], tree.last[node]
            own = np.arange(first, last)
            if tree.near[node] < 0:
                self.compare(own, first, last, later=True)
                self.whole[node] = self.groups and len(np.unique(self.find(own))) == 1
                continue
            left = np.arange(first, tree.last[tree.near[node]])
            self.search(tree.far[node], left[tree.sides(node, self.values[left], self.bits)[1]])
            self.one_group(node)

    def search(self, node, queries):
        """Link queries (positions) with the points below a node."""
        tree, todo = self.tree, [(node, queries)]
        while todo:
            node, own = todo.pop()
            if self.groups and len(own) and self.one_group(node):
                own = own[self.find(own) != self.find(np.array([tree.first[node]]))]
                step = max(CHUNK, len(own) // 8)
                if len(own) > step:  # the first ones may make the rest needless
                    todo.append((node, own[step:]))
                    own = own[:step]
            if not len(own):
                continue
            if tree.near[node] < 0:
                self.compare(own, tree.first[node], tree.last[node])
                continue
            near, far = tree.sides(node, self.values[own], self.bits)
            todo += [(tree.near[node], own[near]), (tree.far[node], own[far])]

    def compare(self, queries, first, last, later=False):
        """Every query with every point of a leaf; ``later`` keeps pairs within the leaf to one order."""
        step = max(1, COMPARED // max(1, last - first))
        for k in range(0, len(queries), step):
            some = queries[k : k + step]
            close = distances(self.values[some][:, None], self.values[first:last][None, :]) <= self.bits
            a, b = np.nonzero(close)
            a, b = some[a], first + b
            if later:
                a, b = a[a < b], b[a < b]
            self.link(a, b)

    def foreign(self, queries):
        """Points of other shards: their links, as (foreign, home) values."""
        self.values = np.concatenate([self.values[: self.home], queries])
        self.parent = np.concatenate([self.parent[: self.home], self.home + np.arange(len(queries))])
        own = np.arange(self.home, len(self.values))
        self.search(0, own)
        roots = self.find(own)
        met = (roots < self.home) & self.groups  # a group's root is its first point, at home if any is
        return self.values[own[met]], self.values[roots[met]]

    def rest(self):
        """The links among the shard's points: each one with the first of its group, or all pairs."""
        if not self.groups:
            return tuple(np.concatenate([p[k] for p in self.pairs]) if self.pairs else np.zeros(0, dtype=np.uint64) for k in (0, 1))
        roots = self.find(np.arange(self.home))
        moved = np.flatnonzero(roots != np.arange(self.home))
        return self.values[moved], self.values[roots[moved]]


def shard_tree(prints: DataFrame, count: int) -> Tree:
    """A tree whose leaves are the shards, fitted on about SAMPLE fingerprints a shard.

    There is a shard for every SHARD_ROWS fingerprints, or more and smaller ones up to the
    number of shuffle partitions, so the sample and the tree grow by a byte or so for every
    thousand fingerprints.
    """
    room = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-count // SHARD_ROWS), min(room, count // SMALL_SHARD))
    share = min(SAMPLE_RANGE, -(-SAMPLE * shards * SAMPLE_RANGE // max(1, count)))
    some = prints.where(F.pmod(F.xxhash64("fingerprint"), F.lit(SAMPLE_RANGE)) < share).collect()
    values = np.sort(np.array([r["fingerprint"] for r in some], dtype=np.int64).view(np.uint64))
    return Tree(values, leaf=max(1, -(-len(values) // shards)))


def segments(batches):
    """(shard, home, fingerprints) for every run of rows of one shard and kind."""
    for batch in batches:
        shard, home, value = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if len(shard):
            cuts = np.flatnonzero((np.diff(shard) != 0) | (home[1:] != home[:-1])) + 1
            for own in np.split(np.arange(len(shard)), cuts):
                yield shard[own[0]], home[own[0]], value[own].view(np.uint64)


def close_links(prints: DataFrame, bits=BITS, groups=True) -> DataFrame:
    """(a, b) links of a stored table of distinct fingerprints (``fingerprint`` long).

    With ``groups`` a few links, at most one for each fingerprint and shard it is sent to, hold
    together whatever hangs together; they are not pairs themselves. Without, all pairs within
    ``bits``, each once; a fingerprint has at most 2,080 within two bits.
    """
    tree = shard_tree(prints, prints.count())
    shared, shards = prints.sparkSession.sparkContext.broadcast(tree), len(tree.leaves())

    def send(batches):
        tree = shared.value
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows, homes = tree.reached(values, 0)
            home = np.empty(len(values), dtype=np.int64)
            home[rows] = homes
            rows, places = tree.reached(values, bits)
            kept = places >= home[rows]
            rows, places = rows[kept], places[kept]
            columns = [pa.array(places.astype(np.int32)), pa.array(places == home[rows]), pa.array(values[rows].view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "home", "fingerprint"])

    def edges(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def join(batches):
        current, points, own = None, [], None
        for shard, home, values in segments(batches):
            if shard != current:
                yield from finished(points, own)
                current, points, own = shard, [], None
            if home:
                points.append(values)
                continue
            own = own or started(points)
            yield edges(*own.foreign(values))
        yield from finished(points, own)

    def started(points):
        own = ShardJoin(np.concatenate(points), bits, groups)
        own.within()
        return own

    def finished(points, own):
        if points:
            yield edges(*(own or started(points)).rest())

    sent = prints.select("fingerprint").mapInArrow(send, "shard int, home boolean, fingerprint long")
    ordered = sent.repartition(shards, "shard").sortWithinPartitions("shard", F.desc("home"))
    return ordered.mapInArrow(join, "a long, b long")


def near_pairs(docs: DataFrame, key="doc_id", text="text", bits=BITS, size=WORDS) -> DataFrame:
    """(a, b, distance) for every two different fingerprints of the texts within ``bits`` of each other."""
    prints = durable(fingerprints(docs, key, text, size).select("fingerprint").distinct())
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return close_links(prints, bits, groups=False).withColumn("distance", distance)


def similarity_groups(docs: DataFrame, key="doc_id", text="text", bits=BITS, size=WORDS) -> DataFrame:
    """(key, fingerprint, component_id) of every row; component_id is the smallest key reachable.

    Rows link if their fingerprints, given as 16 lowercase hex digits, differ in at most ``bits``
    bits. A-Z are lowered; words are what stands between ASCII white space; a text of fewer words
    than a shingle is one shingle as a whole. Texts without words and null ones have fingerprint 0
    and are linked like any other. Rows that share a key share nothing else; a group whose keys are
    all null has a null component_id. No rows give no rows; other columns are not carried.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    prints = durable(fingerprints(rows, "key", "text", size))
    classes = durable(prints.groupBy("fingerprint").agg(F.min("key").alias("low")))
    found = components(durable(close_links(classes, bits)))
    grouped = classes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    grouped = durable(grouped.withColumn("component", F.coalesce("component", "fingerprint")))
    named = grouped.groupBy("component").agg(F.min("low").alias("component_id"))
    # written, so that the last join can cut up a fingerprint that very many rows have
    named = durable(grouped.join(named, "component").select("fingerprint", "component_id"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return prints.join(named, "fingerprint").select(F.col("key").alias(key), digits, "component_id")
