"""Exact Jaccard join of n-gram sets by rare-first prefixes, and the groups that its links make.

Two sets can only be similar if they share an n-gram among the first few of each, in one order
for all: rare ones first. The order comes from a count sketch of fixed size over all documents,
so it costs no shuffle of n-grams; it decides how many candidates there are, never which links
are found. Documents of equal sets are one node. A node's prefix n-grams are shuffled; those
that only one node has end there, and the others are the lists that candidates come from.

A list of many similar nodes would give a pair for every two of them. Therefore each node is
first linked to the node that has the n-gram earliest in its order (the one with the fewest rare
n-grams of its own), and only nodes of different groups are paired after that. The smaller set of
such a pair must have the n-gram so early that a set at least as large can still match; it meets only
sets of the sizes that its place allows, which are part of the join's key. Every pair that
is left passes the length, positional and suffix filters and is verified once, on whole sets.
Lists and nodes of very many pairs are cut into pieces, each with a copy of what it is compared with.
"""

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.batches import free_name, slices, small_batches, texts_of
from paceline.llm.stream_dedup import checked_broadcast
from paceline.session import durable

WORDS = 3
PERCENT = 90
SKETCH_BITS = 22
SKETCH_RANGES = 64
SIGNATURE = 64
KNOWN = 200_000
KNOWN_BYTES = 64
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
SETS = "node long, n_shingles long, digest binary, signature array<tinyint>, part int, counts binary"
MAX_ROUNDS = 100
SHORT_LIST = 16
HOT_LIST = 100_000
#: Rows of one n-gram, or pairs of one node, that go to a task together.
PIECE = 500
#: Size classes within which a set and the largest that it can be linked with lie.
SIZE_STEPS = 2
#: The grade of a bucket of usual load, and the steps that grades widen by.
USUAL, WIDER = 64, 8


class WordHashes(dict):
    """Hashes of words, worked out once each."""

    def __missing__(self, word):
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= KNOWN_BYTES:
            if len(self) >= KNOWN:
                self.clear()
            self[word] = value
        return value


def stirred(values):
    values = (values ^ (values >> np.uint64(29))) * B
    return values ^ (values >> np.uint64(32))


def shingles(text: bytes, known, size=WORDS):
    """Sorted distinct hashes of a text's n-grams; a text of fewer words has its whole sequence as one."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    ids = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(size, len(ids))
    total = np.full(len(ids) - size + 1, np.uint64(size))
    for k in range(size):
        total = stirred(total * A + ids[k : k + len(total)] * C)
    return np.unique(total)


def overlap_needed(left, right, percent=PERCENT):
    """The shared n-grams that two sets of these sizes need (columns)."""
    return F.ceil((left + right) * percent / (100 + percent))


def describe(docs: DataFrame, size=WORDS) -> DataFrame:
    """A row per document with size, digest and signature of its set, and each task's counts for the sketch.

    The signature holds how many n-grams fall into each of 64 equal ranges of the hash.
    """

    def work(batches):
        known, sketch = WordHashes(), np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            for first, texts in slices(batch, "text"):
                sizes, digests, signatures, seen = [], [], [], []
                for text in texts:
                    found = shingles(text, known, size)
                    sizes.append(len(found))
                    digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                    signatures.append(np.minimum(np.bincount((found >> np.uint64(58)).astype(np.int64), minlength=SIGNATURE), 127).astype(np.int8))
                    seen.append(found)
                np.add.at(sketch, (np.concatenate(seen) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                count = len(texts)
                offsets = pa.array(np.arange(0, (count + 1) * SIGNATURE, SIGNATURE, dtype=np.int32))
                yield sets_batch(
                    nodes[first : first + count], sizes, digests,
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(signatures))), [None] * count, [None] * count,
                )
        packer = zstandard.ZstdCompressor(level=1)
        sketch = sketch.astype(np.min_scalar_type(sketch.max()))  # the width of a count shows in the length
        parts = [packer.compress(p.tobytes()) for p in np.split(sketch, SKETCH_RANGES)]
        none = [None] * SKETCH_RANGES
        yield sets_batch(none, none, none, pa.array(none, pa.list_(pa.int8())), list(range(SKETCH_RANGES)), parts)

    return docs.mapInArrow(work, SETS)


def sets_batch(nodes, sizes, digests, signatures, parts, counts):
    columns = [
        pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), signatures,
        pa.array(parts, pa.int32()), pa.array(counts, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["node", "n_shingles", "digest", "signature", "part", "counts"])


def grade_of(counts, usual):
    """Grades of counts (0 to 255): the standard deviations above the usual load, ever wider apart.

    What light n-grams add to a bucket varies by the root of their number, so an n-gram stands
    out once it has a few times that many documents, however full the buckets are.
    """
    above = (np.asarray(counts, dtype=np.float64) - usual) / max(usual**0.5, 1.0)
    return np.clip(USUAL + WIDER * np.arcsinh(above), 0, 255).astype(np.uint8)


def rarity(described: DataFrame, hot=HOT_LIST):
    """A byte per bucket of the sketch, growing with the count (4 MB whatever the corpus), and the grade of very common n-grams.

    Those are in ``hot`` documents, and in far more than their bucket would hold by chance.
    """
    parts = described.where(F.col("part").isNotNull()).select("part", "counts")

    def add(batches):
        totals, unpacker = {}, zstandard.ZstdDecompressor()
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                data = unpacker.decompress(counts)
                found = np.frombuffer(data, dtype=f"<u{len(data) * SKETCH_RANGES >> SKETCH_BITS}")
                totals[part] = totals.get(part, np.zeros(len(found), dtype=np.uint64)) + found
        for part, total in totals.items():
            usual = float(np.median(total))
            columns = [pa.array([part], pa.int32()), pa.array([grade_of(total, usual).tobytes()], pa.binary()), pa.array([usual])]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "grades", "usual"])

    rows = parts.repartition(SKETCH_RANGES, "part").mapInArrow(add, "part int, grades binary, usual double").collect()
    if not rows:
        return np.zeros(1 << SKETCH_BITS, dtype=np.uint8), 255
    usual = float(np.mean([r["usual"] for r in rows]))
    grades = np.concatenate([np.frombuffer(r["grades"], dtype=np.uint8) for r in sorted(rows, key=lambda r: r["part"])])
    return grades, int(grade_of(max(hot, 32 * usual), usual))


def prefixes(docs: DataFrame, grades, lowest, size=WORDS, percent=PERCENT) -> DataFrame:
    """(n-gram, node, place) of every n-gram in a prefix that nodes which may be similar share.

    Entries travel packed by range of the n-gram; equal sets within a task travel once. An n-gram
    that stands out as very common (a grade of ``lowest`` or more) goes by its node instead, so its
    list is spread over all tasks, and all of it stays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(grades)
    pieces = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = np.uint64(2**64 // pieces + 1)

    def pack(batches):
        known, sent, table = WordHashes(), set(), shared.value
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            for first, texts in slices(batch, "text"):
                keys, owners, places, sizes = [], [], [], []
                for node, text in zip(nodes[first:], texts):
                    found = shingles(text, known, size)
                    digest = xxhash.xxh3_128_digest(found.tobytes())
                    if not len(found) or digest in sent:
                        continue
                    sent.add(digest)
                    grade = table[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
                    count = len(found) - (len(found) * percent + 99) // 100 + 1
                    order = np.argsort((grade << np.uint64(56)) | (found >> np.uint64(8)), kind="stable")[:count]
                    keys.append(found[order])
                    owners.append(np.full(count, node, dtype=np.int64))
                    places.append(np.arange(count, dtype=np.int32))
                    sizes.append(np.full(count, len(found), dtype=np.int32))
                if not keys:
                    continue
                keys, owners, places, sizes = (np.concatenate(x) for x in (keys, owners, places, sizes))
                common = table[(keys >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] >= lowest
                piece = np.where(common, owners % pieces, (keys // width).astype(np.int64))
                order = np.argsort(piece, kind="stable")
                listed, starts = np.unique(piece[order], return_index=True)
                cut = [np.split(x[order], starts[1:]) for x in (keys, owners, places, sizes)]
                columns = [pa.array(listed.astype(np.int32))] + [pa.array([p.tobytes() for p in x], pa.binary()) for x in cut]
                yield pa.RecordBatch.from_arrays(columns, names=["piece", "keys", "nodes", "places", "sizes"])

    def unpack(batches):
        held = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["piece"], []).append((row["keys"], row["nodes"], row["places"], row["sizes"]))
        for rows in held.values():
            keys, nodes, places, sizes = (
                np.frombuffer(b"".join(r[k] for r in rows), dtype=t) for k, t in enumerate(("<u8", "<i8", "<i4", "<i4"))
            )
            order = np.argsort(keys, kind="stable")
            keys, nodes, places, sizes = keys[order], nodes[order], places[order], sizes[order]
            common = shared.value[(keys >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] >= lowest
            alive = np.flatnonzero(common | with_partner(keys, places, sizes, percent))
            for k in range(0, len(alive), 50_000):
                some = alive[k : k + 50_000]
                columns = [pa.array(keys[some].view(np.int64)), pa.array(nodes[some]), pa.array(places[some])]
                yield pa.RecordBatch.from_arrays(columns, names=["ngram", "member", "place"])

    packed = docs.mapInArrow(pack, "piece int, keys binary, nodes binary, places binary, sizes binary")
    return packed.repartition(pieces, "piece").mapInArrow(unpack, "ngram long, member long, place int")


def with_partner(keys, places, sizes, percent=PERCENT):
    """Which entries (sorted by key) have another one in their list that length and place leave possible.

    Lists of up to SHORT_LIST entries are gone through; longer ones stay whole if any entry can be
    the smaller one of a pair, and else have none.
    """
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    lengths = np.diff(np.append(starts, len(keys)))
    sizes, rest = sizes.astype(np.int64), (sizes - places).astype(np.int64)
    smaller = (rest * (100 + percent) >= 2 * sizes * percent).astype(np.int64)
    alive = np.repeat((lengths > SHORT_LIST) & (np.add.reduceat(smaller, starts) > 0), lengths) if len(keys) else smaller > 0
    for k in range(1, SHORT_LIST):
        near, far = slice(None, -k), slice(k, None)
        fits = keys[near] == keys[far]
        fits &= np.minimum(sizes[near], sizes[far]) * 100 >= np.maximum(sizes[near], sizes[far]) * percent
        fits &= np.minimum(rest[near], rest[far]) * (100 + percent) >= (sizes[near] + sizes[far]) * percent
        alive[near] |= fits
        alive[far] |= fits
    return alive


def candidates(pairs: DataFrame, percent=PERCENT) -> DataFrame:
    """Distinct pairs (a, b), a < b, that pass the three filters.

    Length: the smaller set may not be too small. Positional: what follows the shared n-gram must
    suffice, which holds for every similar pair at the first n-gram that it shares. Suffix: the
    ranges of the signature give a lower bound for the number of n-grams that only one set has.
    """
    need = overlap_needed(F.col("n_a"), F.col("n_b"), percent)
    apart = F.aggregate(
        F.zip_with("signature_a", "signature_b", lambda x, y: F.abs(x.cast("int") - y.cast("int"))),
        F.lit(0), lambda total, x: total + x,
    )
    left = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    return (
        pairs.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
        .where(left >= need)
        .where(apart <= F.col("n_a") + F.col("n_b") - 2 * need)
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
        .distinct()
    )


def largest_partner(n, place, percent=PERCENT):
    """The size of the largest set that can be linked with a set of ``n`` by an n-gram at this place (columns)."""
    by_place = F.floor((n - place) * (100 + percent) / F.lit(percent)) - n
    return F.least(by_place, F.floor(n * 100 / F.lit(percent)))


def size_class(n, percent=PERCENT):
    """A number that grows with the size, so that sizes which can be linked lie SIZE_STEPS apart at most (a column)."""
    return F.floor(F.log(n.cast("double")) * (SIZE_STEPS / np.log(max(100 / percent, 1.01))))


def pieces_of(count):
    return F.ceil(count / F.lit(PIECE)).cast("int")


def copies(pieces):
    """The numbers of the pieces, to be exploded (a column)."""
    return F.sequence(F.lit(0), pieces - 1)


def placed_in_pieces(rows: DataFrame, counts: DataFrame, key, by) -> DataFrame:
    """``rows`` with ``pieces`` and ``piece``: those of a key that has over PIECE of them are dealt by ``by``.

    ``counts`` holds (key, rows). Only keys of many rows are looked up.
    """
    many = durable(counts.where(F.col("rows") > PIECE).select(key, pieces_of(F.col("rows")).alias("pieces")))
    found = rows.join(checked_broadcast(many), key, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    return found.withColumn("piece", F.pmod(F.xxhash64(by), "pieces").cast("int"))


def renamed(lists: DataFrame, name, *more) -> DataFrame:
    return lists.select(*more, *[F.col(c).alias(f"{c}_{name}") for c in ("node", "place", "n", "signature", "component") if c in lists.columns])


def open_pairs(lists: DataFrame, found: DataFrame, percent=PERCENT) -> DataFrame:
    """Entries of one list that lie in different groups and whose sizes and places leave a link possible, the smaller set as a."""
    grouped = lists.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    most = largest_partner(F.col("n"), F.col("place"), percent)
    grouped = grouped.withColumn("most", most).withColumn("small", F.col("most") >= F.col("n"))
    mixed = grouped.groupBy("ngram").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.first("pieces").alias("pieces"),
        F.sum(F.col("small").cast("long")).alias("smaller"),
    )
    mixed = mixed.where((F.col("low") < F.col("high")) & (F.col("smaller") > 0))
    mixed = mixed.select("ngram", F.explode(copies(F.col("pieces"))).alias("piece"), pieces_of(F.col("smaller")).alias("blocks"))
    still = durable(grouped.drop("pieces").join(mixed, ["ngram", "piece"]))

    small = still.where("small").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    reach = F.explode(F.sequence(size_class(F.col("n"), percent), size_class(F.col("most"), percent))).alias("sizes")
    left = renamed(small, "a", "ngram", "block", F.col("most").alias("most_a"), reach)
    large = still.withColumn("block", F.explode(copies(F.col("blocks"))))
    right = renamed(large, "b", "ngram", "block", F.col("most").alias("most_b"), size_class(F.col("n"), percent).alias("sizes"))
    fits = (F.col("n_b") <= F.col("most_a")) & (F.col("n_a") <= F.col("most_b"))
    fits &= (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("node_a") < F.col("node_b")))
    return left.join(right, ["ngram", "block", "sizes"]).where(fits & (F.col("component_a") != F.col("component_b")))


def verify(pairs: DataFrame, docs: DataFrame, size=WORDS, percent=PERCENT) -> DataFrame:
    """The pairs with their whole sets compared: (a, b, linked).

    Sets are made anew from the texts of the nodes concerned. Of a pair, the node of more pairs is
    its hub and the other one's set travels. A hub's set comes first in order, so it is sent once for
    each of its pieces.
    """
    needed = durable(pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("rows")))
    texts = docs.join(checked_broadcast(needed.select("node")), "node", "left_semi")

    def sets(batches):
        known = WordHashes()
        for batch in batches:
            found = [shingles(t, known, size).tobytes() for t in texts_of(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], names=["node", "grams"])

    grams = durable(texts.select("node", "text").mapInArrow(sets, "node long, grams binary"))
    busy = checked_broadcast(durable(needed.where(F.col("rows") > PIECE)))
    for end in ("a", "b"):
        pairs = pairs.join(busy.select(F.col("node").alias(end), F.col("rows").alias(f"of_{end}")), end, "left")
    turned = F.coalesce("of_b", F.lit(0)) > F.coalesce("of_a", F.lit(0))
    hubs = pairs.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("hub"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("node"))
    dealt = durable(placed_in_pieces(hubs, hubs.groupBy("hub").agg(F.count(F.lit(1)).alias("rows")), "hub", "node"))
    travelling = dealt.join(grams, "node").select("hub", "piece", "node", "grams")
    first = dealt.groupBy("hub").agg(F.first("pieces").alias("pieces")).join(grams.withColumnRenamed("node", "hub"), "hub")
    first = first.select("hub", F.explode(copies(F.col("pieces"))).alias("piece"), F.lit(None).cast("long").alias("node"), "grams")

    def compare(batches):
        place, own = None, None
        for batch in batches:
            hubs, pieces, nodes, grams = (batch.column(c) for c in ("hub", "piece", "node", "grams"))
            out = []
            for k in range(batch.num_rows):
                values, here = np.frombuffer(grams[k].as_py(), dtype="<u8"), (hubs[k].as_py(), pieces[k].as_py())
                if not nodes[k].is_valid:
                    place, own = here, values
                    continue
                assert here == place
                hub, node = here[0], nodes[k].as_py()
                shared = len(own) + len(values) - len(np.union1d(own, values))
                out.append((min(hub, node), max(hub, node), shared * 100 >= percent * (len(own) + len(values) - shared)))
            columns = list(zip(*out)) if out else [[], [], []]
            types = (pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["a", "b", "linked"])

    rows = travelling.unionByName(first).repartition("hub", "piece")
    ordered = rows.sortWithinPartitions("hub", "piece", F.col("node").asc_nulls_first())
    return durable(ordered.mapInArrow(compare, "a long, b long, linked boolean"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): for every linked node the smallest node it can reach.

    Labels pass along links and then jump to their label's label; every round is written, so
    lineage stays short.
    """
    edges = durable(links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e")).select("e.*"))
    labels = durable(edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")))
    for _ in range(MAX_ROUNDS):
        offered = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("offer"))
        met = labels.join(offered, "node").select("node", F.col("component").alias("before"), F.least("component", "offer").alias("near"))
        jumps = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
        moved = durable(met.join(jumps, "near", "left").select("node", "before", F.least("near", F.coalesce("far", "near")).alias("component")))
        labels = moved.select("node", "component")
        if moved.where(F.col("before") != F.col("component")).isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def joined(docs: DataFrame, size=WORDS, percent=PERCENT, hot=HOT_LIST) -> DataFrame:
    """(node, n_shingles, component) for documents (node, text) whose nodes are distinct and not null."""
    small_batches(docs.sparkSession)
    described = durable(describe(docs, size))
    sets = described.where(F.col("part").isNull()).drop("part", "counts")
    classes = sets.where("n_shingles > 0").groupBy("n_shingles", "digest").agg(F.min("node").alias("class"), F.first("signature").alias("signature"))
    classes = durable(classes)  # else the join reuses its partitions, and a set that many documents have can't be split
    members = sets.select("node", "n_shingles", "digest").join(classes, ["n_shingles", "digest"], "left")
    members = durable(members.select("node", "n_shingles", F.coalesce("class", "node").alias("class"), "signature"))

    grades, lowest = rarity(described, hot)
    entries = durable(prefixes(docs, grades, lowest, size, percent))
    known = members.select(F.col("node").alias("member"), F.col("class").alias("node"), F.col("n_shingles").alias("n"), "signature")
    placed = durable(entries.join(known, "member").groupBy("ngram", "node").agg(*[F.first(c).alias(c) for c in ("place", "n", "signature")]))
    heads = placed.groupBy("ngram").agg(F.min(F.struct("place", "node")).alias("head"), F.count(F.lit(1)).alias("rows"))
    heads = durable(heads.where("rows > 1"))
    every = heads.select("ngram", F.col("head.node").alias("head"), F.explode(copies(pieces_of(F.col("rows")))).alias("piece"))
    lists = durable(placed_in_pieces(placed, heads, "ngram", "node").join(every, ["ngram", "piece"]))

    first = lists.where(F.col("node") == F.col("head")).drop("piece").withColumn("piece", F.explode(copies(F.col("pieces"))))
    rest = lists.where(F.col("node") != F.col("head"))
    with_head = renamed(first, "a", "ngram", "piece").join(renamed(rest, "b", "ngram", "piece"), ["ngram", "piece"])
    tried = verify(durable(candidates(with_head, percent)), docs, size, percent)
    found = components(tried.where("linked"))

    pairs = open_pairs(lists, found, percent)
    fresh = durable(candidates(pairs, percent).join(tried.select("a", "b"), ["a", "b"], "left_anti"))
    late = verify(fresh, docs, size, percent)
    links = tried.where("linked").unionByName(late.where("linked")).select("a", "b")
    final = components(links).withColumnRenamed("node", "class")
    return members.join(final, "class", "left").select("node", "n_shingles", F.coalesce("component", "class").alias("component"))


def similarity_groups(docs: DataFrame, key="doc_id", text="text", size=WORDS, percent=PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) of every row; component_id is the smallest key reachable by links.

    A-Z are lowered and words are what stands between ASCII white space. Null and empty texts have
    no n-grams and are linked with nothing. If keys are null or stand in several rows, every row
    is a document of its own under a number, and component_id is the smallest key of its group
    (null if the group has none). No rows give no rows; other columns are not carried.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("node"), F.col(f"`{text}`").alias("text"))
    counts = rows.groupBy("node").agg(F.count(F.lit(1)).alias("rows"))
    if counts.where(F.col("node").isNull() | (F.col("rows") > 1)).isEmpty():
        return joined(rows, size, percent).select(F.col("node").alias(key), "n_shingles", F.col("component").alias("component_id"))
    number = free_name(rows, "number")
    landed = durable(rows.select(F.monotonically_increasing_id().alias(number), F.col("node").alias("key"), "text"))
    found = joined(landed.select(F.col(number).alias("node"), "text"), size, percent)
    placed = found.join(landed.select(F.col(number).alias("node"), "key"), "node")
    names = placed.groupBy("component").agg(F.min("key").alias("component_id"))
    return placed.join(names, "component").select(F.col("key").alias(key), "n_shingles", "component_id")


def one_of_each(docs: DataFrame, key="doc_id", text="text", size=WORDS, percent=PERCENT) -> DataFrame:
    """The documents whose key is the smallest of their group, with the columns they came with.

    Of rows that share that key, one stays; groups without a key keep one row, too.
    """
    names = docs.columns
    number = free_name(docs, "_number")
    landed = durable(docs.withColumn(number, F.monotonically_increasing_id()))
    rows = landed.select(F.col(number).alias("node"), F.col(f"`{text}`").alias("text"))
    found = joined(rows, size, percent).join(landed.select(F.col(number).alias("node"), F.col(f"`{key}`").cast("long").alias("key")), "node")
    best = found.groupBy("component").agg(F.min(F.struct(F.col("key").isNull(), "key", "node")).alias("best"))
    gone = found.join(best, "component").where(F.col("node") != F.col("best.node")).select(F.col("node").alias(number))
    return landed.join(checked_broadcast(durable(gone)), number, "left_anti").select(*[f"`{c}`" for c in names])
