"""The trie of conversation prefixes: who shares a beginning, and what sharing it would save.

Distinct turns (role and text) get ids from a dictionary, so a conversation is a list of ids.
Equal lists are one row with a count. The lists are sorted by range into shards; in its task each
shard becomes a ternary search tree, filled from its middle list outwards so that it is balanced,
and one walk over its nodes, last made first, sums up members, leaves and savings.

Nodes on the path of a shard's first or last list may go on in the next shard. Those alone leave
the task unfinished and are merged in one pass in the order of the shards, which holds one path
at a time and reads two paths a shard.

Conversations are worked on in bands of ``band`` turns, so neither a list nor a path grows with
the length of a conversation. The lists of a later band begin with the prefix they continue, and
bands are summed up from the deepest. A conversation that shares its prefix with no other needs no
further band: the rest of its path is plain rows.
"""

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.operators.history import Ordinal, with_history
from paceline.session import durable

#: Turns of a band, and ids of a shard: a task holds the lists and the tree of one shard.
BAND = 4_096
SHARD_TURNS, SMALL_SHARD = 250_000, 2_000
SEQUENCE = "start long, ids array<long>, words array<long>, n long, low long, n_end long, end_low long, more_children long, more_leaves long, more_saved long"
MORE = ["more_children", "more_leaves", "more_saved"]
SUMS = ["n", "low", "children", "leaves", "saved", "n_end", "end_low"]
NODE = ["shard", "side", "place", "letter", "words", *SUMS, "parent_low"]
MERGED = ["shard", "side", "place", "letter", "number", "parent", *SUMS]
NO_ENDS = hashlib.sha256(b"").hexdigest()
OUTPUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def coded_turns(turns: DataFrame, conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """(conv, pos, digest, words): the turns of each conversation numbered from 1.

    Null turns come first; rows of one turn follow each other by the SHA-256 of role and text, in
    which null counts as empty. Rows without a conversation are in none and are left out. A
    conversation of very many turns is numbered in ranges.
    """
    said, by = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (text, role))
    rows = turns.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").isNotNull().alias("known"), F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(by).cast("string"), F.lit(":"), by, said), 256)).alias("digest"),
        F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    placed = with_history(rows, ["conv"], ["known", "turn", "digest"], [Ordinal("pos")])
    return placed.select("conv", F.col("pos").cast("long").alias("pos"), "digest", "words")


class Shard:
    """A ternary search tree over sorted lists of ids; ``up`` names the node of the prefix one id shorter."""

    def __init__(self, rows, starts_are_low):
        self.letter, self.words, self.place, self.up = [], [], [], []
        self.less, self.more, self.below = [], [], []
        self.n, self.low, self.children, self.leaves, self.saved, self.n_end, self.end_low = ([] for _ in SUMS)
        self.starts_are_low, self.root = starts_are_low, -1
        todo = [(0, len(rows))]
        while todo:
            first, last = todo.pop()
            if first < last:
                middle = (first + last) // 2
                self.insert(rows[middle])
                todo += [(first, middle), (middle + 1, last)]
        self.first = self.path(rows[0])
        stem = set(self.first)
        self.last = [k for k in self.path(rows[-1]) if k not in stem]

    def step(self, parent, letter):
        """(node of the letter after the parent or -1, the last node compared with or -1)."""
        before, node = -1, self.root if parent < 0 else self.below[parent]
        while node >= 0 and self.letter[node] != letter:
            before, node = node, self.more[node] if letter > self.letter[node] else self.less[node]
        return node, before

    def insert(self, row):
        parent = -1
        for place, (letter, words) in enumerate(zip([row["start"], *row["ids"]], [0, *row["words"]])):
            node, before = self.step(parent, letter)
            if node < 0:
                node = self.make(parent, letter, words, place)
                if before >= 0:
                    (self.more if letter > self.letter[before] else self.less)[before] = node
                elif parent >= 0:
                    self.below[parent] = node
                else:
                    self.root = node
            parent = node
        self.n[parent], self.n_end[parent], self.end_low[parent] = row["n"], row["n_end"], row["end_low"]
        self.low[parent] = least(self.low[parent], row["low"])
        self.children[parent], self.leaves[parent], self.saved[parent] = (row[c] for c in MORE)

    def make(self, parent, letter, words, place):
        low = letter if place == 0 and self.starts_are_low else None
        new = (letter, words, place, parent, -1, -1, -1, 0, low, 0, 0, 0, 0, None)
        columns = (
            self.letter, self.words, self.place, self.up, self.less, self.more, self.below,
            self.n, self.low, self.children, self.leaves, self.saved, self.n_end, self.end_low,
        )
        for column, value in zip(columns, new):
            column.append(value)
        return len(self.letter) - 1

    def path(self, row):
        nodes, parent = [], -1
        for letter in [row["start"], *row["ids"]]:
            parent = self.step(parent, letter)[0]
            nodes.append(parent)
        return nodes

    def nodes(self, shard):
        """Rows of NODE. Nodes on the first path have side 0, on the last side 1: what is said of them leaves other such nodes out.

        A finished node has no side, unless its parent is on a path: then the parent's.
        """
        side = {**dict.fromkeys(self.last, 1), **dict.fromkeys(self.first, 0)}
        for k in reversed(range(len(self.up))):
            up = self.up[k]
            if k not in side:
                self.leaves[k] = self.leaves[k] if self.children[k] else 1
                self.saved[k] += (self.n[k] - 1) * self.words[k]
            if up < 0:
                continue
            self.n[up] += self.n[k]
            self.low[up] = least(self.low[up], self.low[k])
            if k not in side:
                self.children[up] += 1
                self.leaves[up] += self.leaves[k]
                self.saved[up] += self.saved[k]
        for k, up in enumerate(self.up):
            on_path = k in side
            sums = (x[k] for x in (self.n, self.low, self.children, self.leaves, self.saved, self.n_end, self.end_low))
            parent_low = self.low[up] if up >= 0 and not on_path and up not in side else None
            parent_side = side[up] if up in side and not on_path else None
            yield (shard, side[k] if on_path else parent_side, self.place[k], self.letter[k], self.words[k] if on_path else None, *sums, parent_low)


def least(a, b):
    return b if a is None else a if b is None else min(a, b)


def as_batches(rows, names, size=20_000):
    """Arrow batches of longs out of tuples."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=names)


def longs(names):
    return ", ".join(f"{n} long" for n in names)


def local_tries(classes: DataFrame, shards: int, starts_are_low: bool) -> DataFrame:
    """The nodes of every shard; unfinished ones have ``words``."""

    def work(batches):
        from pyspark import TaskContext

        rows = [row for batch in batches for row in batch.to_pylist()]
        if rows:
            yield from as_batches(Shard(rows, starts_are_low).nodes(TaskContext.get().partitionId()), NODE)

    names = [c.split()[0] for c in SEQUENCE.replace("array<long>", "a").split(", ")]
    ordered = classes.select(*names).repartitionByRange(shards, "start", "ids").sortWithinPartitions("start", "ids")
    return durable(ordered.mapInArrow(work, longs(NODE)))


def merged_paths(nodes: DataFrame) -> DataFrame:
    """The nodes on paths, finished: rows with a ``number`` are nodes, the others say which node a shard's place is.

    One task goes through the shards in order with the path it is on; it reads at most two paths
    of ``band`` nodes a shard.
    """

    def work(batches):
        yield from as_batches(merge(row for batch in batches for row in batch.to_pylist()), MERGED)

    unfinished = nodes.where(F.col("words").isNotNull())
    return durable(unfinished.repartition(1).sortWithinPartitions("shard", "side", "place").mapInArrow(work, longs(MERGED)))


def merge(rows):
    """Rows of MERGED out of unfinished nodes by shard, side and place."""
    path, made = [], 0

    def close(depth):
        while len(path) > depth:
            node = path.pop()
            node["leaves"] = node["leaves"] if node["children"] else 1
            node["saved"] += (node["n"] - 1) * node["words"]
            if path:
                path[-1]["leaves"] += node["leaves"]
                path[-1]["saved"] += node["saved"]
            yield (None, None, node["place"], node["letter"], node["number"], node["parent"], *(node[c] for c in SUMS))

    for _, own in groupby(rows, key=lambda r: (r["shard"], r["side"])):
        joining = True
        for row in own:
            place = row["place"]
            joining = joining and row["side"] == 0 and place < len(path) and path[place]["letter"] == row["letter"]
            if joining:
                node = path[place]
                for c in ("n", "children", "leaves", "saved", "n_end"):
                    node[c] += row[c]
                for c in ("low", "end_low"):
                    node[c] = least(node[c], row[c])
            else:
                yield from close(place)
                if path:
                    path[-1]["children"] += 1
                path.append({**row, "number": made, "parent": path[-1]["number"] if path else None})
                made += 1
            yield (row["shard"], row["side"], place, None, path[place]["number"], None, *(None for _ in SUMS))
    yield from close(0)


def finished_nodes(classes: DataFrame, letters: int, starts_are_low: bool) -> DataFrame:
    """(place, letter, n, low, children, leaves, saved, n_end, end_low, parent_low) of every node of a band."""
    room = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-letters // SHARD_TURNS), min(room, letters // SMALL_SHARD))
    nodes = local_tries(classes, shards, starts_are_low)
    merged = merged_paths(nodes)
    columns = ["place", "letter", *SUMS]
    whole = merged.where(F.col("n").isNotNull())
    lows = whole.select("number", F.col("low").alias("parent_low"))
    on_paths = whole.join(lows.withColumnRenamed("number", "parent"), "parent", "left").select(*columns, "parent_low")
    at = merged.where(F.col("n").isNull()).select("shard", "side", (F.col("place") + 1).alias("place"), "number").join(lows, "number").drop("number")
    inner = nodes.where(F.col("words").isNull())
    inside = inner.where(F.col("side").isNull()).select(*columns, "parent_low")
    beside = inner.where(F.col("side").isNotNull()).drop("parent_low").join(at, ["shard", "side", "place"]).select(*columns, "parent_low")
    return durable(inside.unionByName(beside).unionByName(on_paths))


def ends(members: DataFrame) -> DataFrame:
    """(class, ends_sha256) of (class, conv) rows: the conversations in ascending order, comma-joined.

    A digest is sequential, so a class is read by one task, sorted and as a stream.
    """

    def work(batches):
        current, digest = None, None
        for batch in batches:
            found = []
            for name, rows in groupby(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), key=lambda r: r[0]):
                joined = ",".join(str(r[1]) for r in rows).encode()
                if name == current:
                    digest.update(b"," + joined)
                    continue
                if digest:
                    found.append((current, digest.hexdigest()))
                current, digest = name, hashlib.sha256(joined)
            yield as_pairs(found)
        if digest:
            yield as_pairs([(current, digest.hexdigest())])

    def as_pairs(found):
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], names=["class", "ends_sha256"])

    ordered = members.select("class", "conv").repartition("class").sortWithinPartitions("class", "conv")
    return ordered.mapInArrow(work, "class long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conv="conv_id", turn="turn", role="role", text="text", band=BAND) -> DataFrame:
    """A row for each distinct beginning of conversations; see ``trie_of`` for the columns and ``coded_turns`` for the order.

    No rows give no rows; other columns are not carried.
    """
    return trie_of(coded_turns(turns, conv, turn, role, text), band=band)


def trie_of(placed: DataFrame, conversations: DataFrame | None = None, band=BAND) -> DataFrame:
    """The nodes of the trie of coded turns (conv, pos from 1 without gaps, digest, words).

    A node is a distinct sequence of the first ``depth`` turns; the root has depth 0. Its ``conv_id``
    is the smallest of its members, the ``n_convs`` conversations that begin with it; together with the
    depth it identifies the node, and ``parent_conv_id`` its parent. ``n_leaves`` and ``saved_tokens``
    cover the node's subtree with the node itself: nodes without children, and the words of each
    node's last turn times the members beyond the first. ``ends_sha256`` is the digest of the members
    that end there. ``conversations`` (conv) names those without turns, too.
    """
    placed = durable(placed)
    sizes = placed.groupBy("conv").agg(F.max("pos").alias("size"))
    if conversations is not None:
        sizes = conversations.select("conv").distinct().join(sizes, "conv", "left").fillna(0, ["size"])
    sizes = durable(sizes)
    longest = sizes.agg(F.max("size").alias("longest")).first()["longest"]
    # written, so that a turn which very many conversations have can be cut up in the join
    dictionary = durable(placed.groupBy("digest").agg(F.max("words").alias("words")).withColumn("id", F.monotonically_increasing_id()))
    coded = placed.drop("words").join(dictionary, "digest").select("conv", "pos", "id", "words")
    coded = durable(coded) if (longest or 0) > band else coded

    bands, chains, members, number = [], [], sizes.withColumn("start", F.lit(0).cast("long")), 0
    while True:
        seqs, classes = band_classes(coded, members, number, band)
        upto = (number + 1) * band
        bands.append((seqs, classes))
        if (longest or 0) <= upto:
            break
        alone = classes.where((F.col("n") == 1) & (F.col("n_end") == 0) & (F.size("ids") == band)).select(F.col("low").alias("conv"))
        chains.append(chain(coded.where(F.col("pos") > upto), alone, sizes))
        shared = classes.where("n > 1").select("start", "ids", F.col("low").alias("class"))
        members = seqs.where(F.col("size") > upto).join(shared, ["start", "ids"])
        members = durable(members.select("conv", "size", F.col("class").alias("start")))
        if members.isEmpty():
            break
        number += 1

    out, more = None, None
    for number in reversed(range(len(bands))):
        seqs, classes = bands[number]
        nodes, more = band_nodes(seqs, classes, more, number, band)
        out = nodes if out is None else out.unionByName(nodes)
    for rows in chains:
        out = out.unionByName(rows)
    return out.select(*OUTPUT)


def band_classes(coded, members, number, band):
    """A band's conversations (conv, size, start, ids, words) and their classes of equal (start, ids)."""
    low, upto = number * band, (number + 1) * band
    own = coded.where((F.col("pos") > low) & (F.col("pos") <= upto)).groupBy("conv")
    lists = own.agg(F.sort_array(F.collect_list(F.struct("pos", "id", "words"))).alias("turns"))  # at most ``band`` a group
    none = F.array().cast("array<long>")
    seqs = members.join(lists, "conv", "left").select(
        "conv", "size", "start", F.coalesce("turns.id", none).alias("ids"), F.coalesce("turns.words", none).alias("words")
    )
    seqs = durable(seqs)
    ending = F.col("size") <= upto
    classes = seqs.groupBy("start", "ids").agg(
        F.first("words").alias("words"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("low"),
        F.count(F.when(ending, 1)).alias("n_end"), F.min(F.when(ending, F.col("conv"))).alias("end_low"), F.max("size").alias("size"),
    )
    return seqs, durable(classes)


def chain(coded, alone, sizes):
    """The nodes of conversations (conv) that share no prefix any more."""
    rows = coded.join(alone, "conv", "left_semi").join(sizes, "conv")
    conv, ends_here = F.col("conv"), F.col("pos") == F.col("size")
    one = F.lit(1).cast("long")
    return rows.select(
        conv.alias("conv_id"), F.col("pos").alias("depth"), conv.alias("parent_conv_id"), one.alias("n_convs"),
        F.when(ends_here, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(ends_here, F.sha2(conv.cast("string"), 256)).otherwise(NO_ENDS).alias("ends_sha256"),
    )


def band_nodes(seqs, classes, more, number, band):
    """(the band's nodes as output rows, what they add to the classes of the band before)."""
    upto = (number + 1) * band
    zero = F.lit(0).cast("long")
    if more is None:
        classes = classes.withColumns({c: zero for c in MORE})
    else:
        classes = classes.join(more, "low", "left").fillna(0, MORE)
    alone = (F.col("n") == 1) & (F.col("n_end") == 0)  # goes on as a chain
    classes = classes.withColumns({c: F.when(alone, 1).otherwise(F.col(c)).cast("long") for c in MORE[:2]})
    letters = classes.agg(F.sum(F.size("ids") + 1).alias("letters")).first()["letters"] or 0
    nodes = finished_nodes(classes, letters, starts_are_low=number > 0)

    many = classes.where("n_end > 1").select("start", "ids", F.col("low").alias("class"), F.col("end_low"))
    ending = seqs.where(F.col("size") <= upto).join(many, ["start", "ids"]).select(F.col("end_low").alias("class"), "conv")
    digests = durable(ends(ending)).withColumnRenamed("class", "end_low")
    several = nodes.where("n_end > 1").join(digests, "end_low")
    few = nodes.where("n_end <= 1").withColumn("ends_sha256", F.coalesce(F.sha2(F.col("end_low").cast("string"), 256), F.lit(NO_ENDS)))
    rows = few.unionByName(several.select(few.columns))
    depth = (F.col("place") + number * band).alias("depth")
    out = (rows if number == 0 else rows.where("place > 0")).select(
        F.col("low").alias("conv_id"), depth, F.col("parent_low").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256",
    )
    starts = nodes.where("place = 0").select(F.col("letter").alias("low"), *[F.col(c.removeprefix("more_")).alias(c) for c in MORE])
    return out, starts
