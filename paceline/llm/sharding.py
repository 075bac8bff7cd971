"""Reproducible shuffles and shards by a permutation of global row numbers.

Every row gets its place in a total order, a Feistel network permutes the places, and
shard and slot follow from the permuted place by division. Nothing but the row number is
needed to say where a row went, so a reader can compute it without any table.
"""

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paceline.llm.batches import free_name, without
from paceline.session import durable

#: How many widths are tried for the domain that exceeds the row count least.
WIDTHS = 4096
PARTITION_BITS = 33


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of 0 .. rows-1.

    The Feistel network works on ``width * height`` >= rows values (halves of unequal size,
    as in the generalised construction); values beyond the last row are walked on along
    their cycle until they fall on a row. A walk cannot meet more values than the domain
    has beyond ``rows``, which bounds it.
    """

    rows: int
    seed: int = 0
    rounds: int = 6
    width: int = 0
    height: int = 0

    @classmethod
    def of(cls, rows, seed=0, rounds=6):
        rows = max(1, rows)
        start = math.isqrt(rows - 1) + 1
        width = min(range(start, start + WIDTHS), key=lambda w: (-rows % w, w))
        return cls(rows, seed, rounds, width, -(-rows // width))

    @property
    def excess(self):
        return self.width * self.height - self.rows

    def step(self, value):
        """One pass of a value (a column) through the network."""
        width, height = F.lit(self.width).cast("long"), F.lit(self.height).cast("long")
        left = value % width
        right = ((value - left) / width).cast("long")  # exact: a multiple, and row numbers stay far below 2 ** 53
        for number in range(self.rounds):
            size = width if number % 2 == 0 else height
            mixed = F.xxhash64(F.lit(self.seed).cast("long"), F.lit(number).cast("long"), right)
            left, right = right, (left + F.pmod(mixed, size)) % size
        if self.rounds % 2:
            left, right = right, left
        return right * width + left

    def place(self, number):
        """The permuted place of a row number (a column)."""
        first = self.step(number)
        if not self.excess:
            return first
        walked = F.aggregate(
            F.sequence(F.lit(1), F.lit(self.excess)),
            first,
            lambda value, _: F.when(value < self.rows, value).otherwise(self.step(value)),
        )
        return F.when(first < self.rows, first).otherwise(walked)


def numbered(df: DataFrame, order, column="row_number") -> DataFrame:
    """Gapless numbers from 0 in the order of the columns, nulls first.

    Rows that are equal in these columns go by a hash of the whole row and then by where
    they were read, so one hot key is cut into as many ranges as it needs. The sorted rows
    are written once: range bounds come from a sample, and no later failure may move them.
    What is joined back is one count for each range.
    """
    df = without(df, [column])
    read, place = free_name(df, "_read"), free_name(df, "_place")
    by = [*[F.col(f"`{c}`") for c in order], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col(read)]
    sorted_rows = df.withColumn(read, F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    rows = durable(sorted_rows.drop(read).withColumn(place, F.monotonically_increasing_id()))
    piece = F.shiftright(place, PARTITION_BITS)
    counts = rows.groupBy(piece.alias("_piece")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(W.orderBy("_piece").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("_piece", F.coalesce(before, F.lit(0)).alias("_start"))  # a row for each range
    within = F.col(place).bitwiseAND(F.lit(2**PARTITION_BITS - 1))
    joined = rows.join(F.broadcast(starts), piece == F.col("_piece"))
    return joined.withColumn(column, F.col("_start") + within).drop(place, "_piece", "_start")


def shuffled_shards(df: DataFrame, order, shards: int, seed=0) -> DataFrame:
    """The rows with ``row_number``, ``place`` (the permuted number), ``shard`` and ``slot``.

    Place p goes to shard p mod ``shards`` at slot p div ``shards``: sizes differ by one row
    at most and slots have no gaps. The same rows, seed and shard count give the same
    result on any cluster. Input columns of the four names are replaced; an empty table
    gives an empty one; null keys come first; repeated rows get places of their own.
    Columns must be hashable, so no maps.
    """
    rows = numbered(without(df, ["place", "shard", "slot"]), order)
    return placed(rows, rows.count(), shards, seed)


def placed(rows: DataFrame, total: int, shards: int, seed=0, column="row_number") -> DataFrame:
    """Add place, shard and slot to rows that already carry their number."""
    place = Permutation.of(total, seed).place(F.col(column))
    rows = rows.withColumn("place", place)
    shard = F.col("place") % shards
    slot = ((F.col("place") - shard) / shards).cast("long")
    return rows.withColumn("shard", shard.cast("int")).withColumn("slot", slot)


def write_shards(rows: DataFrame, path: str) -> None:
    """One folder for each shard, its files sorted by slot; a large shard gets several files."""
    by_slot = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    by_slot.write.mode("overwrite").partitionBy("shard").parquet(path)
