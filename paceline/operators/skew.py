"""Finding groups that are too large for one task, and cutting them up.

Aggregates are safe by themselves (Spark combines on the map side), but a window
puts a whole group into one task. Every ordered operator therefore asks
``hot_groups`` first. Usually there are none and the operator is a plain window.
Otherwise only the rows of the hot groups are range-partitioned on (group, order),
which cuts a group into as many consecutive pieces as it needs.
"""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.session import durable

MAX_ROWS_CONF = "spark.paceline.maxGroupRows"
MAX_ROWS = 2_000_000
LOOKUP_ROWS_CONF = "spark.paceline.maxLookupRows"
LOOKUP_ROWS = 200_000
LOOKUP_BYTES = 64 << 20
RANGE = "_range"
MARK = "_hot"


def max_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_ROWS_CONF, str(MAX_ROWS)))


def all_present(columns):
    """True where none of the columns is null."""
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return present


@dataclass(frozen=True)
class HotGroups:
    """The groups with more than ``max_rows`` rows; ``table`` holds their keys.

    ``rows`` counts the whole input, ``total`` the rows of hot groups, ``unkeyed`` the
    rows with a null key, which belong to no group.
    """

    keys: tuple
    max_rows: int
    rows: int = 0
    total: int = 0
    unkeyed: int = 0
    table: DataFrame | None = None

    def __bool__(self):
        return self.total > 0

    @property
    def many_unkeyed(self) -> bool:
        return self.unkeyed > self.max_rows

    @property
    def pieces(self) -> int:
        """Ranges that keep a piece near half of ``max_rows``."""
        return max(2, -(-2 * self.total // self.max_rows))

    def within(self, *keys):
        """The same hot groups for finer keys, for a marked frame."""
        return replace(self, keys=(*self.keys, *keys))

    def mark(self, df: DataFrame) -> DataFrame:
        """Divide once for several steps: each part carries a constant mark.

        Later steps filter on the mark. In the ordinary part it is a constant that
        Spark folds, so a step does not compute one part to find the other.
        """
        if not self or not self.keys or MARK in df.columns:
            return df
        ordinary, huge = self.divide(df)
        return ordinary.withColumn(MARK, F.lit(False)).unionByName(durable(huge.withColumn(MARK, F.lit(True))))

    def divide(self, df: DataFrame):
        """(rows of ordinary groups, rows of hot groups)."""
        if not self.keys:
            return None, df
        if MARK in df.columns:
            return df.where(~F.col(MARK)), df.where(MARK)
        hot = F.broadcast(self.table)
        on = list(self.keys)
        return tuple(df.join(hot, on, how).select(df.columns) for how in ("left_anti", "left_semi"))


def hot_groups(df: DataFrame, keys, max_rows=None) -> HotGroups:
    """One narrow aggregate over the key columns.

    At most ``rows / max_rows`` groups can be hot, which bounds what reaches the
    driver and what is broadcast. Groups with a null key are never hot: the
    operators do not treat them as groups.
    """
    spark = df.sparkSession
    max_rows = max_rows or max_group_rows(spark)
    keys = list(keys)
    if not keys:
        rows = df.count()
        return HotGroups((), max_rows, rows, rows if rows > max_rows else 0)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    keyed = all_present(keys)
    summary = sizes.agg(
        F.sum("_rows").alias("rows"),
        F.max(F.when(keyed, F.col("_rows"))).alias("largest"),
        F.sum(F.when(~keyed, F.col("_rows"))).alias("unkeyed"),
    ).first()
    found = HotGroups(tuple(keys), max_rows, summary["rows"] or 0, unkeyed=summary["unkeyed"] or 0)
    if (summary["largest"] or 0) <= max_rows:
        return found
    big = sizes.where(keyed & (F.col("_rows") > max_rows))
    hot = big.collect()
    table = spark.createDataFrame(hot, big.schema).select(*keys)
    return replace(found, total=sum(r["_rows"] for r in hot), table=table)


def hot_groups_of_each(df: DataFrame, *columns, max_rows=None) -> list:
    """The hot groups of several single columns, from one pass over the table."""
    spark = df.sparkSession
    max_rows = max_rows or max_group_rows(spark)
    sizes = df.groupingSets([[c] for c in columns], *columns).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows")
    )
    # of all columns but the set's own the bit is 1, the first column having the highest one
    every = 2 ** len(columns) - 1
    of = {c: every - 2 ** (len(columns) - 1 - k) for k, c in enumerate(columns)}
    value = F.coalesce(*[F.when(F.col("_set") == s, F.col(c).isNotNull()) for c, s in of.items()])
    summary = sizes.groupBy("_set").agg(
        F.sum("_rows").alias("rows"),
        F.max(F.when(value, F.col("_rows"))).alias("largest"),
        F.sum(F.when(~value, F.col("_rows"))).alias("unkeyed"),
    )
    by_set = {r["_set"]: r for r in summary.collect()}
    out = []
    for c, number in of.items():
        r = by_set.get(number)
        if r and (r["largest"] or 0) > max_rows:
            out.append(hot_groups(df, [c], max_rows))
        else:
            out.append(HotGroups((c,), max_rows, r["rows"] if r else 0, unkeyed=(r["unkeyed"] or 0) if r else 0))
    return out


def in_ranges(df: DataFrame, keys, order, hot: HotGroups) -> DataFrame:
    """Number consecutive pieces of the rows sorted by (keys, order).

    Range bounds come from a sample, so the numbered rows are made durable before
    anything is derived from the numbers.
    """
    by = [F.col(c).asc_nulls_last() for c in [*keys, *order]]
    ranged = df.repartitionByRange(hot.pieces, *by)
    return durable(ranged.withColumn(RANGE, F.spark_partition_id()))


def lookup_side(table: DataFrame, max_rows=None):
    """The table as a broadcast side if it has at most ``max_rows`` rows and LOOKUP_BYTES of values.

    It is written once, and its size is taken from what was written. A larger table comes
    back unhinted, for an ordinary (adaptive) join.
    """
    spark = table.sparkSession
    max_rows = max_rows or int(spark.conf.get(LOOKUP_ROWS_CONF, str(LOOKUP_ROWS)))
    stored = durable(table)
    size = sum(F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in stored.columns)
    found = stored.agg(F.count(F.lit(1)).alias("rows"), F.sum(size.cast("long")).alias("bytes")).first()
    small = found["rows"] <= max_rows and (found["bytes"] or 0) <= LOOKUP_BYTES
    return F.broadcast(stored) if small else stored
