"""One entity holds a third of all rows: results must equal the plain ones, in small pieces."""

import pytest
from pyspark.sql import functions as F

from paceline.operators import skew
from paceline.operators.grouped import fill_group_median, global_medians, group_median
from paceline.operators.history import Career, Carried, Ordinal, Previous, Recent, RunningSum, with_history
from paceline.operators.joins import as_of_previous, attach
from paceline.operators.laps import timing_features
from paceline.operators.ranking import dense_scaled_rank, encode_labels, finishing_order, label_index
from paceline.operators.skew import MAX_ROWS_CONF, RANGE, hot_groups, in_ranges
from tests.helpers import rows

ORDER = ["season", "seq"]


@pytest.fixture(scope="module")
def skewed(spark):
    """300 rows, 100 of them of one entity, 20 without any; the orders repeat across entities."""
    n = F.col("id")
    entity = F.when(n % 3 == 0, "hot").when(n % 15 == 1, None).otherwise(F.concat(F.lit("e"), (n % 11).cast("string")))
    df = spark.range(300).select(
        entity.alias("entity"),
        (2000 + n % 4).cast("int").alias("season"),
        (n * 7919 % 1009).cast("int").alias("seq"),
        F.when(n % 5 != 0, (n * 31 % 17).cast("double")).alias("v"),
        F.when(n % 4 != 0, F.concat(F.lit("c"), (n % 3 + n % 2).cast("string"))).alias("c"),
        (n % 2).cast("int").alias("circuit"),
    )
    return df.cache()


def both(spark, limit, compute):
    """The result without and with hot groups."""
    plain = rows(compute())
    spark.conf.set(MAX_ROWS_CONF, str(limit))
    try:
        return plain, rows(compute())
    finally:
        spark.conf.unset(MAX_ROWS_CONF)


FEATURES = [
    Recent("recent", "v", 3),
    Recent("recent5", "v", 5, 13.0),
    Career("career", "v"),
    Previous("last", "c"),
    Carried("carried", "c", ("season", "seq")),
    Carried("before", "c", ("season", "seq"), own=False),
    Ordinal("place"),
]


def test_hot_groups_of_several_keys(spark, skewed):
    """One pass finds what a pass per key finds."""
    for limit in (4, 60, 1000):
        for column, found in zip(("entity", "season"), skew.hot_groups_of_each(skewed, "entity", "season", max_rows=limit)):
            own = hot_groups(skewed, [column], limit)
            assert (found.keys, found.rows, found.total, found.unkeyed) == (own.keys, own.rows, own.total, own.unkeyed)


@pytest.mark.parametrize("limit", [4, 60])
@pytest.mark.parametrize("keys", [["entity"], ["entity", "circuit"], []])
def test_history(spark, skewed, keys, limit):
    plain, split = both(spark, limit, lambda: with_history(skewed, keys, [*ORDER, "v", "c"], FEATURES))
    assert split == plain and len(split) == 300


def test_running_sum(spark, skewed):
    df = skewed.where("v is not null")
    plain, split = both(spark, 9, lambda: with_history(df, ["entity"], [*ORDER, "v"], [RunningSum("below", "v")]))
    assert split == plain


def test_pieces_are_small(spark, skewed, small_groups):
    hot = hot_groups(skewed, ["entity"])
    assert hot.total >= 100 and hot.rows == 300 and hot.unkeyed > 0
    _, huge = hot.divide(skewed)
    sizes = in_ranges(huge, ["entity"], ORDER, hot).groupBy("entity", RANGE).count()
    assert sizes.where("entity = 'hot'").count() > 4
    assert sizes.agg(F.max("count")).first()[0] <= 2 * small_groups


def test_only_hot_rows_are_divided(spark, skewed):
    hot = hot_groups(skewed, ["entity"], 90)
    ordinary, huge = hot.divide(skewed)
    assert (ordinary.count(), huge.count(), huge.select("entity").distinct().count()) == (200, 100, 1)


@pytest.mark.parametrize("limit", [10, 30])
def test_ranks(spark, skewed, limit):
    plain, split = both(spark, limit, lambda: dense_scaled_rank(skewed, ["season"], "v", "scaled", rank_name="rank"))
    assert split == plain
    df = skewed.where("entity is not null").withColumn("score", F.coalesce("v", F.lit(99.0)))
    plain, split = both(spark, limit, lambda: finishing_order(df, ["season"], "seq", "score", "seq"))
    assert split == plain


@pytest.mark.parametrize("limit", [3, 12, 60])
def test_medians(spark, skewed, limit):
    plain, split = both(spark, limit, lambda: group_median(skewed, ["entity"], "v", "m"))
    assert split == plain
    plain, split = both(spark, limit, lambda: fill_group_median(skewed, ["entity"], ["v"]))
    assert split == plain
    expected = global_medians(skewed, ["v", "seq"])
    spark.conf.set(MAX_ROWS_CONF, str(limit))
    assert global_medians(skewed, ["v", "seq"]) == expected
    spark.conf.unset(MAX_ROWS_CONF)


def test_even_median_between_values(spark, small_groups):
    df = spark.range(100).select(F.lit("k").alias("k"), F.when(F.col("id") < 50, 1.0).otherwise(4.0).alias("v"))
    assert rows(group_median(df, ["k"], "v", "m")) == [("k", 2.5)]


@pytest.mark.parametrize("limit", [10, 40])
def test_laps(spark, skewed, limit):
    laps = skewed.where("entity is not null").select(
        "entity", "season", "seq", F.col("v").alias("lap"), (F.col("seq") % 7 == 0).alias("pit"),
        (F.col("seq") / 300).cast("int").cast("double").alias("Stint"), F.col("c").alias("Compound"),
    )
    plain, split = both(spark, limit, lambda: timing_features(laps, ["entity"], ("season", "seq")))
    assert split == plain and len(split) > 5


def test_as_of(spark, skewed):
    df = skewed.where("entity is not null")
    plain, split = both(spark, 10, lambda: as_of_previous(df, "entity", ORDER, {"v": 14.0, "c": None}))
    assert split == plain


def test_labels(spark, skewed):
    def encode():
        labels = label_index(skewed, "entity", "n")
        return encode_labels(skewed, labels, "entity", "n")

    plain, split = both(spark, 3, encode)
    assert split == plain
    spark.conf.set(skew.LOOKUP_ROWS_CONF, "2")
    assert rows(encode()) == plain
    spark.conf.unset(skew.LOOKUP_ROWS_CONF)


def test_shared_folder_is_the_named_one(spark):
    from paceline.session import fresh_path, shared_folder

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark).startswith(shared_folder(spark))


def test_rows_without_a_key_are_spread_in_a_join(spark):
    """A tenth of one race's rows have no driver: they match the side's null row, and no task gets them all."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = F.col("id")
        rows_ = spark.range(20_000).select(F.lit(1).alias("race"), F.when(n % 10 != 0, n.cast("string")).alias("driver"), n)
        side = spark.range(0, 20_000, 3).select(F.lit(1).alias("race"), F.when(n != 0, n.cast("string")).alias("driver"), n.alias("lap"))
        joined = attach(rows_, side, ["race", "driver"], ["lap"], null_safe=["driver"])
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("part")).count().collect())
        assert sum(sizes) == 20_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        assert joined.where("driver is null and lap = 0").count() == 2_000
        assert joined.where("driver is not null and lap = id").count() == joined.where("driver is not null and lap is not null").count() == 6_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
