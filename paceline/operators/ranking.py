"""Positions within a group: row numbers, dense ranks, scaled ranks, label indexes."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.operators.history import SPREAD, Ordinal, spread_unkeyed, with_history
from paceline.operators.skew import HotGroups, all_present, hot_groups, lookup_side
from paceline.session import durable


def number_rows(df: DataFrame, keys, order, name, hot: HotGroups | None = None) -> DataFrame:
    """Row number from 1 within ``keys`` along ``order``."""
    return with_history(df, keys, order, [Ordinal(name)], hot)


def dense_scaled_rank(df: DataFrame, keys, value, name, fill=0.5, rank_name=None, hot=None) -> DataFrame:
    """Dense rank of ``value`` within ``keys`` divided by the group's largest rank.

    Null values and rows with a null key are not ranked and get ``fill``. With a hot group, or more rows in
    all than a group may have, the distinct (group, value) pairs are ranked instead of the rows, and joined back, so
    no task holds a group of whole rows; the rows are needed twice for that, so they are written once.
    """
    keys = list(keys)
    hot = hot_groups(df, keys) if hot is None else hot
    by_pairs = hot or hot.rows > hot.max_rows
    ranked = _ranked_pairs(durable(df), keys, value) if by_pairs else _ranked_rows(df, keys, value, hot)
    scaled = F.coalesce(F.col("_rank").cast("double") / F.col("_top"), F.lit(float(fill)))
    out = ranked.withColumn(name, scaled)
    if rank_name:
        out = out.withColumn(rank_name, F.col("_rank"))
    return out.drop("_rank", "_top")


def _ranked_rows(df, keys, value, hot):
    df, by = spread_unkeyed(df, keys, hot)
    group = Window.partitionBy(*by)
    ranked = F.dense_rank().over(group.orderBy(F.col(value).asc_nulls_last()))
    ranked = F.when(all_present([*keys, value]), ranked)
    return df.withColumn("_rank", ranked).withColumn("_top", F.max("_rank").over(group)).drop(SPREAD)


def _ranked_pairs(df, keys, value):
    pairs = df.where(all_present([*keys, value])).select(*keys, value).distinct()
    ranked = number_rows(pairs, keys, [value], "_rank")
    tops = ranked.groupBy(*keys).agg(F.max("_rank").alias("_top"))
    # few pairs are broadcast; of many, a value that many rows share is a skewed key, which the adaptive join splits
    ranked = lookup_side(ranked.join(lookup_side(tops), keys))
    return df.join(ranked, [*keys, value], "left").select(*df.columns, "_rank", "_top")


def finishing_order(df: DataFrame, race, grid_score, race_score, tie) -> DataFrame:
    """Grid and finishing places per race, and the places gained between them."""
    hot = hot_groups(df, race)
    placed = number_rows(df, race, [grid_score, tie], "Grid", hot)
    placed = number_rows(placed, race, [race_score, tie], "Pos", hot)
    return placed.withColumn("Delta", F.col("Grid") - F.col("Pos"))


def label_index(df: DataFrame, column, name) -> DataFrame:
    """(column, name): the sorted distinct texts of a column numbered from 0.

    A null counts as the text ``None``, as any other label.
    """
    labels = df.select(as_label(column).alias(column)).distinct()
    return number_rows(labels, [], [column], name).withColumn(name, (F.col(name) - 1).cast("int"))


def label_index_by_cutoff(df: DataFrame, column, name, season, cutoffs) -> DataFrame:
    """(column, season, name): for each of ``cutoffs`` the labels seen in earlier seasons, numbered as ``label_index`` does.

    The rows are read once: a label counts from the season after its first one.
    """
    labels = df.where(F.col(season).isNotNull()).groupBy(as_label(column).alias(column)).agg(F.min(season).alias("_first"))
    asked = F.array(*[F.lit(c) for c in sorted(cutoffs)]).cast("array<int>")
    known = labels.withColumn(season, F.explode(F.filter(asked, lambda c: c > F.col("_first")))).drop("_first")
    return number_rows(known, [season], [column], name).withColumn(name, (F.col(name) - 1).cast("int"))


def label_side(labels: DataFrame, column, name) -> DataFrame:
    """The labels as the looked-up side of a join, broadcast if there are few."""
    return lookup_side(labels.withColumnRenamed(column, "_label"))


def as_label(column):
    return F.coalesce(F.col(column).cast("string"), F.lit("None"))


def encode_labels(df: DataFrame, labels: DataFrame, column, name, unknown=None, within=()) -> DataFrame:
    """Attach label numbers; unknown labels drop the row, or take ``unknown``.

    ``labels`` is a table of ``label_index``, or a ``label_side`` used several times. Columns
    ``within`` are the same on both sides, as the cutoffs of ``label_index_by_cutoff`` are.
    """
    side = labels if "_label" in labels.columns else label_side(labels, column, name)
    df, on = df.withColumn("_label", as_label(column)), ["_label", *within]
    joined = df.join(side, on, "inner" if unknown is None else "left").select(*df.columns, name)
    if unknown is not None:
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(unknown)))
    return joined.drop("_label")
