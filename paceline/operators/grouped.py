"""Aggregates per group: medians, guarded correlation, last-wins lookups, distinct rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.operators.history import SPREAD, RunningSum, spread_unkeyed, with_history
from paceline.operators.skew import MARK, HotGroups, all_present, hot_groups, lookup_side, max_group_rows
from paceline.session import durable


def group_median(df: DataFrame, keys, column, name, approx=False, hot: HotGroups | None = None) -> DataFrame:
    """(keys, name): the median of ``column`` per group; no row for an all-null group.

    Exact medians of ordinary groups use Spark's aggregate. A hot group (or the
    whole table, when ``keys`` is empty) is reduced to its value counts first, and
    the middle is found by running totals along the values.
    """
    keys = list(keys)
    marked = [MARK] if MARK in df.columns else []
    present = df.where(F.col(column).isNotNull()).select(*keys, column, *marked)
    if approx:
        return present.groupBy(*keys).agg(F.percentile_approx(column, 0.5, 100_000).alias(name))
    hot = hot_groups(present, keys) if hot is None else hot
    if not hot:
        # a global aggregate yields a row even for no input
        return present.groupBy(*keys).agg(F.median(column).alias(name)).where(F.col(name).isNotNull())
    ordinary, huge = hot.divide(present)
    out = _counted_median(huge, keys, column, name)
    if ordinary is not None:
        out = ordinary.groupBy(*keys).agg(F.median(column).alias(name)).unionByName(out)
    return out


def _counted_median(df, keys, column, name):
    values = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    return _median_of_counts(values, keys, column, name)


def _median_of_counts(values, keys, column, name):
    """The median of each group from its values and how often each occurs (``_n``)."""
    below = with_history(values, keys, [column], [RunningSum("_below", "_n")])
    if keys:
        sizes = values.groupBy(*keys).agg(F.sum("_n").alias("_size"))
        sized = below.join(lookup_side(sizes), keys)
    else:
        sized = below.withColumn("_size", F.lit(values.agg(F.sum("_n").alias("n")).first()["n"] or 0))
    low, high = F.floor((F.col("_size") - 1) / 2), F.floor(F.col("_size") / 2)
    upto = F.col("_below") + F.col("_n")
    holds_low = (F.col("_below") <= low) & (low < upto)
    holds_high = (F.col("_below") <= high) & (high < upto)
    lower, upper = F.max(F.when(holds_low, F.col(column))), F.max(F.when(holds_high, F.col(column)))
    return sized.where(holds_low | holds_high).groupBy(*keys).agg(((lower + upper) / 2).cast("double").alias(name))


def with_group_median(df: DataFrame, keys, columns, hot: HotGroups | None = None, of=None) -> DataFrame:
    """Add, for each ``name: column``, the median of the column over the row's group.

    ``of`` is a condition on the rows that make the medians (say, before a cutoff).
    Rows without a key get no median. Ordinary groups take a window, which shares the
    shuffle of other windows on the keys; a hot group's median is looked up.
    """
    keys = list(keys)
    hot = hot_groups(df, keys) if hot is None else hot
    ordinary, huge = hot.divide(df) if hot else (df, None)
    if huge is not None:
        known = huge if of is None else huge.where(of)
        for name, column in columns.items():
            # one row per hot group, and hot groups are few: the broadcast is bounded
            huge = huge.join(F.broadcast(group_median(known, keys, column, name, hot=hot)), keys, "left")
        huge = huge.select(*df.columns, *columns)
    ordinary, by = spread_unkeyed(ordinary, keys, hot)
    keyed, group = all_present(keys), Window.partitionBy(*by)
    used = {n: F.col(c) if of is None else F.when(of, F.col(c)) for n, c in columns.items()}
    ordinary = ordinary.withColumns({n: F.when(keyed, F.median(c).over(group)) for n, c in used.items()}).drop(SPREAD)
    return ordinary if huge is None else ordinary.unionByName(huge)


def fill_group_median(df: DataFrame, keys, columns, hot: HotGroups | None = None, of=None) -> DataFrame:
    """Fill nulls with the group's own median; an all-null group stays null."""
    names = {f"_median_{c}": c for c in columns}
    filled = {c: F.coalesce(c, name) for name, c in names.items()}
    return with_group_median(df, keys, names, hot, of).withColumns(filled).drop(*names)


def fill_global_median(df: DataFrame, columns, otherwise=0.0, of: DataFrame | None = None, rows=None) -> DataFrame:
    """Fill nulls with the whole table's median, or ``otherwise`` if it has none.

    ``of`` names another table to take the medians from (say, rows before a cutoff);
    ``rows`` is the number of rows, where the caller knows it.
    """
    medians = global_medians(df if of is None else of, columns, rows=rows)
    return df.withColumns({c: F.coalesce(c, F.lit(otherwise if m is None else m)) for c, m in medians.items()})


def global_medians(df: DataFrame, columns, approx=False, rows=None) -> dict:
    """Column to its median over the whole table (None without values).

    Tables small enough for one task take one aggregate for all columns. Larger ones
    are reduced to the value counts of all columns in one pass, which are written; all else works on these.
    """
    columns = list(columns)
    if not columns:
        return {}
    if approx:
        found = df.agg(*[F.percentile_approx(c, 0.5, 100_000).alias(c) for c in columns]).first()
        return {c: found[c] for c in columns}
    rows = df.count() if rows is None else rows
    if rows <= max_group_rows(df.sparkSession):
        found = df.agg(*[F.median(c).alias(c) for c in columns]).first()
        return {c: found[c] for c in columns}
    middles = {}
    for kind in dict.fromkeys(df.schema[c].dataType for c in columns):
        same = [c for c in columns if df.schema[c].dataType == kind]
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).alias("_value")) for c in same]))
        values = df.select(each.alias("_each")).select("_each.*").where(F.col("_value").isNotNull())
        counts = durable(values.groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_n")))
        found = _median_of_counts(counts, ["_column"], "_value", "_median").collect()
        middles.update({r["_column"]: r["_median"] for r in found})
    return {c: middles.get(c) for c in columns}


def guarded_corr(x, y):
    """Pearson correlation over the rows where both columns are present.

    Null when fewer than two such rows exist or either column does not vary. That a column
    varies shows in its extremes: equal values may leave a variance of rounding errors.
    """
    a, b = _both_present(x, y)
    varies = (F.count(a) > 1) & (F.min(a) < F.max(a)) & (F.min(b) < F.max(b)) & (F.var_pop(a) > 0) & (F.var_pop(b) > 0)
    return F.when(varies, F.covar_pop(a, b) / (F.stddev_pop(a) * F.stddev_pop(b)))


def _both_present(x, y):
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return F.when(both, F.col(x).cast("double")), F.when(both, F.col(y).cast("double"))


def correlation_by(df: DataFrame, key, x, y, name, fill=0.5) -> DataFrame:
    """(key, name): guarded correlation of two columns per group."""
    return df.groupBy(key).agg(F.coalesce(guarded_corr(x, y), F.lit(fill)).alias(name))


def in_stored_order(order):
    """A struct that sorts as the columns do, nulls last."""
    return F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in order])


MOMENTS = "struct<n:bigint,x:double,y:double,xx:double,yy:double,xy:double,x_low:double,x_high:double,y_low:double,y_high:double>"


def co_moments(x, y):
    """Rows, means, extremes and centred sums of squares and products where both columns are present, as one struct.

    The mean of equal values is that value, exactly, so that merging such groups adds no variance.
    """
    a, b = _both_present(x, y)
    n, mean = F.count(a), lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.avg(c))
    sums = F.var_pop(a) * n, F.var_pop(b) * n, F.covar_pop(a, b) * n
    return F.struct(n, mean(a), mean(b), *sums, F.min(a), F.max(a), F.min(b), F.max(b)).cast(MOMENTS)


def merged_moments(a, b):
    """The co-moments of two groups of rows together, by the pairwise update: nothing is squared before it is centred."""
    n, dx, dy = a["n"] + b["n"], b["x"] - a["x"], b["y"] - a["y"]
    share = b["n"] / n
    centre = a["n"] * share
    both = F.struct(
        n, a["x"] + dx * share, a["y"] + dy * share,
        a["xx"] + b["xx"] + dx * dx * centre, a["yy"] + b["yy"] + dy * dy * centre, a["xy"] + b["xy"] + dx * dy * centre,
        F.least(a["x_low"], b["x_low"]), F.greatest(a["x_high"], b["x_high"]),
        F.least(a["y_low"], b["y_low"]), F.greatest(a["y_high"], b["y_high"]),
    ).cast(MOMENTS)
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


def moments_corr(m):
    """The guarded correlation that co-moments (a struct column) amount to."""
    varies = (m["n"] > 1) & (m["x_low"] < m["x_high"]) & (m["y_low"] < m["y_high"]) & (m["xx"] > 0) & (m["yy"] > 0)
    return F.when(varies, m["xy"] / (F.sqrt(m["xx"]) * F.sqrt(m["yy"])))


def correlation_by_cutoff(df: DataFrame, key, season, x, y, name, fill=0.5, cutoffs=None) -> DataFrame:
    """(key, season, name): guarded correlation of a key's rows of earlier seasons.

    There is a row for each season that a key has, or for each of ``cutoffs`` (a list of seasons), if
    given. The rows are read once for all of them: each season of a key amounts to one struct of
    co-moments, and a fold along the key's seasons (as many as there are years) carries them on.
    """
    kind = df.schema[season].dataType
    each = df.where(F.col(season).isNotNull()).groupBy(key, season).agg(co_moments(x, y).alias("_m"))
    # what is asked for a season comes before the season's own rows
    own = F.struct(F.col(season).alias("season"), F.lit(1).alias("own"), F.col("_m").alias("m"))
    steps = each.groupBy(key).agg(F.collect_list(own).alias("_steps"))
    nothing = F.struct(F.lit(0), *[F.lit(0.0)] * 5, *[F.lit(None)] * 4).cast(MOMENTS)
    asked = [F.struct(F.lit(c).cast(kind).alias("season"), F.lit(0).alias("own"), nothing.alias("m")) for c in cutoffs or []]
    every = F.concat("_steps", F.array(*asked)) if asked else F.col("_steps")
    wanted = 1 if cutoffs is None else 0
    seen = f"array<struct<season:{kind.simpleString()},m:{MOMENTS}>>"
    start = F.struct(nothing.alias("state"), F.array().cast(seen).alias("out"))

    def follow(so_far, step):
        out = F.struct(step["season"].alias("season"), so_far["state"].alias("m"))
        return F.struct(
            merged_moments(so_far["state"], step["m"]).alias("state"),
            F.when(step["own"] == wanted, F.concat(so_far["out"], F.array(out))).otherwise(so_far["out"]).cast(seen).alias("out"),
        )

    folded = steps.select(key, F.explode(F.aggregate(F.array_sort(every), start, follow)["out"]).alias("_at"))
    return folded.select(key, F.col("_at.season").alias(season), F.coalesce(moments_corr(F.col("_at.m")), F.lit(fill)).alias(name))


CHUNK_BITS = 12


def medians_by_cutoff(df: DataFrame, season, column, name, keys=(), cutoffs=None) -> DataFrame:
    """(keys, season, name): the median of the column over a group's rows of earlier seasons; no row without any.

    Without ``keys`` the whole table is the group; rows that lack a key are in none. Every season of
    the table is a cutoff, or each of ``cutoffs``, if given. Values are counted per season once, sorted
    by range and cut into chunks of 4,096. What a chunk holds of each season says, summed up along
    the chunks, in which chunk the middle of a cutoff lies, and only that chunk is looked into for it. So
    what is shuffled grows with the distinct values; cutoffs multiply nothing but the chunks.
    """
    keys = list(keys)
    present = df.where(all_present([*keys, column, season]))
    if cutoffs is None:
        cutoffs = [r[0] for r in present.select(season).distinct().collect()]  # as many as there are years
    by = [*keys, column, season]
    counts = present.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    ranged = counts.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id())
    values = durable(ranged).withColumn("_chunk", F.shiftright("_place", CHUNK_BITS)).drop("_place")

    held = values.groupBy(*keys, "_chunk", season).agg(F.sum("_n").alias("_n"))
    held = held.groupBy(*keys, "_chunk").agg(F.collect_list(F.struct(F.col(season).alias("season"), "_n")).alias("_held"))
    kind = df.schema[season].dataType
    asked = F.array(*[F.lit(c).cast(kind) for c in sorted(cutoffs)]) if cutoffs else F.array().cast(f"array<{kind.simpleString()}>")
    earlier = F.aggregate(
        F.filter("_held", lambda s: s["season"] < F.col("_cutoff")), F.lit(0).cast("long"), lambda total, s: total + s["_n"]
    )
    placed = held.withColumn("_cutoff", F.explode(asked)).select(*keys, "_chunk", "_cutoff", earlier.alias("_here")).where("_here > 0")
    group = Window.partitionBy(*keys, "_cutoff")
    before_it = F.coalesce(F.sum("_here").over(group.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumns({"_below": before_it, "_size": F.sum("_here").over(group)})
    low, high = F.floor((F.col("_size") - 1) / 2), F.floor(F.col("_size") / 2)
    holds = lambda place, below, n: (below <= place) & (place < below + n)
    middle = placed.where(holds(low, F.col("_below"), F.col("_here")) | holds(high, F.col("_below"), F.col("_here")))

    inside = values.join(middle, [*keys, "_chunk"]).where(F.col(season) < F.col("_cutoff"))
    along = Window.partitionBy(*keys, "_cutoff", "_chunk").orderBy(column, season).rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("_below", F.col("_below") + F.coalesce(F.sum("_n").over(along), F.lit(0)))
    at_low, at_high = (holds(p, F.col("_below"), F.col("_n")) for p in (low, high))
    lower, upper = F.max(F.when(at_low, F.col(column))), F.max(F.when(at_high, F.col(column)))
    found = inside.where(at_low | at_high).groupBy(*keys, "_cutoff").agg(((lower + upper) / 2).cast("double").alias(name))
    return found.withColumnRenamed("_cutoff", season)


def last_wins(df: DataFrame, keys, values, order) -> DataFrame:
    """One row per key: the values of the row that is last in ``order``."""
    row = F.max_by(F.struct(*values), in_stored_order(order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*")


def distinct_rows(df: DataFrame, columns) -> DataFrame:
    """Distinct combinations of the columns that exist."""
    return df.select(*[c for c in columns if c in df.columns]).distinct()
