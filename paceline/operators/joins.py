"""Joins of the fact table with its context tables, and the as-of join."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.functions.scalars import before
from paceline.operators.grouped import in_stored_order
from paceline.operators.history import Carried, Previous, with_history
from paceline.operators.skew import all_present, hot_groups, lookup_side

RACE = ("year", "round")


#: Parts over which the rows without a null-safe key are spread in a join.
UNKEYED_PARTS = 32


def attach(fact: DataFrame, side: DataFrame, keys, values, suffix="_extra", null_safe=()) -> DataFrame:
    """Left join of the ``values`` that ``side`` has, on ``keys``.

    Keys in ``null_safe`` match null with null. A value the fact already has gets
    ``suffix``. Repeated rows on the right multiply rows, as a join does. Spark
    broadcasts a side whose files are small and otherwise sorts both, splitting a
    skewed key of the fact. Rows that lack a null-safe key would all meet in one key of
    their race, so they are spread by a hash of the row, and such rows of the side
    are there once for each part.
    """
    values = [c for c in values if c in side.columns]
    names = {c: c + suffix if c in fact.columns else c for c in values}
    right = side.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(c).alias(n) for c, n in names.items()])
    on, left = F.lit(True), fact
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_key_{k}")) if k in null_safe else F.col(k) == F.col(f"_key_{k}")
        on = on & same
    if null_safe:
        hashed = [f.name for f in fact.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(UNKEYED_PARTS)).cast("int")
        left = fact.withColumn("_part", F.when(all_present(null_safe), 0).otherwise(part))
        parts = F.when(all_present([f"_key_{k}" for k in null_safe]), F.array(F.lit(0)))
        right = right.withColumn("_key_part", F.explode(parts.otherwise(F.sequence(F.lit(0), F.lit(UNKEYED_PARTS - 1)))))
        on = on & (F.col("_part") == F.col("_key_part"))
    return left.join(right, on, "left").drop(*[f"_key_{k}" for k in keys], "_part", "_key_part")


def with_circuit(fact: DataFrame, calendar: DataFrame, race=RACE, circuit="circuitId", times=None) -> DataFrame:
    """The circuit from the calendar, unless the fact already names it.

    Two suffixed circuit columns left by an earlier merge are folded into one. A calendar that repeats a race
    multiplies its rows; with ``times`` equal rows of the calendar give one row, and how many they are in that column.
    """
    if times:
        rows = fact.drop(times)
        if circuit in fact.columns or {f"{circuit}_x", f"{circuit}_y"} <= set(fact.columns):
            return with_circuit(rows, calendar, race, circuit).withColumn(times, F.lit(1).cast("long"))
        each = calendar.groupBy(*race, circuit).agg(F.count(F.lit(1)).alias(times))
        return attach(rows, each, race, [circuit, times]).withColumn(times, F.coalesce(times, F.lit(1).cast("long")))
    left, right = f"{circuit}_x", f"{circuit}_y"
    if circuit not in fact.columns and left in fact.columns and right in fact.columns:
        return fact.withColumn(circuit, F.coalesce(left, right)).drop(left, right)
    if circuit in fact.columns:
        return fact
    # a calendar is small beside the starts, but its plan says nothing of its size
    side = calendar.select(*[c for c in (*race, circuit) if c in calendar.columns])
    return attach(fact, lookup_side(side), race, [circuit])


def with_sprint(fact: DataFrame, sprint: DataFrame | None, entity="DriverKey", race=RACE) -> DataFrame:
    """Sprint grid, place and points; null where there was no sprint or no table."""
    values = ["sprint_pos", "sprint_grid", "sprint_points"]
    if sprint is None:
        return fact.withColumns({c: F.lit(None).cast("double") for c in values})
    return attach(fact, sprint, [*race, entity], values, null_safe=[entity])


def sprint_features(fact: DataFrame, grid="grid") -> DataFrame:
    """Sprint flag and places gained; neutral values where there was no sprint."""
    if not {"sprint_pos", "sprint_grid"} <= set(fact.columns):
        return fact.withColumns(
            {"has_sprint": F.lit(0), "sprint_pos": F.col(grid), "sprint_grid": F.col(grid), "sprint_delta": F.lit(0.0)}
        )
    gained = F.coalesce(F.col("sprint_grid") - F.col("sprint_pos"), F.lit(0.0))
    return fact.withColumns(
        {
            "has_sprint": F.col("sprint_pos").isNotNull().cast("int"),
            "sprint_delta": gained,
            "sprint_pos": F.coalesce("sprint_pos", grid),
        }
    )


def without_sprint(fact: DataFrame) -> DataFrame:
    """Ablation: the sprint features switched off."""
    return fact.withColumns({"has_sprint": F.lit(0), "sprint_delta": F.lit(0.0)})


def as_of_cutoff(history: DataFrame, targets: DataFrame, entity, season, seq, cutoff, stats, tie=()) -> DataFrame:
    """Each target entity with the stats of its last row strictly before a cutoff.

    ``stats`` maps a column to its default, used where the entity has no earlier row
    or the last one is null (it does not look further back). Of several rows of its last
    race the one that is last by ``tie``, nulls last, counts. One aggregate over the
    history of the targets; no window.
    """
    place = in_stored_order([season, seq, *tie])
    wanted = lookup_side(targets.select(entity).distinct())
    last = (
        history.where(before(season, seq, cutoff))
        .join(wanted, entity, "left_semi")
        .groupBy(entity)
        .agg(F.max_by(F.struct(*stats), place).alias("_last"))
    )
    joined = targets.join(last, entity, "left")
    filled = [F.coalesce(F.col(f"_last.{c}"), _default(v)).alias(c) for c, v in stats.items()]
    return joined.select(*[c for c in targets.columns if c not in stats], *filled)


def as_of_previous(rows: DataFrame, entity, order, stats, race=None, hot=None) -> DataFrame:
    """Every row with the stats of the entity's last row strictly before its race, all races in one pass.

    ``entity`` is a column or a list of them. ``race`` are the leading columns of ``order`` that
    name the race (all of them, if not given). An entity may have several rows in a race: they all get what the last row of
    the race before holds, as in ``as_of_cutoff``. A row without a race has nothing before it.
    """
    race, keys = list(race or order), [entity] if isinstance(entity, str) else list(entity)
    hot = hot_groups(rows, keys) if hot is None else hot
    packed = rows.withColumns({"_stats": F.struct(*stats), "_race": F.struct(*race)})
    seen = [Previous("_before", "_stats"), Previous("_race_before", "_race")]
    packed = with_history(packed, keys, order, seen, hot)
    # the first row of a race knows the row before the race; the others of the race take it from there
    first = ~F.col("_race").eqNullSafe(F.col("_race_before"))
    packed = packed.withColumn("_start", F.when(first, F.struct(F.col("_before"))))
    packed = with_history(packed, keys, order, [Carried("_kept", "_start", tuple(order))], hot)
    known = all_present(race)
    filled = [F.coalesce(F.when(known, F.col(f"_kept._before.{c}")), _default(v)).alias(c) for c, v in stats.items()]
    return packed.select(*[c for c in rows.columns if c not in stats], *filled)


def _default(value):
    return F.lit(None) if value is None else F.lit(value)
