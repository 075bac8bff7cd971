"""Lookups of races and participants, and the choice of a starting grid."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline import schemas
from paceline.functions.scalars import name_matches, title_key
from paceline.operators.grouped import distinct_rows, last_wins
from paceline.operators.skew import lookup_side
from paceline.sources.tables import has_race, read_race

QUALIFYING_COLUMNS = [field.split()[0] for field in schemas.QUALIFYING.split(",")]


def find_races(calendar: DataFrame, pattern, order=("year", "round")) -> DataFrame:
    """(year, round, first_name) of the races whose name matches, one per season.

    Where a season has several, its last one counts. ``first_name`` is the name of
    the first match overall.
    """
    found = calendar.where(name_matches("raceName", pattern))
    first = found.agg(F.min_by("raceName", F.struct(*order)).alias("name")).first()
    return last_wins(found, ["year"], ["round"], order).withColumn("first_name", F.lit(first["name"]))


def participants(results: DataFrame, year, rnd) -> DataFrame:
    """Distinct entries of a race, in grid order."""
    race = read_race(results, year, rnd, ["DriverKey", "Team", "grid"])
    entries = distinct_rows(race, race.columns)
    return entries.orderBy(F.col("grid").asc_nulls_last()) if "grid" in entries.columns else entries


def has_grid(entries: DataFrame) -> bool:
    """Whether any entry has a grid place."""
    return "grid" in entries.columns and not entries.where(F.col("grid").isNotNull()).isEmpty()


def choose_entries(entries: DataFrame, latest_qualifying: DataFrame | None, year, rnd, use_real):
    """(entries, use_real): the race's own grid, else the latest qualifying, else predicted."""
    if not use_real or has_grid(entries):
        return entries, use_real
    if has_race(latest_qualifying, year, rnd):
        return read_race(latest_qualifying, year, rnd, QUALIFYING_COLUMNS), True
    return entries, False


def grid_input(predicted, real, use_real):
    """The real grid place where it is wanted and known, the predicted one otherwise."""
    wanted = use_real if not isinstance(use_real, bool) else F.lit(use_real)
    return F.when(wanted & F.col(real).isNotNull(), F.col(real)).otherwise(F.col(predicted))


def with_display_name(rows: DataFrame, names: DataFrame, order, entity="DriverKey", name="DriverName") -> DataFrame:
    """Name from the history (last one wins), else the row's own, else the key in title case.

    Only the history of the rows' entities is looked through.
    """
    wanted = lookup_side(rows.select(entity).distinct())
    names = names.join(wanted, entity, "left_semi")
    known = last_wins(names.where(F.col(name).isNotNull()), [entity], [name], order)
    side = lookup_side(known.withColumnRenamed(name, "_known"))
    own = [F.col(name)] if name in rows.columns else []
    joined = rows.join(side, entity, "left")
    return joined.withColumn(name, F.coalesce("_known", *own, title_key(entity))).drop("_known")


def key_collisions(results: DataFrame, entity="DriverKey", name="DriverName") -> DataFrame:
    """Keys shared by several names."""
    return (
        results.where(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(F.count_distinct(name).alias("names"))
        .where(F.col("names") > 1)
    )
