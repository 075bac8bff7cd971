"""Landed responses and laps to typed tables. Flattening is map-only."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline import schemas
from paceline.functions.scalars import entity_key, full_name, or_empty, text_number
from paceline.operators.grouped import last_wins

# Fixed value: the first season with sprint races.
FIRST_SPRINT_SEASON = 2021


def read_responses(spark: SparkSession, path, one_per_line=False) -> DataFrame:
    """Landed JSON responses: one document per file, or one per line."""
    return spark.read.schema(schemas.RESPONSE).json(path, multiLine=not one_per_line)


def parse_responses(df: DataFrame, column) -> DataFrame:
    """Responses held as text in a column; other columns are kept."""
    parsed = F.from_json(column, schemas.RESPONSE)
    return df.withColumn("_parsed", parsed).select(*[c for c in df.columns if c != column], "_parsed.*")


def _races(responses):
    kept = [c for c in responses.columns if c != "MRData"]
    return kept, F.col("MRData.RaceTable.Races")


def _entries(responses, list_name):
    """One row per entry of the first race of each response."""
    kept, races = _races(responses)
    first = responses.select(*kept, F.get(races, F.lit(0)).alias("race"))
    # take what is needed before the explode, so that no entry carries the whole race
    parts = first.select(*kept, "race.season", "race.round", F.col("race")[list_name].alias("entries"))
    # an outer explode, since a plain one adds a size filter that parses a text twice
    entries = parts.select(*kept, "season", "round", F.explode_outer("entries").alias("entry"))
    return entries.where(F.col("entry").isNotNull()), kept


def _identity():
    given, family = F.col("entry.Driver.givenName"), F.col("entry.Driver.familyName")
    return [
        entity_key(given, family).alias("DriverKey"),
        full_name(given, family).alias("DriverName"),
        or_empty("entry.Constructor.name").alias("Team"),
    ]


def _when(race=""):
    return [F.col(f"{race}season").try_cast("int").alias("year"), F.col(f"{race}round").try_cast("int").alias("round")]


def race_results(responses: DataFrame) -> DataFrame:
    rows, kept = _entries(responses, "Results")
    return rows.select(
        *kept,
        *_identity(),
        text_number("entry.grid").alias("grid"),
        text_number("entry.position").alias("position"),
        F.col("entry.status").alias("status"),
        F.col("entry.points").alias("points"),
        F.col("entry.circuitId").alias("circuitId"),
        *_when(),
    )


def qualifying_results(responses: DataFrame) -> DataFrame:
    """The qualifying position is the starting grid."""
    rows, kept = _entries(responses, "QualifyingResults")
    return rows.select(*kept, *_identity(), text_number("entry.position").alias("grid"), *_when())


def sprint_results(responses: DataFrame) -> DataFrame:
    rows, kept = _entries(responses, "SprintResults")
    flat = rows.select(
        *kept,
        *_identity(),
        text_number("entry.grid").alias("sprint_grid"),
        text_number("entry.position").alias("sprint_pos"),
        F.col("entry.status").alias("status"),
        text_number("entry.points").alias("sprint_points"),
        *_when(),
    )
    return flat.where(F.col("year") >= FIRST_SPRINT_SEASON)


def calendar(responses: DataFrame) -> DataFrame:
    """One row per race of a season; here every race of a response counts."""
    kept, races = _races(responses)
    each = responses.select(*kept, F.explode_outer(races).alias("race")).where(F.col("race").isNotNull())
    return each.select(
        *kept,
        *_when("race."),
        F.col("race.raceName").alias("raceName"),
        F.col("race.Circuit.circuitId").alias("circuitId"),
        F.col("race.date").alias("date"),
    )


def race_laps(laps: DataFrame, drivers: DataFrame, races: DataFrame, first, last) -> DataFrame:
    """Laps of the calendar's races in a range of seasons, with who drove them.

    Races without landed laps drop out. A driver list may repeat a number of a race: one
    of its rows counts, so laps are never multiplied. The calendar and the driver list are
    small beside the laps; Spark broadcasts them by their size on disk.
    """
    names = ["FirstName", "LastName", "FullName", "TeamName"]
    drivers = last_wins(drivers, ["year", "round", "driver_number"], names, names)
    in_range = races.where(F.col("year").between(first, last)).select("year", "round").distinct()
    who = drivers.select(
        "year",
        "round",
        "driver_number",
        entity_key("FirstName", "LastName").alias("DriverKey"),
        or_empty("FullName").alias("DriverName"),
        or_empty("TeamName").alias("Team"),
    )
    return (
        laps.where(F.col("year").between(first, last))
        .join(in_range, ["year", "round"])
        .join(who, ["year", "round", "driver_number"])
        .withColumnRenamed("driver_number", "DriverNumber")
    )


def season_counts(results: DataFrame, season="year", seq="round") -> DataFrame:
    """Races loaded per season."""
    return results.groupBy(season).agg(F.count_distinct(seq).alias("races"))
