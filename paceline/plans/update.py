"""Bring the stored tables up to date from landed responses and laps."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.operators.laps import lap_seconds, timing_features
from paceline.plans.load import read_stored
from paceline.sources import landed
from paceline.sources.tables import sprint_range, write_latest, write_seasons, write_whole


def _in_range(rows, first, last):
    return rows.where(F.col("year").between(first, last))


def update_results(responses: DataFrame, folder, first, last, fmt="parquet") -> bool:
    """Replace the seasons' results; rows are stored by race and grid."""
    rows = _in_range(landed.race_results(responses), first, last)
    return write_seasons(rows, f"{folder}/results", first, last, ["round", "grid"], fmt=fmt)


def update_sprints(responses: DataFrame, folder, first, last, fmt="parquet") -> bool:
    """Replace the seasons' sprints, from the first season that had them."""
    first, last = sprint_range(first, last)
    rows = _in_range(landed.sprint_results(responses), first, last)
    return write_seasons(rows, f"{folder}/sprint", first, last, ["round", "sprint_pos"], fmt=fmt)


def update_calendar(responses: DataFrame, folder, first, last, fmt="parquet") -> None:
    """Keep the calendar of just these seasons, and no other."""
    rows = _in_range(landed.calendar(responses), first, last)
    write_whole(rows, f"{folder}/calendar", ["year", "round"], fmt)


def update_calendar_seasons(responses: DataFrame, folder, first, last, fmt="parquet") -> bool:
    """Replace the seasons' calendar; other seasons stay.

    The table is partitioned by season then, so a folder is kept by this form or by
    ``update_calendar``, not by both in turn.
    """
    rows = _in_range(landed.calendar(responses), first, last)
    return write_seasons(rows, f"{folder}/calendar", first, last, ["round"], fmt=fmt)


def update_all(
    folder, first, last, results=None, calendar=None, sprints=None, qualifying=None, laps=None, drivers=None, fmt="parquet"
) -> dict:
    """Bring up to date whatever has landed; the name of each table and whether it changed.

    The calendar goes before the timing, which needs it. The latest qualifying is that of
    the last race in ``qualifying``.
    """
    done = {}
    if results is not None:
        done["results"] = update_results(results, folder, first, last, fmt)
    if calendar is not None:
        done["calendar"] = update_calendar_seasons(calendar, folder, first, last, fmt)
    if sprints is not None:
        done["sprint"] = update_sprints(sprints, folder, first, last, fmt)
    if qualifying is not None:
        newest = landed.qualifying_results(qualifying).agg(F.max(F.struct("year", "round")).alias("race")).first()["race"]
        done["latest_qualifying"] = newest is not None and update_latest_qualifying(qualifying, folder, *newest, fmt)
    if laps is not None:
        done["extra"] = update_timing(laps.sparkSession, laps, drivers, folder, first, last, fmt)
    return done


def update_latest_qualifying(responses: DataFrame, folder, year, rnd, fmt="parquet") -> bool:
    """Keep the qualifying of one race; False, and no change, if it has not landed."""
    rows = landed.qualifying_results(responses).where((F.col("year") == year) & (F.col("round") == rnd))
    return write_latest(rows, f"{folder}/latest_qualifying", fmt)


def update_timing(spark: SparkSession, laps: DataFrame, drivers: DataFrame, folder, first, last, fmt="parquet") -> bool:
    """Replace the seasons' timing features, for the races of the stored calendar."""
    calendar = read_stored(spark, folder, "calendar", fmt)
    if calendar is None:
        raise ValueError("update the calendar first")
    rows = timing_features(lap_seconds(landed.race_laps(laps, drivers, calendar, first, last)))
    return write_seasons(rows, f"{folder}/extra", first, last, fmt=fmt)
