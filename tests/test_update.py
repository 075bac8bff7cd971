"""From landed files over the stored tables to a forecast."""

import json

import pytest
from pyspark.sql import functions as F

from paceline import schemas
from paceline.plans import update
from paceline.plans.forecast import forecast_by_name
from paceline.plans.load import load_facts, read_stored
from paceline.plans.models import ForestSettings
from paceline.sources.landed import read_responses
from tests.helpers import rows
from tests.test_sources import entry, race, response

NAMES = ["Ann", "Bea", "Cid", "Dan", "Eve", "Fay"]
SEASONS, ROUNDS = (2020, 2021, 2022), (1, 2, 3, 4)


def entries(shift):
    return [entry(n, "Öz", str(1 + (i + shift) % len(NAMES)), str(i + 1)) for i, n in enumerate(NAMES)]


@pytest.fixture(scope="module")
def responses(spark, tmp_path_factory):
    landing = tmp_path_factory.mktemp("landing")
    for season in SEASONS:
        for rnd in ROUNDS:
            lists = {"Results": entries(rnd % 2), "QualifyingResults": entries(0)}
            if rnd == 2:
                lists["SprintResults"] = entries(1)
            (landing / f"{season}-{rnd}.json").write_text(json.dumps(response([race(season, rnd, **lists)])))
    return read_responses(spark, str(landing))


def test_update_and_forecast(spark, responses, tmp_path):
    folder = str(tmp_path)
    assert forecast_by_name(spark, folder, "gp", 2022) is None
    assert update.update_results(responses, folder, 2020, 2022)
    assert update.update_results(responses, folder, 2021, 2021)  # again: nothing changes
    assert not update.update_results(responses, folder, 2001, 2005)
    assert update.update_sprints(responses, folder, 2010, 2022)
    update.update_calendar(responses, folder, 2020, 2022)
    assert update.update_latest_qualifying(responses, folder, 2022, 4)
    assert not update.update_latest_qualifying(responses, folder, 2022, 9)

    assert read_stored(spark, folder, "results").count() == len(SEASONS) * len(ROUNDS) * len(NAMES)
    assert rows(read_stored(spark, folder, "sprint").groupBy("year").count()) == [(2021, 6), (2022, 6)]
    assert read_stored(spark, folder, "calendar").count() == len(SEASONS) * len(ROUNDS)
    assert rows(read_stored(spark, folder, "latest_qualifying").select("year", "round").distinct()) == [(2022, 4)]
    facts = load_facts(spark, folder)
    assert facts.where("sprint_pos is not null").count() == 12 and facts.where("circuitId = 'spa'").count() == 72

    laps = facts.select(
        "year", "round", F.col("DriverKey").alias("driver_number"), F.lit(1).alias("lap_number"),
        F.expr("make_dt_interval(0, 0, 1, 30 + position)").alias("LapTime"),
        F.lit(None).cast("interval day to second").alias("PitInTime"),
        F.lit(None).cast("interval day to second").alias("PitOutTime"),
        F.lit(1.0).alias("Stint"), F.lit("SOFT").alias("Compound"),
    )
    drivers = laps.select(
        "year", "round", "driver_number", F.upper(F.substring("driver_number", 1, 1)).alias("FirstName"),
        F.lit("Öz").alias("LastName"), F.lit("x").alias("FullName"), F.lit("Team A").alias("TeamName"),
    )
    assert set(laps.columns) == {c.split()[0] for c in schemas.LAPS.split(", ")}
    assert update.update_timing(spark, laps, drivers, folder, 2021, 2022)
    extra = read_stored(spark, folder, "extra")
    assert rows(extra.agg(F.count("*"), F.min("avg_race_pace"), F.max("avg_race_pace"))) == [(48, 91.0, 96.0)]

    small = ForestSettings.smaller(numTrees=5, maxDepth=4)
    found = forecast_by_name(spark, folder, "^g", 2022, use_real_grid=True, settings=small).collect()
    assert [r["Pos"] for r in found] == [1, 2, 3, 4, 5, 6]
    assert forecast_by_name(spark, folder, "monza", 2022) is None


def test_update_all(spark, responses, tmp_path):
    """Whatever has landed is brought up to date; what has not is left alone."""
    folder = str(tmp_path)
    done = update.update_all(folder, 2020, 2022, responses, responses, responses, responses)
    assert done == {"results": True, "calendar": True, "sprint": True, "latest_qualifying": True}
    assert rows(read_stored(spark, folder, "latest_qualifying").select("year", "round").distinct()) == [(2022, 4)]
    assert update.update_all(folder, 2021, 2021, calendar=responses) == {"calendar": True}
    assert read_stored(spark, folder, "calendar").count() == len(SEASONS) * len(ROUNDS)


def test_scratch_is_removed_on_request(spark):
    from paceline import session

    kept = session.durable(spark.range(3))
    path = session._WRITTEN[spark.sparkContext.applicationId][-1]
    assert kept.count() == 3
    before = session._WRITTEN[spark.sparkContext.applicationId][:-1]
    session._WRITTEN[spark.sparkContext.applicationId] = [path]  # other tests still need theirs
    session.clear_scratch(spark)
    session._WRITTEN[spark.sparkContext.applicationId] = before
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
