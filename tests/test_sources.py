"""Landed files, stored tables and sinks."""

import json

import pytest
from pyspark.sql import functions as F

from paceline import schemas
from paceline.operators.catalog import choose_entries, participants
from paceline.operators.laps import lap_seconds, timing_features
from paceline.plans.load import load_facts, read_stored
from paceline.sources import landed
from paceline.sources.tables import has_race, read_table, write_latest, write_seasons, write_whole
from tests.helpers import rows


def entry(given, family, grid, position, **more):
    person = {"Driver": {"givenName": given, "familyName": family}, "Constructor": {"name": "Team A"}}
    return {**person, "grid": grid, "position": position, "points": "25", "status": "Finished", **more}


def response(races):
    return {"MRData": {"limit": "30", "RaceTable": {"Races": races}}}


def race(season, rnd, **lists):
    return {"season": str(season), "round": str(rnd), "raceName": "GP", "date": "2022-03-20",
            "Circuit": {"circuitId": "spa", "url": "x"}, **lists}


@pytest.fixture
def files(tmp_path):
    def write(*bodies):
        for i, body in enumerate(bodies):
            (tmp_path / f"{i}.json").write_text(json.dumps(body, indent=1))
        return str(tmp_path)

    return write


def test_results(spark, files):
    path = files(
        response([race(2022, 1, Results=[entry("Max", "Verstappen", "1", "2"), entry("Kimi", "Räikkönen", "0", "R")]),
                  race(2022, 2, Results=[entry("No", "One", "1", "1")])]),
        response([]),
        response([race(2022, 3, Results=[{"grid": "4", "position": "4"}])]),
    )
    found = landed.race_results(landed.read_responses(spark, path))
    assert rows(found, "year", "round", "DriverKey", "DriverName", "Team", "grid", "position") == [
        (2022, 1, "k_raikkonen", "Kimi Räikkönen", "Team A", 0.0, None),
        (2022, 1, "m_verstappen", "Max Verstappen", "Team A", 1.0, 2.0),
        (2022, 3, None, "", "", 4.0, 4.0),
    ]
    assert set(found.columns) == {c.split()[0] for c in schemas.RESULTS.split(", ")}


def test_qualifying_and_calendar(spark, files):
    path = files(response([race(2022, 1, QualifyingResults=[entry("A", "B", None, "3")]), race(2022, 2)]), response([race(2022, 9)]))
    responses = landed.read_responses(spark, path)
    assert rows(landed.qualifying_results(responses)) == [("a_b", "A B", "Team A", 3.0, 2022, 1)]
    assert rows(landed.calendar(responses), "year", "round", "circuitId") == [(2022, 1, "spa"), (2022, 2, "spa"), (2022, 9, "spa")]
    assert landed.race_results(responses).isEmpty()


def test_sprints_start_late(spark, files):
    path = files(*[response([race(y, 1, SprintResults=[entry("A", "B", "2", "1")])]) for y in (2020, 2021)])
    found = landed.sprint_results(landed.read_responses(spark, path))
    assert rows(found, "year", "sprint_grid", "sprint_pos", "sprint_points") == [(2021, 2.0, 1.0, 25.0)]


def season(spark, year, n, value):
    return spark.range(n).select(F.lit(year).alias("year"), F.col("id").cast("int").alias("round"), F.lit(value).alias("v"))


SEASONS = "year int, round int, v int"


def test_season_sink(spark, tmp_path):
    path = str(tmp_path / "table")
    read = lambda: rows(read_table(spark, path, SEASONS).groupBy("year").agg(F.count("v").alias("n"), F.max("v").alias("v")))
    assert read_table(spark, path, SEASONS) is None
    for year in (2019, 2020, 2021):
        assert write_seasons(season(spark, year, 3, 1), path, year, year, ["round"])
    untouched = sorted((tmp_path / "table" / "year=2019").iterdir())
    for _ in range(2):
        assert write_seasons(season(spark, 2021, 5, 2), path, 2020, 2022, ["round"])
        assert read() == [(2019, 3, 1), (2021, 5, 2)]
    assert sorted((tmp_path / "table" / "year=2019").iterdir()) == untouched
    assert not write_seasons(season(spark, 2019, 0, 9), path, 2019, 2019)
    assert read() == [(2019, 3, 1), (2021, 5, 2)]


def test_season_sink_rejects_rows_outside(spark, tmp_path):
    path = str(tmp_path / "table")
    write_seasons(season(spark, 2019, 3, 1), path, 2019, 2019)
    with pytest.raises(Exception, match="season outside 2019-2020"):
        write_seasons(season(spark, 2019, 1, 2).unionByName(season(spark, 2018, 1, 2)), path, 2019, 2020)
    assert read_table(spark, path, SEASONS).where("v = 2").isEmpty()
    assert read_table(spark, path, SEASONS).count() == 3


def test_latest_sink(spark, tmp_path):
    path = str(tmp_path / "latest")
    assert write_latest(season(spark, 2020, 2, 1), path)
    assert not write_latest(season(spark, 2021, 0, 1), path)
    stored = read_table(spark, path, SEASONS)
    assert has_race(stored, 2020, 1) and not has_race(stored, 2021, 1) and not has_race(None, 2020, 1)


@pytest.fixture
def stored(spark, tmp_path):
    results = spark.createDataFrame(
        [("a_b", "A B", "T", 1.0, 2.0, "Finished", "18", 2021, 1), ("c_d", "C D", "U", None, 1.0, "Finished", "25", 2021, 1)],
        "DriverKey string, DriverName string, Team string, grid double, position double, status string, points string, year int, round int",
    )
    write_whole(results, f"{tmp_path}/results", ["year", "round", "grid"], "csv")
    return str(tmp_path)


def test_facts(spark, stored):
    assert load_facts(spark, stored + "/nothing", "csv") is None
    assert read_stored(spark, stored, "calendar", "csv") is None
    bare = load_facts(spark, stored, "csv")
    assert rows(bare, "DriverKey", "circuitId", "sprint_pos") == [("a_b", None, None), ("c_d", None, None)]
    write_whole(spark.createDataFrame([(2021, 1, "GP", "spa", "d")], schemas.CALENDAR), f"{stored}/calendar", fmt="csv")
    write_whole(spark.createDataFrame([("c_d", "C D", "U", 3.0, 1.0, "Finished", 8.0, 2021, 1)], schemas.SPRINT), f"{stored}/sprint", fmt="csv")
    full = load_facts(spark, stored, "csv")
    assert rows(full, "DriverKey", "circuitId", "sprint_pos", "points") == [("a_b", "spa", None, "18"), ("c_d", "spa", 1.0, "25")]


def test_entries(spark, stored):
    facts = load_facts(spark, stored, "csv")
    assert [r["DriverKey"] for r in participants(facts, 2021, 1).collect()] == ["a_b", "c_d"]
    entries, real = choose_entries(participants(facts, 2021, 2), None, 2021, 2, True)
    assert entries.isEmpty() and not real
    latest = spark.createDataFrame([("e_f", "E F", "V", 1.0, 2021, 2)], schemas.QUALIFYING)
    entries, real = choose_entries(participants(facts, 2021, 2), latest, 2021, 2, True)
    assert [r["DriverKey"] for r in entries.collect()] == ["e_f"] and real


def test_lap_scan(spark):
    laps = spark.createDataFrame([], schemas.LAPS)
    one = spark.sql(
        "select 2022 year, 1 round, '33' driver_number, 1 lap_number, interval '90.5' second LapTime, "
        "cast(null as interval day to second) PitInTime, interval '1' hour PitOutTime, 1D Stint, 'SOFT' Compound"
    )
    laps = laps.unionByName(one).unionByName(one.withColumn("round", F.lit(2)))
    drivers = spark.createDataFrame([(2022, r, "33", "Max", "Verstappen", "Max Verstappen", None) for r in (1, 2)], schemas.DRIVER_INFO)
    races = spark.createDataFrame([(2022, 1, "GP", "spa", "d"), (2022, 3, "GP", "spa", "d")], schemas.CALENDAR)
    found = timing_features(lap_seconds(landed.race_laps(laps, drivers, races, 2018, 2025)))
    assert rows(found, "year", "round", "DriverNumber", "DriverKey", "Team", "avg_race_pace", "pitstops_count", "mean_pit_loss") == [
        (2022, 1, "33", "m_verstappen", "", 90.5, 1, 0.0)
    ]
    assert set(found.columns) == {c.split()[0] for c in schemas.TIMING.split(", ")}
