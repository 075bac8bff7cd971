"""The forests: by behaviour and metric, never by value."""

import pytest
from pyspark.sql import functions as F

from paceline.operators.metrics import backtest, scored
from paceline.plans.features import enrich
from paceline.plans.forecast import encode, forecast, race_entries, season_entries, train_before, walk_forward
from paceline.plans.models import GRID_FEATURES, RACE_FEATURES, ForestSettings, importances
from paceline.session import durable
from tests.helpers import rows

TINY = ForestSettings.smaller(numTrees=8, maxDepth=5)
DRIVERS, ROUNDS = 10, 8


@pytest.fixture(scope="module")
def season_results(spark):
    """Drivers finish by their number with a shift; the grid is one place off."""
    n = F.col("id")
    driver, rnd, year = n % DRIVERS, F.floor(n / DRIVERS) % ROUNDS + 1, 2020 + F.floor(n / (DRIVERS * ROUNDS))
    df = spark.range(DRIVERS * ROUNDS * 3).select(
        F.concat(F.lit("d_"), F.chr(97 + driver)).alias("DriverKey"),
        F.concat(F.lit("Driver "), F.chr(65 + driver)).alias("DriverName"),
        F.concat(F.lit("T"), F.floor(driver / 2).cast("string")).alias("Team"),
        (1 + (driver + rnd % 2) % DRIVERS).cast("double").alias("grid"),
        (1 + driver).cast("double").alias("position"),
        F.when(n % 37 == 0, "Engine").otherwise("Finished").alias("status"),
        year.cast("int").alias("year"),
        rnd.cast("int").alias("round"),
    )
    return durable(df)


@pytest.fixture(scope="module")
def calendar(spark, season_results):
    races = season_results.select("year", "round").distinct()
    return durable(races.withColumn("circuitId", F.concat(F.lit("c"), (F.col("round") % 4).cast("string"))))


@pytest.fixture(scope="module")
def enriched(season_results, calendar):
    return durable(enrich(season_results, calendar))


def test_forecast_finds_the_order(spark, season_results, calendar):
    found = forecast(season_results, 2022, 6, calendar, settings=TINY).collect()
    assert [r["Pos"] for r in found] == list(range(1, DRIVERS + 1))
    assert found[0]["DriverName"] in ("Driver A", "Driver B") and found[-1]["DriverName"] in ("Driver I", "Driver J")
    again = forecast(season_results, 2022, 6, calendar, settings=TINY).collect()
    assert again == found


def test_forecast_keeps_every_entry(spark, season_results, calendar):
    """The whole ranking with keys and scores, unless ``top`` cuts it."""
    entries = season_results.select("DriverKey", "Team").distinct()
    many = entries.unionByName(entries).unionByName(entries)
    found = forecast(season_results, 2023, 1, calendar, settings=TINY, entries=many)
    assert {"year", "round", "DriverKey", "Grid_Input", "Course_Score"} <= set(found.columns)
    assert found.count() == 3 * DRIVERS > 20
    assert forecast(season_results, 2023, 1, calendar, settings=TINY, entries=many, top=3).count() == 3


def test_settings_can_be_changed():
    small = ForestSettings.smaller(maxBins=64, seed=7)
    assert small.grid["maxBins"] == small.race["maxBins"] == 64 and small.race["seed"] == 7


def test_leak_free_walk(season_results, calendar):
    """Statistics from before each season only: changing a later season changes nothing earlier."""
    later = season_results.withColumn("grid", F.when(F.col("year") < 2022, F.col("grid")).otherwise(99.0))
    walks = [walk_forward(df, [2021], calendar, settings=TINY, leak_free=True) for df in (season_results, later)]
    first, second = (rows(w, "mode", "round", "DriverKey", "Pos", "Course_Score") for w in walks)
    assert first == second and len(first) == 2 * DRIVERS * ROUNDS


def test_future_race_needs_entries(spark, season_results, calendar):
    assert forecast(season_results, 2023, 1, calendar, settings=TINY).isEmpty()
    entries = spark.createDataFrame([("d_a", "T0"), ("d_j", "T4"), ("x_new", "T0")], "DriverKey string, Team string")
    found = forecast(season_results, 2023, 1, calendar, settings=TINY, entries=entries).collect()
    assert [r["DriverName"] for r in found] == ["Driver A", "Driver J"]  # an unknown driver drops out


def test_real_grid_is_used(spark, season_results, calendar):
    real = season_results.where("year = 2022 and round = 6").select("DriverName", F.col("grid").alias("real"))
    found = forecast(season_results, 2022, 6, calendar, use_real_grid=True, settings=TINY)
    assert rows(found.join(real, "DriverName").where("Grid <> real")) == []


def test_feature_lists(enriched):
    finishers, _ = encode(enriched)
    assert set(GRID_FEATURES) | set(RACE_FEATURES) <= set(finishers.columns)
    assert finishers.where("status = 'Engine'").isEmpty()


def test_importances(enriched):
    models, _ = train_before(enriched, (2022, 1), TINY)
    found = importances(models.race, models.race_features).collect()
    weights = [r["importance"] for r in found]
    assert [*weights] == sorted(weights, reverse=True) and abs(sum(weights) - 1) < 1e-9
    assert {r["feature"] for r in found} == set(RACE_FEATURES)


def test_one_race_equals_the_batch(enriched):
    entries = enriched.where("year = 2022 and round = 3").select("DriverKey", "Team", "grid")
    one = race_entries(enriched, entries, 2022, 3)
    batch = season_entries(enriched, (F.col("year") == 2022) & (F.col("round") == 3))
    names = ["DriverKey", "form_grid", "career_race_avg", "circuit_race_skill", "pace_rank_season", "circuit_importance", "circuitId"]
    assert rows(one, *names) == rows(batch, *names)


def test_fresh_rows_know_the_last_result(enriched):
    at = (F.col("year") == 2020) & (F.col("round") == 2)
    stale = season_entries(enriched, at)
    fresh = season_entries(enriched, at, fresh=True)
    assert {r["form_race"] for r in stale.collect()} == {13.0}
    assert rows(fresh, "DriverKey", "form_race") == rows(enriched.where("year = 2020 and round = 1"), "DriverKey", "position")


def test_walk_forward(season_results, calendar):
    placed = walk_forward(season_results, [2022], calendar, settings=TINY)
    found = {r["mode"]: r for r in backtest(scored(placed, season_results), ["mode"]).collect()}
    assert set(found) == {"oracle", "analyst"}
    assert all(0 <= r["mae"] < 2 and r["rows"] == DRIVERS * ROUNDS and r["grid_mae"] > 0 for r in found.values())


def test_metrics(spark):
    data = [(1, 1, 1, 1.0), (1, 2, 3, 2.0), (1, 3, 2, 3.0), (2, 1, 2, 1.0), (2, 2, 1, 2.0)]
    df = spark.createDataFrame(data, "race int, Pos int, actual int, real_grid double")
    [row] = backtest(df).collect()
    assert (row["winner"], row["top3"], row["mae"], row["grid_mae"], row["rows"]) == (0.5, 0.2, 0.8, 0.8, 5)
