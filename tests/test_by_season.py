"""Statistics before many seasons from one pass: equal to the form that works season by season."""

import statistics

import pytest
from pyspark.sql import functions as F

from paceline.operators import grouped
from paceline.operators.grouped import correlation_by, correlation_by_cutoff, medians_by_cutoff
from paceline.operators.ranking import label_index, label_index_by_cutoff
from paceline.operators.skew import MAX_ROWS_CONF
from paceline.plans.features import CUTOFF, enrich, enrich_by_season
from paceline.plans.forecast import Encoders, _leak_free_rows, scoring_defaults, season_entries
from paceline.session import durable
from tests.helpers import by, rows

SEASONS = [2020, 2021, 2022, 2030]
FEATURES = [
    "form_grid", "form_race", "circuit_importance", "avg_race_pace", "best_lap", "pitstops_count", "mean_pit_loss", "has_sprint",
    "career_grid_avg", "career_race_avg", "career_race_pace", "career_best_lap", "career_pit_loss", "circuit_grid_skill",
    "circuit_race_skill", "pace_rank_season",
]


@pytest.fixture(scope="module")
def facts(spark):
    """Starts with gaps in the grid, missing keys and races that some drivers miss."""
    n = F.col("id")
    driver, rnd, year = n % 9, F.floor(n / 9) % 6 + 1, 2019 + F.floor(n / 54)
    df = spark.range(9 * 6 * 4).where("id % 11 <> 3").select(
        F.when(n % 23 != 5, F.concat(F.lit("d"), driver.cast("string"))).alias("DriverKey"),
        F.concat(F.lit("D "), driver.cast("string")).alias("DriverName"),
        F.concat(F.lit("T"), F.floor(driver / 3).cast("string"), F.when(year == 2022, "new").otherwise("")).alias("Team"),
        F.when(n % 7 != 2, 1 + (n * 5) % 9).cast("double").alias("grid"),
        F.when(n % 13 != 4, 1 + (n * 7) % 9).cast("double").alias("position"),
        F.when(n % 17 == 0, "Engine").otherwise("Finished").alias("status"),
        year.cast("int").alias("year"), rnd.cast("int").alias("round"),
    )
    return durable(df)


@pytest.fixture(scope="module")
def calendar(facts):
    races = facts.select("year", "round").distinct()
    return durable(races.where("round <> 4").withColumn("circuitId", F.concat(F.lit("c"), (F.col("round") % 3).cast("string"))))


@pytest.fixture(scope="module")
def extra(facts):
    timed = facts.where("round % 2 = 0 or DriverKey = 'd3'").where("DriverKey is not null")
    return durable(
        timed.select(
            "year", "round", "DriverKey", (80 + F.col("round") * 3 + F.coalesce("grid", F.lit(2.0))).alias("avg_race_pace"),
            F.when(F.col("round") != 2, 70 + F.col("round")).alias("best_lap"), F.lit("[1.5, 2.5]").alias("pit_losses"),
        )
    )


@pytest.mark.parametrize("context, most", [("none", None), ("all", None), ("all", 15)])
def test_features_by_season(spark, facts, calendar, extra, context, most):
    """Every start has, for each later season, the features that ``enrich`` gives with that cutoff; hot drivers too."""
    contexts = {"none": (None, None), "all": (calendar, extra)}[context]
    seasons = [2021] if most else [2020, 2030]
    if most:
        spark.conf.set(MAX_ROWS_CONF, str(most))
    try:
        found = enrich_by_season(facts, seasons, *contexts)
        for season in seasons:
            expected = enrich(facts, *contexts, (season, 0)).where(F.col("year") <= season)
            names = ["year", "round", "DriverName", *FEATURES]
            assert rows(found.where(F.col(CUTOFF) == season), *names) == rows(expected, *names)
    finally:
        spark.conf.unset(MAX_ROWS_CONF)


def test_results_are_read_once(spark, facts, calendar, extra):
    """The rows read of the results do not grow with the seasons."""
    reads = []
    for seasons in ([2021], SEASONS):
        seen = spark.sparkContext.accumulator(0)

        def counted(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        enrich_by_season(facts.mapInArrow(counted, facts.schema), seasons, calendar, extra)
        reads.append(seen.value)
    assert reads[0] == reads[1] <= 2 * facts.count()  # group sizes, then the starts


@pytest.mark.parametrize("fresh", [False, True])
def test_walk_rows(facts, calendar, extra, fresh):
    """Training rows, labels and scoring rows of the leak-free walk are those of each season on its own."""
    seasons = SEASONS[1:2] if fresh else SEASONS[1:3]
    training, wanted = _leak_free_rows(facts, seasons, calendar, extra, fresh)
    used = ["year", "round", "DriverName", "driver_id", "team_id", "circuit_id", *FEATURES]
    wanted = durable(wanted)
    for season in seasons:
        enriched = durable(enrich(facts, calendar, extra, (season, 0)))
        encoders = Encoders.fit(enriched, (season, 0))
        known = enriched.where(F.col("year") < season)
        assert rows(training(season), *used) == rows(encoders.apply(known.where("status = 'Finished'")), *used)
        entries = season_entries(enriched, F.col("year") == season, scoring_defaults(known), fresh)
        assert rows(wanted.where(F.col("year") == season), *used) == rows(encoders.apply(entries), *used)


def test_co_moments_lose_nothing(spark):
    """Equal values have no correlation, and values far from zero the one that ``correlation_by`` finds."""
    data = [("same", 2000 + k % 4, 0.1, float(k)) for k in range(11)] + [("same", 2009, 0.1, 3.0)]
    data += [("far", 2000 + k % 5, 1e8 + (k * 7) % 11 * 1e-2, -1e8 + (k * 5) % 13 * 1e-2) for k in range(60)] + [("far", 2009, None, 1.0)]
    data += [("one", 2001, 1.0, 1.0), ("one", 2003, None, 2.0), ("none", 2001, None, None)]
    df = spark.createDataFrame(data, "key string, season int, x double, y double").repartition(5)
    found = {(r.key, r.season): r.r for r in correlation_by_cutoff(df, "key", "season", "x", "y", "r", cutoffs=[2000, 2003, 2009, 2020]).collect()}
    assert len(found) == 16
    for season in (2000, 2003, 2009, 2020):
        whole = by(correlation_by(df.where(F.col("season") < season), "key", "x", "y", "r"), "key", "r")
        for key in ("same", "far", "one", "none"):
            assert found[key, season] == pytest.approx(whole.get(key, 0.5), abs=1e-6)
    assert found["same", 2020] == 0.5 and abs(found["far", 2020]) not in (0.0, 0.5)


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_medians_over_chunks(spark, monkeypatch, bits):
    """Chunks of a few values give the medians that sorting every cutoff's rows gives."""
    monkeypatch.setattr(grouped, "CHUNK_BITS", bits)
    data = [(("a", "b", None)[k % 3], 2000 + (k * k) % 6 if k % 19 else None, float((k * 7) % 31) if k % 5 else None) for k in range(400)]
    df = spark.createDataFrame(data, "key string, season int, value double").repartition(3)
    present = [d for d in data if d[1] is not None and d[2] is not None]
    seasons = sorted({d[1] for d in present})
    middle = lambda season, key: statistics.median([v for k, s, v in present if s < season and key in (k, "any")] or [None])
    assert by(medians_by_cutoff(df, "season", "value", "m"), "season", "m") == {s: middle(s, "any") for s in seasons[1:]}
    found = {(r.key, r.season): r.m for r in medians_by_cutoff(df, "season", "value", "m", ["key"], [1999, 2003, 2050]).collect()}
    assert found == {(k, s): middle(s, k) for k in "ab" for s in (2003, 2050)}
    assert medians_by_cutoff(df.limit(0), "season", "value", "m").collect() == []


def test_labels_by_cutoff(spark):
    data = [("b", 2001), ("a", 2003), (None, 2002), ("b", 2005), ("z", None)]
    df = spark.createDataFrame(data, "label string, season int")
    found = label_index_by_cutoff(df, "label", "number", "season", [2001, 2003, 2009]).collect()
    assert {(r.label, r.season): r.number for r in found} == {
        (k, s): n for s in (2001, 2003, 2009) for k, n in by(label_index(df.where(F.col("season") < s), "label", "number"), "label", "number").items()
    }
