"""Properties that hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paceline.operators.history import Career, Recent, with_history
from paceline.operators.ranking import finishing_order
from paceline.plans.features import enrich
from paceline.queries.views import race_calendar, race_results, race_timing
from tests.helpers import by, rows

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
VALUES = st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=12)


def mean(xs):
    xs = [x for x in xs if x is not None]
    return round(sum(xs) / len(xs), 9) + 0.0 if xs else None


@FEW
@given(VALUES)
def test_history_is_the_mean_of_earlier_values(spark, items):
    df = spark.createDataFrame([("e", i, v) for i, v in enumerate(items)], "e string, i int, v int")
    found = with_history(df, ["e"], ["i"], [Recent("recent", "v", 3), Career("career", "v")])
    assert by(found, "i", "recent") == {i: mean(items[max(0, i - 3):i]) for i in range(len(items))}
    assert by(found, "i", "career") == {i: mean(items[:i]) for i in range(len(items))}


@FEW
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), min_size=1, max_size=20))
def test_places_are_permutations(spark, scores):
    df = spark.createDataFrame([(1, i, g, c) for i, (g, c) in enumerate(scores)], "race int, id int, g int, c int")
    found = finishing_order(df, ["race"], "g", "c", "id").collect()
    n = len(scores)
    assert sorted(r["Grid"] for r in found) == sorted(r["Pos"] for r in found) == list(range(1, n + 1))
    assert sum(r["Delta"] for r in found) == 0


def test_own_and_later_rows_do_not_count(spark, data):
    """Features before a cutoff stay the same when everything from it on changes."""
    results, calendar, extra = race_results(spark, data), race_calendar(spark, data), race_timing(spark, data)
    later = (F.col("year") > 1999) | ((F.col("year") == 1999) & (F.col("round") >= 6))
    changed = results.withColumns({c: F.when(later, F.col(c) * 3 + 1).otherwise(F.col(c)) for c in ("grid", "position")})
    timed = extra.withColumns({c: F.when(later, F.col(c) + 40).otherwise(F.col(c)) for c in ("avg_race_pace", "best_lap")})
    names = ["year", "round", "DriverKey", "form_grid", "form_race", "career_grid_avg", "career_race_avg",
             "circuit_grid_skill", "circuit_race_skill", "circuit_importance", "avg_race_pace", "career_race_pace",
             "career_best_lap", "career_pit_loss", "pace_rank_season"]
    first = enrich(results, calendar, extra, (1999, 6)).where(~later)
    second = enrich(changed, calendar, timed, (1999, 6)).where(~later)
    assert rows(first, *names) == rows(second, *names)


def test_scaled_rank_range(spark, data):
    found = enrich(race_results(spark, data), race_calendar(spark, data), race_timing(spark, data))
    low, high = found.agg(F.min("pace_rank_season"), F.max("pace_rank_season")).first()
    assert 0 < low <= high == 1.0
    assert found.count() == race_results(spark, data).count()
