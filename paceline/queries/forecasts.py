"""Encoded training rows, the two forests, forecasts and backtest metrics."""

from pyspark.sql import functions as F

from paceline.functions.scalars import before, finished
from paceline.operators.joins import RACE, with_sprint, without_sprint
from paceline.operators.metrics import backtest, scored
from paceline.plans.features import enrich
from paceline.plans.forecast import (
    encode,
    forecast,
    rank,
    season_entries,
    race_entries,
    train_before,
    walk_forward,
)
from paceline.plans.models import ForestSettings, importances, score, train
from paceline.queries.contexts import ON_KEY, RACE_RESULTS, RACE_SPRINTS
from paceline.session import durable
from paceline.queries.views import race_calendar, race_results, race_sprints, race_timing

KEY = ["year", "round", "DriverKey"]
# Registered runs use small forests; the defaults are those of the library.
SMALL = ForestSettings.smaller(numTrees=10, maxDepth=6)


def _facts(spark, folder):
    """Results and sprints, written once as a stored table would be."""
    return durable(with_sprint(race_results(spark, folder), race_sprints(spark, folder)))


def _enriched(spark, folder):
    return durable(enrich(_facts(spark, folder), race_calendar(spark, folder), race_timing(spark, folder)))


def training_rows(spark, folder):
    """Finishers before 2000 with numbered labels; the numbers count all rows' labels."""
    facts = _facts(spark, folder).withColumn("circuitId", F.concat(F.lit("circuit"), (F.col("round") % 6).cast("string")))
    rows, _ = encode(facts)
    return rows.where(before(*RACE, (2000, 1))).select(*KEY, "driver_id", "team_id", "circuit_id")


def scoring_rows(spark, folder):
    """The entries of one race with the stats of their last race before it."""
    enriched = _plain_features(spark, folder)
    target = race_results(spark, folder).where((F.col("year") == 2000) & (F.col("round") == 5))
    rows = race_entries(enriched, target.select("DriverKey", "Team", "grid"), 2000, 5, PLAIN_DEFAULTS)
    return rows.select(*KEY, "grid", "form_grid", "career_race_avg", "circuit_importance", "circuitId")


PLAIN_DEFAULTS = {"form_grid": 13.0, "career_race_avg": 14.0}


def _plain_features(spark, folder):
    """Stored features stand in for computed ones: a gap every sixth round."""
    rows = race_results(spark, folder)
    known = F.col("round") % 6 != 0
    return rows.withColumns(
        {
            "form_grid": F.when(known, F.col("grid") + 1),
            "career_race_avg": F.when(known, F.col("grid") * 2),
            "circuit_importance": F.col("round") / 100,
            "circuitId": F.concat(F.lit("circuit"), (F.col("round") % 6).cast("string")),
        }
    )


def scoring_rows_season(spark, folder):
    """The same for every race of 1999 and 2000 at once."""
    enriched = _plain_features(spark, folder)
    rows = season_entries(enriched, F.col("year").between(1999, 2000), PLAIN_DEFAULTS)
    return rows.select(*KEY, "form_grid", "career_race_avg", "has_sprint", "sprint_delta")


def rf_two_stage(spark, folder):
    """The forecast of one race from models trained on everything before it."""
    facts, calendar = _facts(spark, folder), race_calendar(spark, folder)
    return forecast(facts, 2000, 5, calendar, race_timing(spark, folder), settings=SMALL)


def rf_real_grid(spark, folder):
    """The same race from its real grid, with statistics from before the race only."""
    facts, calendar = _facts(spark, folder), race_calendar(spark, folder)
    return forecast(
        facts, 2000, 5, calendar, race_timing(spark, folder), use_real_grid=True, settings=SMALL, leak_free=True
    )


def rf_importances(spark, folder):
    models, _ = train_before(_enriched(spark, folder), (2000, 1), SMALL)
    grid = importances(models.grid, models.grid_features).withColumn("model", F.lit("grid"))
    race = importances(models.race, models.race_features).withColumn("model", F.lit("race"))
    return grid.unionByName(race)


def rf_ablation(spark, folder):
    """Importances of the race model without sprint features."""
    models, _ = train_before(without_sprint(_enriched(spark, folder)), (2000, 1), SMALL)
    return importances(models.race, models.race_features)


# One tree without sampling, deep enough for a leaf per value: with one feature it predicts the mean label of
# each value, which SQL can compute.
EXACT = ForestSettings.smaller(
    numTrees=1, maxDepth=12, minInstancesPerNode=1, featureSubsetStrategy="all", bootstrap=False
)


def _one_feature(spark, folder):
    """Results with the driver's number by sevens as the only feature of the grid model; the race model has the grid."""
    number = F.substring("DriverKey", 3, 20).cast("int")
    return durable(race_results(spark, folder).withColumn("form_grid", (1 + number % 7).cast("double")))


def _exact(spark, folder, use_real, settings=EXACT):
    rows = _one_feature(spark, folder)
    known = rows.where(finished("status") & before(*RACE, (2000, 1)))
    models = train(known.select("form_grid", "grid", "position"), settings)
    entries = rows.where(F.col("year") == 2000).select(*KEY, "form_grid", "grid")
    return rank(score(models, entries, use_real))


def rf_exact_grid(spark, folder):
    """The published settings of the grid model on one feature: every tree predicts the mean grid place of a value."""
    rows = _exact(spark, folder, False, ForestSettings())
    return rows.select(*KEY, F.round("Grid_Input", 6).alias("Grid_Input"), "Grid")


def _exact_columns(rows):
    return rows.select(*KEY, *[F.round(c, 8).alias(c) for c in ("Grid_Input", "Course_Score")], "Grid", "Pos", "Delta")


def rf_exact_two_stage(spark, folder):
    """Every entry of a season's races: predicted grid, score on it, both places and the gain."""
    return _exact_columns(_exact(spark, folder, False))


def rf_exact_real_grid(spark, folder):
    return _exact_columns(_exact(spark, folder, True))


def rf_exact_importances(spark, folder):
    """The only feature of each model has all the importance."""
    rows = _one_feature(spark, folder).where(finished("status") & before(*RACE, (2000, 1)))
    models = train(rows.select("form_grid", "grid", "position"), EXACT)
    grid = importances(models.grid, models.grid_features).withColumn("model", F.lit("grid"))
    race = importances(models.race, models.race_features).withColumn("model", F.lit("race"))
    return grid.unionByName(race).withColumn("rows", F.lit(rows.count()))


def rf_walk_forward(spark, folder):
    """Metrics of every season with one before it, scored by models of the seasons before, in both modes."""
    facts = _facts(spark, folder)
    seasons = sorted(r["year"] for r in facts.select("year").distinct().collect())[1:]
    placed = walk_forward(facts, seasons, race_calendar(spark, folder), race_timing(spark, folder), SMALL)
    return backtest(scored(placed.select("mode", *KEY, "Pos"), _actual(facts)), ["mode"])


def _actual(facts):
    """Places 1..n of those who finished a race, by the finish and by the grid."""
    rows = facts.where(F.col("position").isNotNull()).withColumns({"Grid_Input": F.col("grid"), "Course_Score": F.col("position")})
    return rank(rows).select(
        *KEY, F.col("Pos").cast("double").alias("position"), F.col("Grid").cast("double").alias("grid"), "sprint_pos"
    )


def _placed(spark, folder):
    """Places by the grid as the prediction, and by the finish as the actual order, written once."""
    facts = _facts(spark, folder)
    rows = facts.where(F.col("position").isNotNull())
    rows = rows.withColumns({"Grid_Input": F.col("grid"), "Course_Score": F.col("grid") + F.col("position") % 3})
    predicted = rank(rows).select(*KEY, "Pos", F.col("sprint_pos").isNotNull().cast("int").alias("has_sprint"))
    return scored(predicted, _actual(facts))


MEASURES = ["winner", "top3", "top5", "top10", "mae", "grid_mae"]


def _rounded(df):
    return df.withColumns({c: F.round(c, 9) for c in MEASURES})


def metrics_overall(spark, folder):
    return _rounded(backtest(_placed(spark, folder)))


def metrics_sprint(spark, folder):
    return _rounded(backtest(_placed(spark, folder), ["has_sprint"]))


def metrics_mode(spark, folder):
    """Two predictions side by side: the scored order and the real grid."""
    modes = F.explode(F.array(F.lit("oracle"), F.lit("analyst")))
    rows = _placed(spark, folder).withColumn("mode", modes)
    rows = rows.withColumn("Pos", F.when(F.col("mode") == "oracle", F.col("Pos")).otherwise(F.col("real_grid").cast("int")))
    return _rounded(backtest(rows, ["mode"]))


QUERIES = {
    "training_rows": training_rows,
    "scoring_rows": scoring_rows,
    "scoring_rows_season": scoring_rows_season,
    "rf_two_stage": rf_two_stage,
    "rf_real_grid": rf_real_grid,
    "rf_importances": rf_importances,
    "rf_ablation": rf_ablation,
    "rf_walk_forward": rf_walk_forward,
    "rf_exact_grid": rf_exact_grid,
    "rf_exact_two_stage": rf_exact_two_stage,
    "rf_exact_real_grid": rf_exact_real_grid,
    "rf_exact_importances": rf_exact_importances,
    "metrics_overall": metrics_overall,
    "metrics_sprint": metrics_sprint,
    "metrics_mode": metrics_mode,
}

PLAIN = f"""
with {RACE_RESULTS},
plain as (
  select *, case when "round" % 6 <> 0 then grid + 1 end as form_grid,
    case when "round" % 6 <> 0 then grid * 2 end as career_race_avg from results)"""

PLACED = f"""
with {RACE_RESULTS}, {RACE_SPRINTS},
placed as (
  select "year", "round", "DriverKey", cast(sprint_pos is not null as integer) as has_sprint,
    row_number() over (partition by "year", "round" order by grid + "position" % 3, "DriverKey") as pos,
    row_number() over (partition by "year", "round" order by "position", "DriverKey") as actual,
    row_number() over (partition by "year", "round" order by grid, "DriverKey") as real_grid
  from results left join sprints {ON_KEY} where "position" is not null)"""

MEASURE_SQL = """
  round(avg(case when pos = 1 then cast(pos = actual as integer) end), 9) as winner,
  round(avg(case when pos <= 3 then cast(pos = actual as integer) end), 9) as top3,
  round(avg(case when pos <= 5 then cast(pos = actual as integer) end), 9) as top5,
  round(avg(case when pos <= 10 then cast(pos = actual as integer) end), 9) as top10,
  round(avg(abs(pos - actual)), 9) as mae, round(avg(abs(real_grid - actual)), 9) as grid_mae, count(*) as rows"""

# The tree parts neighbouring values in the middle, so a predicted place counts as the next whole one below x + 0.5.
EXACT_SQL = f"""
with {RACE_RESULTS},
numbered as (select *, 1 + cast(substr("DriverKey", 3) as integer) % 7 as form from results),
known as (select * from numbered where status in ('Finished', '+1 Lap') and "year" < 2000),
grids as (select form, avg(grid) as mean from known group by 1),
finishes as (select grid as value, avg("position") as mean from known where "position" is not null group by 1),
entries as (select "year", "round", "DriverKey", {{grid_input}} as grid_input
  from numbered join grids using (form) where "year" = 2000),
placed as (
  select "year", "round", "DriverKey", grid_input, mean as score from entries join finishes on value = ceil(grid_input - 0.5)),
ranked as (
  select *, row_number() over (partition by "year", "round" order by grid_input, "DriverKey") as g,
    row_number() over (partition by "year", "round" order by score, "DriverKey") as p from placed)"""
EXACT_RESULT = """
select "year", "round", "DriverKey", round(grid_input, 8) as "Grid_Input", round(score, 8) as "Course_Score",
  g as "Grid", p as "Pos", g - p as "Delta" from ranked"""

SQL = {
    "rf_exact_grid": EXACT_SQL.format(grid_input="mean") + """
select "year", "round", "DriverKey", round(grid_input, 6) as "Grid_Input", g as "Grid" from ranked""",
    "rf_exact_two_stage": EXACT_SQL.format(grid_input="mean") + EXACT_RESULT,
    "rf_exact_real_grid": EXACT_SQL.format(grid_input="grid") + EXACT_RESULT,
    "rf_exact_importances": EXACT_SQL.format(grid_input="grid") + """
select 'form_grid' as feature, cast(1 as double) as importance, 'grid' as model, cast(count(*) as integer) as rows from known
union all select 'grid', 1, 'race', cast(count(*) as integer) from known""",
    "training_rows": f"""
with {RACE_RESULTS},
encoded as (
  select *, cast(dense_rank() over (order by "DriverKey") - 1 as integer) as driver_id,
    cast(dense_rank() over (order by "Team") - 1 as integer) as team_id,
    cast("round" % 6 as integer) as circuit_id
  from results)
select "year", "round", "DriverKey", driver_id, team_id, circuit_id from encoded
where status in ('Finished', '+1 Lap') and "year" < 2000""",
    "scoring_rows": f"""
{PLAIN},
last_ as (
  select "DriverKey", form_grid, career_race_avg from plain where ("year", "round") < (2000, 5)
  qualify row_number() over (partition by "DriverKey" order by "year" desc, "round" desc) = 1)
select r."year", r."round", r."DriverKey", r.grid, coalesce(l.form_grid, 13.0) as form_grid,
  coalesce(l.career_race_avg, 14.0) as career_race_avg, cast(0.05 as double) as circuit_importance,
  'circuit5' as "circuitId"
from results r left join last_ l using ("DriverKey") where r."year" = 2000 and r."round" = 5""",
    "scoring_rows_season": f"""
{PLAIN},
lagged as (
  select "year", "round", "DriverKey", coalesce(lag(form_grid) over w, 13.0) as form_grid,
    coalesce(lag(career_race_avg) over w, 14.0) as career_race_avg, cast(0 as integer) as has_sprint,
    cast(0 as double) as sprint_delta
  from plain window w as (partition by "DriverKey" order by "year", "round"))
select * from lagged where "year" between 1999 and 2000""",
    "metrics_overall": f"{PLACED} select {MEASURE_SQL} from placed",
    "metrics_sprint": f"{PLACED} select has_sprint, {MEASURE_SQL} from placed group by has_sprint",
    "metrics_mode": f"""
{PLACED},
modes as (
  select 'oracle' as mode, pos, actual, real_grid from placed
  union all select 'analyst', real_grid, actual, real_grid from placed)
select mode, {MEASURE_SQL} from modes group by mode""",
}
