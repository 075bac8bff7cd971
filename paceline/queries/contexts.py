"""Context joins and the whole feature table."""

from pyspark.sql import functions as F

from paceline.functions.scalars import finished
from paceline.operators.joins import attach, sprint_features, with_circuit, with_sprint, without_sprint
from paceline.plans.features import CUTOFF, enrich, enrich_by_season
from paceline.session import durable
from paceline.queries.views import (
    RACE_CALENDAR,
    RACE_RESULTS,
    RACE_SPRINTS,
    RACE_TIMING,
    race_calendar,
    race_results,
    race_sprints,
    race_timing,
    table,
)

KEY = ["year", "round", "DriverKey"]


def calendar_join(spark, folder):
    """The race's circuit for every start; one month of the calendar is missing."""
    calendar = race_calendar(spark, folder).where((F.col("year") != 1997) | (F.col("round") != 5))
    return with_circuit(race_results(spark, folder), calendar).select(*KEY, "circuitId")


def nation_join(spark, folder):
    """Orders with their customer's nation and its region, through two small lookups."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    rows = attach(orders, customers, ["c_custkey"], ["c_nationkey", "c_mktsegment"])
    rows = attach(rows, nations, ["c_nationkey"], ["n_name", "n_regionkey"])
    regions = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return attach(rows, regions, ["n_regionkey"], ["r_name"]).select("o_orderkey", "c_mktsegment", "n_name", "r_name")


def merged_circuits(spark, folder):
    """Two suffixed circuit columns folded into one."""
    orders = table(spark, folder, "orders")
    left = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    right = F.when(F.col("o_orderkey") % 2 != 0, F.col("o_orderstatus"))
    rows = orders.select("o_orderkey", left.alias("circuitId_x"), right.alias("circuitId_y"))
    return with_circuit(rows, None)


def sprint_join(spark, folder):
    return with_sprint(race_results(spark, folder), race_sprints(spark, folder)).select(
        *KEY, "sprint_pos", "sprint_grid", "sprint_points"
    )


def sprint_join_unknown(spark, folder):
    """Entries without a key meet each other, as null keys do in this join."""
    key = F.when(F.col("DriverKey").endswith("7"), F.lit(None)).otherwise(F.col("DriverKey"))
    results = race_results(spark, folder).withColumn("DriverKey", key)
    sprints = race_sprints(spark, folder).withColumn("DriverKey", key).groupBy(*KEY).agg(
        F.max("sprint_pos").alias("sprint_pos")
    )
    rows = with_sprint(results, sprints)
    return rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"), F.sum("sprint_pos").alias("sprint_pos"))


def sprint_context(spark, folder):
    rows = sprint_features(with_sprint(race_results(spark, folder), race_sprints(spark, folder)))
    return rows.select(*KEY, "has_sprint", "sprint_delta", "sprint_pos")


def no_sprint_context(spark, folder):
    """Neutral values where sprints were never merged."""
    rows = sprint_features(race_results(spark, folder))
    return rows.select(*KEY, "has_sprint", "sprint_delta", "sprint_pos", "sprint_grid")


def sprint_ablation(spark, folder):
    rows = sprint_features(with_sprint(race_results(spark, folder), race_sprints(spark, folder)))
    return without_sprint(rows).select(*KEY, "has_sprint", "sprint_delta")


def extra_join(spark, folder):
    """Timing for every start; a column both sides have gets a suffix."""
    extra = race_timing(spark, folder).withColumn("Team", F.lit("timed"))
    rows = attach(race_results(spark, folder), extra, KEY, ["avg_race_pace", "best_lap", "Team", "absent"])
    return rows.select(*KEY, "Team", "Team_extra", "avg_race_pace", "best_lap")


def finisher_filter(spark, folder):
    rows = race_results(spark, folder)
    status = F.when(F.col("round") != 4, F.col("status"))
    return rows.where(finished(status)).select(*KEY)


FEATURES = [
    "form_grid", "form_race", "circuit_importance", "avg_race_pace", "mean_pit_loss", "has_sprint", "sprint_delta",
    "career_grid_avg", "career_race_avg", "career_race_pace", "career_best_lap", "career_pit_loss",
    "circuit_grid_skill", "circuit_race_skill", "pace_rank_season",
]


def _features(spark, folder, cutoff=None):
    facts = durable(with_sprint(race_results(spark, folder), race_sprints(spark, folder)))
    rows = enrich(facts, race_calendar(spark, folder), race_timing(spark, folder), cutoff)
    return rows.select(*_feature_columns())


def _feature_columns():
    return [*KEY, *[F.round(c, 8).alias(c) if c != "has_sprint" else F.col(c) for c in FEATURES]]


def race_features(spark, folder):
    """Every feature of every start."""
    return _features(spark, folder)


def race_features_before(spark, folder):
    """The same with whole-table statistics taken from races before 2000 only."""
    return _features(spark, folder, (2000, 1))


def race_features_by_season(spark, folder):
    """The same before each of several seasons, from one pass over the results."""
    facts = with_sprint(race_results(spark, folder), race_sprints(spark, folder))
    rows = enrich_by_season(facts, FEATURE_SEASONS, race_calendar(spark, folder), race_timing(spark, folder))
    return rows.select(F.col(CUTOFF).alias("cutoff"), *_feature_columns())


FEATURE_SEASONS = (1996, 1999, 2001)

QUERIES = {
    "calendar_join": calendar_join,
    "nation_join": nation_join,
    "merged_circuits": merged_circuits,
    "sprint_join": sprint_join,
    "sprint_join_unknown": sprint_join_unknown,
    "sprint_features": sprint_context,
    "sprint_features_absent": no_sprint_context,
    "sprint_ablation": sprint_ablation,
    "extra_join": extra_join,
    "finisher_filter": finisher_filter,
    "race_features": race_features,
    "race_features_before": race_features_before,
    "race_features_by_season": race_features_by_season,
}

SPRINT_JOIN = f"with {RACE_RESULTS}, {RACE_SPRINTS}"
ON_KEY = 'using ("year", "round", "DriverKey")'


def _features_sql(cutoff="true"):
    finish = "regexp_matches(status, 'Finished|Lap|Lapped')"
    return f"""
with {RACE_RESULTS}, {RACE_CALENDAR}, {RACE_SPRINTS}, {RACE_TIMING},
facts as (
  select results.*, coalesce("circuitId", 'unknown') as "circuitId", sprint_pos, sprint_grid,
    avg_race_pace as pace_raw, best_lap as lap_raw, mean_pit_loss as loss_raw
  from results left join calendar using ("year", "round")
  left join sprints {ON_KEY} left join extra {ON_KEY}),
medians as (
  select median(pace_raw) as pace_mid, median(lap_raw) as lap_mid, median(loss_raw) as loss_mid
  from facts where {cutoff}),
filled as (
  select *, coalesce(pace_raw, pace_mid, 0.0) as avg_race_pace, coalesce(lap_raw, lap_mid, 0.0) as best_lap,
    coalesce(loss_raw, loss_mid, 0.0) as mean_pit_loss
  from facts cross join medians),
importance as (
  select "circuitId", coalesce(case when count(*) > 1 and var_pop(grid) > 0 and var_pop("position") > 0
    then covar_pop(grid, "position") / (stddev_pop(grid) * stddev_pop("position")) end, 0.5) as importance
  from facts where {finish} and grid is not null and "position" is not null and {cutoff} group by 1),
histories as (
  select *,
    avg(grid) over (e rows between 3 preceding and 1 preceding) as fg,
    avg("position") over (e rows between 3 preceding and 1 preceding) as fr,
    avg(grid) over (e rows between unbounded preceding and 1 preceding) as cg,
    avg("position") over (e rows between unbounded preceding and 1 preceding) as cr,
    avg(avg_race_pace) over (e rows between unbounded preceding and 1 preceding) as cp,
    avg(best_lap) over (e rows between unbounded preceding and 1 preceding) as cl,
    avg(mean_pit_loss) over (e rows between unbounded preceding and 1 preceding) as cm,
    avg(grid) over (c rows between unbounded preceding and 1 preceding) as sg,
    avg("position") over (c rows between unbounded preceding and 1 preceding) as sr
  from filled
  window e as (partition by "DriverKey" order by "year", "round"),
    c as (partition by "DriverKey", "circuitId" order by "year", "round")),
paced as (
  select *, coalesce(cp, median(case when {cutoff} then cp end) over (partition by "DriverKey")) as career_race_pace,
    coalesce(cl, median(case when {cutoff} then cl end) over (partition by "DriverKey")) as career_best_lap,
    coalesce(cm, median(case when {cutoff} then cm end) over (partition by "DriverKey")) as career_pit_loss
  from histories),
ranked as (
  select *, case when career_race_pace is not null
    then dense_rank() over (partition by "year" order by career_race_pace nulls last) end as dense
  from paced)
select "year", "round", "DriverKey",
  round(coalesce(fg, 13.0), 8) as form_grid, round(coalesce(fr, 13.0), 8) as form_race,
  round(coalesce(importance, 0.5), 8) as circuit_importance,
  round(avg_race_pace, 8) as avg_race_pace, round(mean_pit_loss, 8) as mean_pit_loss,
  cast(sprint_pos is not null as integer) as has_sprint,
  round(coalesce(sprint_grid - sprint_pos, 0.0), 8) as sprint_delta,
  round(coalesce(cg, 14.0), 8) as career_grid_avg, round(coalesce(cr, 14.0), 8) as career_race_avg,
  round(career_race_pace, 8) as career_race_pace, round(career_best_lap, 8) as career_best_lap,
  round(career_pit_loss, 8) as career_pit_loss,
  round(coalesce(sg, 14.0), 8) as circuit_grid_skill, round(coalesce(sr, 14.0), 8) as circuit_race_skill,
  round(coalesce(cast(dense as double) / max(dense) over (partition by "year"), 0.5), 8) as pace_rank_season
from ranked left join importance using ("circuitId")"""


SQL = {
    "calendar_join": f"""
with {RACE_RESULTS}, {RACE_CALENDAR}
select "year", "round", "DriverKey", "circuitId" from results
left join (select * from calendar where "year" <> 1997 or "round" <> 5) using ("year", "round")""",
    "nation_join": """
select o_orderkey, c_mktsegment, n_name, r_name from orders left join customer on o_custkey = c_custkey
left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
    "merged_circuits": """
select o_orderkey, coalesce(case when o_orderkey % 3 <> 0 then o_orderpriority end,
  case when o_orderkey % 2 <> 0 then o_orderstatus end) as "circuitId" from orders""",
    "sprint_join": f"""
{SPRINT_JOIN}
select "year", "round", "DriverKey", sprint_pos, sprint_grid, sprint_points from results left join sprints {ON_KEY}""",
    "sprint_join_unknown": f"""
{SPRINT_JOIN},
left_ as (select "year", "round", case when "DriverKey" not like '%7' then "DriverKey" end as "DriverKey" from results),
right_ as (
  select "year", "round", case when "DriverKey" not like '%7' then "DriverKey" end as "DriverKey",
    max(sprint_pos) as sprint_pos from sprints group by all)
select l."year", l."round", l."DriverKey", count(*) as rows, sum(sprint_pos) as sprint_pos
from left_ l left join right_ r on l."year" = r."year" and l."round" = r."round"
  and l."DriverKey" is not distinct from r."DriverKey" group by 1, 2, 3""",
    "sprint_features": f"""
{SPRINT_JOIN}
select "year", "round", "DriverKey", cast(sprint_pos is not null as integer) as has_sprint,
  coalesce(sprint_grid - sprint_pos, 0.0) as sprint_delta, coalesce(sprint_pos, grid) as sprint_pos
from results left join sprints {ON_KEY}""",
    "sprint_features_absent": f"""
with {RACE_RESULTS}
select "year", "round", "DriverKey", cast(0 as integer) as has_sprint, cast(0 as double) as sprint_delta,
  grid as sprint_pos, grid as sprint_grid from results""",
    "sprint_ablation": f"""
with {RACE_RESULTS}
select "year", "round", "DriverKey", cast(0 as integer) as has_sprint, cast(0 as double) as sprint_delta
from results""",
    "extra_join": f"""
with {RACE_RESULTS}, {RACE_TIMING}
select "year", "round", "DriverKey", "Team", case when avg_race_pace is not null then 'timed' end as "Team_extra",
  avg_race_pace, best_lap from results left join extra {ON_KEY}""",
    "finisher_filter": f"""
with {RACE_RESULTS}
select "year", "round", "DriverKey" from results where "round" <> 4 and status in ('Finished', '+1 Lap')""",
    "race_features": _features_sql(),
    "race_features_before": _features_sql('"year" < 2000'),
    "race_features_by_season": " union all ".join(
        f'select cast({s} as integer) as cutoff, * from ({_features_sql(f'"year" < {s}')}) where "year" <= {s}' for s in FEATURE_SEASONS
    ),
}
