"""Two-stage forecasts by trees over all features, whose every split SQL can search for."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from paceline.operators.catalog import participants
from paceline.plans.features import ORDER, enrich
from paceline.plans.forecast import LABELS, rank, scoring_defaults, season_entries, train_before
from paceline.plans.models import GRID_FEATURES, RACE_FEATURES, ForestSettings, importances, score
from paceline.operators.joins import with_sprint
from paceline.queries.contexts import FEATURES, KEY, SQL as CONTEXT_SQL
from paceline.queries.views import RACE_CALENDAR, RACE_RESULTS, race_calendar, race_results, race_sprints, race_timing
from paceline.session import durable

LEAST = 20
DEPTH = 2
# One tree without sampling, with a bin for every value: it takes the best of all splits of all features.
TREE = ForestSettings.smaller(
    numTrees=1, maxDepth=DEPTH, minInstancesPerNode=LEAST, featureSubsetStrategy="all", bootstrap=False, maxBins=100_000
)
# What the trees and the places need of a start; anything else would be shuffled and written along with it.
NEEDED = list(dict.fromkeys([*ORDER, "position", "status", *LABELS, *GRID_FEATURES, *RACE_FEATURES]))


def _features(spark, folder):
    """Every feature of every start, rounded, so that equal values are equal everywhere."""
    facts = with_sprint(race_results(spark, folder), race_sprints(spark, folder))
    facts = durable(facts.drop("DriverName", "sprint_points"))
    rows = enrich(facts, race_calendar(spark, folder), race_timing(spark, folder))
    rows = rows.withColumns({c: F.round(c, 8) for c in FEATURES if c != "has_sprint"})
    return durable(rows.select(*[c for c in rows.columns if c in NEEDED]))


def tree_two_stage(spark, folder):
    """Every entry of a season in both modes: trees over all features, trained on the finishers of earlier seasons."""
    rows = _features(spark, folder)
    models, encoders = train_before(rows, (2000, 1), TREE)
    entries = encoders.apply(season_entries(rows.drop("position", "status"), F.col("year") == 2000, scoring_defaults(rows)))
    both = durable(entries).withColumn("mode", F.explode(F.array(F.lit("oracle"), F.lit("analyst"))))
    placed = rank(score(models, both, F.col("mode") == "analyst"), ["year", "round", "mode"])
    return placed.select("mode", *KEY, *[F.round(c, 6).alias(c) for c in ("Grid_Input", "Course_Score")], "Grid", "Pos", "Delta")


def tree_importances(spark, folder):
    """Both trees' importances with the place that each feature has in the list."""
    models, _ = train_before(_features(spark, folder), (2000, 1), TREE)
    parts = [("grid", models.grid, models.grid_features), ("race", models.race, models.race_features)]
    listed = [_placed(importances(m, f), "importance").withColumn("model", F.lit(name)) for name, m, f in parts]
    rows = listed[0].unionByName(listed[1]).where("importance > 0")
    return rows.select("model", "feature", F.round("importance", 6).alias("importance"), "place")


def _placed(rows, *columns):
    """The rows with the place at which they come."""
    rows = durable(rows.withColumn("_at", F.monotonically_increasing_id()))
    return rows.withColumn("place", F.row_number().over(Window.orderBy("_at"))).drop("_at")


def participants_order(spark, folder):
    """The grid places of a race's participants, in the order in which they are listed; some have none."""
    rows = race_results(spark, folder).withColumn("grid", F.when(F.col("grid") % 7 != 3, F.col("grid")))
    return _placed(participants(rows, 1997, 8).select("grid")).select("place", "grid")


QUERIES = {f.__name__: f for f in (tree_two_stage, tree_importances, participants_order)}

STATS = ["form_grid", "form_race", "career_grid_avg", "career_race_avg", "circuit_grid_skill", "circuit_race_skill", "pace_rank_season"]
# What stands in for an entry without an earlier start.
DEFAULTS = [13.0, 15.0, 14.0, 14.0, 14.0, 14.0, 0.5]
PACE = ["career_race_pace", "career_best_lap", "career_pit_loss"]


def _grown(name, rows, entries, features, label):
    """CTEs: a tree of DEPTH levels on ``rows`` (node means in {name}_leaves) and the leaf of each of ``entries``."""
    listed = lambda source, more: " union all ".join(
        f'select id, {k} as f, cast("{c}" as double) as v{more} from {source}' for k, c in enumerate(features)
    )
    out = [
        f"{name}_long as ({listed(rows, f', "{label}" as y')})", f"{name}_asked as ({listed(entries, '')})",
        f"{name}_at0 as (select distinct id, 1 as node from {name}_long)", f"{name}_in0 as (select distinct id, 1 as node from {name}_asked)",
    ]
    for level in range(DEPTH):
        out.append(f"""
{name}_best{level} as (
  select node, f, (v + next) / 2 as t, gain from (
    select *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n as gain from (
      select node, f, v, lead(v) over w as next, sum(m) over w as nl, sum(y) over w as sl,
        sum(m) over (partition by node, f) as n, sum(y) over (partition by node, f) as s
      from (select node, f, v, count(*) as m, sum(y) as y from {name}_long join {name}_at{level} using (id) group by all)
      window w as (partition by node, f order by v))
    where next is not null and nl >= {LEAST} and n - nl >= {LEAST})
  qualify row_number() over (partition by node order by gain desc, f, v) = 1)""")
        for at, source in (("at", "long"), ("in", "asked")):
            out.append(f"""
{name}_{at}{level + 1} as (
  select a.id, 2 * a.node + coalesce(cast(x.v > b.t as integer), 0) as node
  from {name}_{at}{level} a left join {name}_best{level} b using (node) left join {name}_{source} x on x.id = a.id and x.f = b.f)""")
    out.append(f"""
{name}_leaves as (
  select node, avg(y) as mean from (select distinct id, y from {name}_long) join {name}_at{DEPTH} using (id) group by 1)""")
    return ", ".join(out)


def _known():
    """CTEs: every start with features and label numbers, training rows and the entries of 2000 before the grid is known."""
    last = ", ".join(f"coalesce(lag({c}) over e, {d}) as {c}" for c, d in zip(STATS, DEFAULTS))
    last_pace = ", ".join(f"coalesce(lag({c}) over e, (select median({c}) from starts)) as {c}" for c in PACE)
    filled = ", ".join(f"coalesce({c}, (select median({c}) from finishers)) as {c}" for c in PACE)
    return f"""
with feats as ({CONTEXT_SQL['race_features']}), {RACE_RESULTS}, {RACE_CALENDAR},
starts as (
  select f.*, grid, "position", status,
    dense_rank() over (order by "DriverKey") - 1 as driver_id, dense_rank() over (order by "Team") - 1 as team_id,
    dense_rank() over (order by coalesce("circuitId", 'unknown')) - 1 as circuit_id,
    row_number() over (order by "year", "round", "DriverKey") as id
  from feats f join results using ("year", "round", "DriverKey") left join calendar using ("year", "round")),
finishers as (select * from starts where regexp_matches(status, 'Finished|Lap|Lapped') and "year" < 2000),
known as (select * replace ({filled}) from finishers),
raced as (select * from known where "position" is not null),
lagged as (
  select * replace ({last}, {last_pace}, 0 as has_sprint, 0.0 as sprint_delta) from starts
  window e as (partition by "DriverKey" order by "year", "round")),
entries as (select * from lagged where "year" = 2000)"""


def _two_stage():
    return f"""{_known()},
{_grown('g', 'known', 'entries', GRID_FEATURES, 'grid')},
gridded as (
  select 2 * id + k as id, id as entry, case k when 0 then 'oracle' else 'analyst' end as mode,
    case k when 0 then mean else grid end as "Grid_Input"
  from entries join g_in{DEPTH} using (id) join g_leaves using (node), (select unnest([0, 1]) as k)),
staged as (select e.* replace (g.id as id, g."Grid_Input" as grid), g.mode from entries e join gridded g on g.entry = e.id),
{_grown('r', 'raced', 'staged', RACE_FEATURES, 'position')},
ranked as (
  select mode, "year", "round", "DriverKey", grid, mean,
    row_number() over (partition by "year", "round", mode order by grid, "DriverKey") as g,
    row_number() over (partition by "year", "round", mode order by mean, "DriverKey") as p
  from staged join r_in{DEPTH} using (id) join r_leaves using (node))
select mode, "year", "round", "DriverKey", round(grid, 6) as "Grid_Input", round(mean, 6) as "Course_Score",
  g as "Grid", p as "Pos", g - p as "Delta" from ranked"""


def _importances():
    parts = []
    for name, features in (("g", GRID_FEATURES), ("r", RACE_FEATURES)):
        gains = " union all ".join(f"select f, gain from {name}_best{k}" for k in range(DEPTH))
        names = ", ".join(f"'{f}'" for f in features)
        parts.append(f"""
select '{'grid' if name == 'g' else 'race'}' as model, ([{names}])[f + 1] as feature, round(sum(gain) / sum(sum(gain)) over (), 6) as importance,
  cast(row_number() over (order by sum(gain) desc) as integer) as place from ({gains}) where gain > 0 group by f""")
    none = "entries"
    return f"""{_known()},
{_grown('g', 'known', none, GRID_FEATURES, 'grid')}, {_grown('r', 'raced', none, RACE_FEATURES, 'position')}
{" union all ".join(parts)}"""


SQL = {
    "tree_two_stage": _two_stage(),
    "tree_importances": _importances(),
    "participants_order": f"""
with {RACE_RESULTS},
race as (select distinct "DriverKey", "Team", case when grid % 7 <> 3 then grid end as grid from results where "year" = 1997 and "round" = 8)
select cast(row_number() over (order by grid nulls last) as integer) as place, grid from race""",
}
