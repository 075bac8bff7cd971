"""Lap timing on events: users as drivers."""

from pyspark.sql import functions as F

from paceline.functions.scalars import seconds
from paceline.operators.laps import compound_changes, lap_seconds, pace, stints, timing_features
from paceline.queries.views import EVENT_LAPS, event_laps, table

ORDER = ("ts", "event_id")


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 8) for c in columns})


def lap_features(spark, folder):
    rows = pace(event_laps(spark, folder), ["user_id"])
    return _rounded(rows, "avg_race_pace", "best_lap", "mean_pit_loss", "long_run_consistency")


def lap_features_daily(spark, folder):
    """The same per user and day, where single laps and laps without a time are common."""
    laps = event_laps(spark, folder).withColumn("day", F.dayofmonth("ts"))
    rows = pace(laps, ["user_id", "day"])
    return _rounded(rows, "avg_race_pace", "best_lap", "mean_pit_loss", "long_run_consistency")


def stint_pivot(spark, folder):
    rows = stints(event_laps(spark, folder), ["user_id"], order=ORDER)
    return _rounded(rows, "stint1_avg", "stint2_avg", "stint3_avg", "degradation_global")


def stint_pivot_weekly(spark, folder):
    """Weeks of each type of event as stints: up to five, so the loss is often unknown."""
    laps = event_laps(spark, folder).withColumn("Stint", F.floor((F.dayofmonth("ts") - 1) / 7).cast("double"))
    laps = laps.withColumn("kind", F.coalesce("Compound", F.lit("none")))
    rows = stints(laps.where(F.col("lap").isNotNull()), ["user_id", "kind"], order=ORDER)
    rows = rows.select("user_id", "kind", "stint_count", "stint1_length", "stint3_avg", "degradation_global")
    return _rounded(rows, "stint3_avg", "degradation_global")


def compound_switches(spark, folder):
    return compound_changes(event_laps(spark, folder), ["user_id"], list(ORDER))


def timing_rows(spark, folder):
    """All timing features side by side, one row per user."""
    rows = timing_features(event_laps(spark, folder), ["user_id"], ORDER)
    doubles = [c for c, t in rows.dtypes if t == "double" and not c.endswith("_length")]
    return _rounded(rows, *doubles)


def lap_intervals(spark, folder):
    """Gaps between an order's date and its lines' ship dates as landed lap durations."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag", "l_suppkey")
    gap = F.col("l_shipdate") - F.col("o_orderdate")
    laps = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_suppkey",
        gap.alias("LapTime"),
        F.when(F.col("l_returnflag") == "R", gap).alias("PitInTime"),
        F.when(F.col("l_returnflag") == "A", gap).alias("PitOutTime"),
    )
    rows = lap_seconds(laps).groupBy("l_suppkey")
    return rows.agg(F.sum("lap").alias("seconds"), F.count_if("pit").alias("pit_laps"))


def duration_seconds(spark, folder):
    """Whole time of each event since the first of January, in seconds and as an integer."""
    gap = F.col("ts") - F.lit("2024-01-01").cast("timestamp_ntz")
    rows = table(spark, folder, "events").select("event_id", seconds(gap).alias("seconds"))
    return rows.withColumn("whole", F.col("seconds").cast("int"))


QUERIES = {
    "lap_features": lap_features,
    "lap_features_daily": lap_features_daily,
    "stint_pivot": stint_pivot,
    "stint_pivot_weekly": stint_pivot_weekly,
    "compound_changes": compound_switches,
    "timing_rows": timing_rows,
    "lap_intervals": lap_intervals,
    "duration_seconds": duration_seconds,
}


def _pace_sql(keys):
    return f"""
paces as (
  select {keys}, round(avg(lap), 8) as avg_race_pace, round(min(lap), 8) as best_lap,
    count(*) filter (pit) as pitstops_count,
    round(avg(case when pit and lap is not null then greatest(lap - middle, 0) end), 8) as mean_pit_loss,
    round(stddev_samp(lap), 8) as long_run_consistency
  from (select *, median(lap) over (partition by {keys}) as middle from laps)
  group by {keys} having count(lap) > 0)"""


def _stint_sql(keys):
    first_compound = "arg_min(compound, ts) filter (compound is not null)"
    wide = ", ".join(
        f"max(length) filter (k = {k}) as stint{k}_length, round(max(mean) filter (k = {k}), 8) as stint{k}_avg, "
        f"max(compound) filter (k = {k}) as stint{k}_compound"
        for k in (1, 2, 3)
    )
    last = "max(mean) filter (k = n)"
    return f"""
each as (
  select {keys}, stint, cast(count(*) as double) as length, avg(lap) as mean,
    {first_compound} as compound
  from laps where stint is not null group by {keys}, stint),
numbered as (
  select *, row_number() over (partition by {keys} order by stint) as k,
    count(*) over (partition by {keys}) as n from each),
stints as (
  select {keys}, count(*) as stint_count, {wide},
    max(compound) filter (k = 1) as compound_first_stint,
    round(case when max(n) <= 3 then {last} - max(mean) filter (k = 1) end, 8) as degradation_global
  from numbered group by {keys})"""


CHANGES = """
changes as (
  select user_id, count(*) filter (compound is distinct from last_) - 1 as compound_changes
  from (select user_id, compound, lag(compound) over (partition by user_id order by ts, event_id) as last_
    from laps where compound is not null)
  group by user_id)"""

FILLED_CHANGES = """
filled as (
  select user_id, ts, event_id, last_value(compound ignore nulls) over (partition by user_id order by ts, event_id
    rows between unbounded preceding and current row) as compound from laps),
marked as (
  select *, lag(compound) over (partition by user_id order by ts, event_id) as last_ from filled)
select user_id, greatest(count(*) filter (compound is distinct from last_) - 1, 0) as compound_changes
from marked group by user_id"""

SQL = {
    "lap_features": f"with {EVENT_LAPS}, {_pace_sql('user_id')} select * from paces",
    "lap_features_daily": f"""
with {EVENT_LAPS.replace('laps as', 'whole as')},
laps as (select *, cast(day(ts) as integer) as "day" from whole), {_pace_sql('user_id, "day"')} select * from paces""",
    "stint_pivot": f"with {EVENT_LAPS}, {_stint_sql('user_id')} select * from stints",
    "stint_pivot_weekly": f"""
with {EVENT_LAPS.replace('laps as', 'whole as')},
laps as (
  select user_id, ts, event_id, lap, coalesce(compound, 'none') as kind, cast((day(ts) - 1) // 7 as integer) as stint
  from whole where lap is not null),
each as (
  select user_id, kind, stint, cast(count(*) as double) as length, avg(lap) as mean
  from laps group by all),
numbered as (
  select *, row_number() over (partition by user_id, kind order by stint) as k,
    count(*) over (partition by user_id, kind) as n from each)
select user_id, kind, count(*) as stint_count, max(length) filter (k = 1) as stint1_length,
  round(max(mean) filter (k = 3), 8) as stint3_avg,
  round(case when max(n) <= 3 then max(mean) filter (k = n) - max(mean) filter (k = 1) end, 8) as degradation_global
from numbered group by user_id, kind""",
    "compound_changes": f"with {EVENT_LAPS}, {FILLED_CHANGES}",
    "timing_rows": f"""
with {EVENT_LAPS}, {_pace_sql('user_id')}, {_stint_sql('user_id')}, {CHANGES}
select paces.*, stints.* exclude (user_id) replace (coalesce(stint_count, 0) as stint_count),
  coalesce(compound_changes, 0) as compound_changes
from paces left join stints using (user_id) left join changes using (user_id)""",
    "lap_intervals": """
select l_suppkey, sum(cast(epoch(l_shipdate - o_orderdate) as double)) as seconds,
  count(*) filter (l_returnflag in ('R', 'A')) as pit_laps
from lineitem join orders on l_orderkey = o_orderkey group by l_suppkey""",
    "duration_seconds": """
select event_id, round(epoch(ts - timestamp '2024-01-01'), 6) as seconds,
  cast(floor(epoch(ts - timestamp '2024-01-01')) as integer) as whole from events""",
}
