"""Rows that break simple rules: null keys, repeated starts, NaN, late columns; and the stored tables as a whole."""

from pyspark.sql import functions as F

from paceline.functions.scalars import finished
from paceline.operators.grouped import correlation_by_cutoff, medians_by_cutoff
from paceline.operators.history import Career, Previous, with_history
from paceline.operators.joins import as_of_cutoff, as_of_previous, attach
from paceline.operators.laps import lap_seconds, stints
from paceline.operators.ranking import dense_scaled_rank
from paceline.plans.features import enrich, timing
from paceline.plans.load import load_facts, read_stored
from paceline.plans.update import update_all, update_calendar_seasons, update_sprints
from paceline.queries.ingest import BY_SEASON, ORDER_LINES, SQL as INGEST_SQL, _order_lines, _orders_by_season, _responses, lap_scan_of, late_sprints, sprint_sums
from paceline.queries.views import RACE_RESULTS, RACE_TIMING, race_results, race_timing, table
from paceline.session import fresh_path
from paceline.sources.tables import read_table, write_seasons, write_whole

ORDER = ["o_orderdate", "o_orderkey"]


def dense_scaled_nulls(spark, folder):
    """Ranks where every fourth order has no season and every fifth no price."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 4 != 0, F.year("o_orderdate")).alias("season"),
        F.when(F.col("o_orderkey") % 5 != 0, F.floor("o_totalprice")).alias("price"),
    )
    rows = dense_scaled_rank(orders, ["season"], "price", "pace_rank", rank_name="dense")
    return rows.select("o_orderkey", F.col("dense").cast("bigint"), F.round("pace_rank", 9).alias("pace_rank"))


def keyed_nulls(spark, folder):
    """Skill by customer and priority, where every third order has no priority and every seventh no customer."""
    orders = table(spark, folder, "orders").select(
        *ORDER, "o_totalprice",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    rows = with_history(orders, ["o_custkey", "o_orderpriority"], ORDER, [Career("skill", "o_totalprice", 14.0)])
    return rows.select("o_orderkey", F.round("skill", 6).alias("skill"))


def features_null_circuits(spark, folder):
    """The feature chain without a calendar, on results that name a circuit every other round only."""
    results = race_results(spark, folder)
    circuit = F.when(F.col("round") % 2 == 0, F.concat(F.lit("c"), (F.col("round") % 3).cast("string")))
    rows = enrich(results.withColumn("circuitId", circuit))
    return rows.select("year", "round", "DriverKey", *[F.round(c, 8).alias(c) for c in ("circuit_grid_skill", "career_grid_avg")])


def keyless_features(spark, folder):
    """Results without a driver key: the name in lower case takes its place."""
    rows = enrich(race_results(spark, folder).drop("DriverKey"))
    return rows.select("year", "round", "DriverKey", F.round("form_grid", 8).alias("form_grid"))


def asof_repeats(spark, folder):
    """Several starts in a race, some without a grid place: the batch form and the single form together."""
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("round"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 20).alias("grid"), "o_orderkey", "o_totalprice",
    )
    stats, tie = {"o_totalprice": 14.0}, ["grid", "o_orderkey"]
    batch = as_of_previous(orders, "entity", ["year", "round", *tie], stats, race=["year", "round"])
    targets = orders.where((F.col("year") == 1999) & (F.col("round") == 3)).select("entity", "o_orderkey")
    single = as_of_cutoff(orders, targets, "entity", "year", "round", (1999, 3), stats, tie)
    names = ["o_orderkey", "o_totalprice"]
    return batch.select(F.lit("batch").alias("form"), *names).unionByName(single.select(F.lit("single").alias("form"), *names))


def importance_by_cutoff(spark, folder):
    """How closely finishing followed the grid at each circuit, before each of its seasons."""
    rows = race_results(spark, folder).withColumn("circuit", F.concat(F.lit("c"), (F.col("round") % 6).cast("string")))
    rows = rows.where(finished("status"))
    return correlation_by_cutoff(rows, "circuit", "year", "grid", "position", "importance").withColumn(
        "importance", F.round("importance", 8)
    )


def importance_by_cutoff_offsets(spark, folder):
    """The same where a measure hardly varies beside its size, and where one does not vary at all."""
    rows = race_results(spark, folder).withColumn("circuit", F.concat(F.lit("c"), (F.col("round") % 6).cast("string")))
    rows = rows.where(finished("status")).withColumns(
        {"grid": F.when(F.col("round") % 6 == 5, 0.1).otherwise(F.col("grid") + 1e8), "position": F.col("position") * 1e-3 - 1e5}
    )
    return correlation_by_cutoff(rows, "circuit", "year", "grid", "position", "importance").withColumn(
        "importance", F.round("importance", 5)
    )


def medians_before_seasons(spark, folder):
    """The median order value before each season."""
    orders = _orders_by_season(spark, folder).withColumn("o_totalprice", F.round("o_totalprice", 0))
    return medians_by_cutoff(orders, "year", "o_totalprice", "price")


def medians_by_team_and_cutoff(spark, folder):
    """Each team's median finish in earlier seasons, for some seasons with and without rows of their own."""
    rows = race_results(spark, folder).withColumn("Team", F.when(F.col("round") != 7, F.col("Team")))
    return medians_by_cutoff(rows, "year", "position", "finish", keys=["Team"], cutoffs=[1995, 1997, 2000, 2050])


def lap_nans(spark, folder):
    """Landed laps whose stint is NaN or whose time is missing."""
    events, kind = table(spark, folder, "events"), F.col("event_type")
    laps = events.select(
        "user_id", "event_id", "ts", F.when(kind != "purchase", F.make_dt_interval(secs=F.round("value", 3).cast("decimal(18,6)"))).alias("LapTime"),
        F.lit(None).cast("interval day to second").alias("PitInTime"), F.lit(None).cast("interval day to second").alias("PitOutTime"),
        F.when(kind == "error", F.lit(float("nan"))).otherwise(F.floor((F.dayofmonth("ts") - 1) / 16).cast("double")).alias("Stint"),
        kind.alias("Compound"),
    )
    rows = stints(lap_seconds(laps), ["user_id"], order=("ts", "event_id"))
    return rows.select("user_id", "stint_count", "stint1_length", "stint2_length", F.round("stint1_avg", 6).alias("stint1_avg"))


def stored_nans(spark, folder):
    """NaN in a stored table reads as null, so one of them does not spoil a mean."""
    path = fresh_path(spark)
    orders = _orders_by_season(spark, folder)
    price = F.when(F.col("o_orderkey") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    write_whole(orders.withColumn("o_totalprice", price), path, ["o_orderkey"])
    rows = read_table(spark, path, orders.schema)
    return rows.groupBy("year").agg(F.count("o_totalprice").alias("priced"), F.round(F.avg("o_totalprice"), 4).alias("price"))


def lap_scan_repeats(spark, folder):
    """A driver list that names every driver twice gives the laps once."""
    return lap_scan_of(spark, folder, repeats=2)


def season_sink_csv_new_column(spark, folder):
    """CSV seasons that gained a column, and lost one, read by name."""
    path, rows = fresh_path(spark), _orders_by_season(spark, folder)
    early, late = rows.where(F.col("year") <= 1997), rows.where(F.col("year") > 1997)
    write_seasons(early, path, 1990, 1997, ["o_orderkey"], fmt="csv")
    later = late.select("year", F.lit("late").alias("origin"), "o_totalprice", "o_orderkey")
    write_seasons(later, path, 1998, 2005, ["o_orderkey"], fmt="csv")
    schema = "o_orderkey bigint, o_totalprice double, o_orderstatus string, origin string, year int"
    return read_table(spark, path, schema, fmt="csv")


def stored_order(spark, folder):
    """Rows of a stored season that come before a smaller key in their file: there are none."""
    path = fresh_path(spark)
    write_seasons(_orders_by_season(spark, folder), path, 1990, 2005, ["o_totalprice", "o_orderkey"])
    place = F.struct("o_totalprice", "o_orderkey")
    rows = read_table(spark, path, "year int, o_totalprice double, o_orderkey bigint").select(
        "year", place.alias("place"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    by = with_history(rows, ["file"], ["at"], [Previous("_before", "place")])
    return by.groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_before") > F.col("place")).alias("misplaced"))


def _stored(spark, folder):
    """All tables brought up to date from landed responses and laps."""
    home = fresh_path(spark)
    lines = _order_lines(spark, folder)
    laps, drivers = landed_laps(spark, folder)
    update_all(
        home, 1990, 2030, _responses(lines, "Results").drop("l_orderkey"), _responses(lines, "Results").drop("l_orderkey"),
        None, _responses(lines, "QualifyingResults").drop("l_orderkey"), laps, drivers,
    )
    return home


def sprint_sink(spark, folder):
    """Sprints stored for all seasons from the first one on; a later update of one season brings half of its rows."""
    home, lines = fresh_path(spark), _order_lines(spark, folder)
    update_sprints(late_sprints(lines).drop("l_orderkey"), home, 1990, 2030)
    update_sprints(late_sprints(lines.where(F.col("l_orderkey") % 2 == 0)).drop("l_orderkey"), home, 2022, 2022)
    return sprint_sums(read_stored(spark, home, "sprint"))


def extra_join_unkeyed(spark, folder):
    """Timing for every start, where a tenth of the starts and one timing row of each race have no driver."""
    rows = race_results(spark, folder).withColumn("DriverKey", F.when(F.length("DriverName") * 7 % 10 != (F.substring("DriverKey", -1, 1).cast("int")), F.col("DriverKey")))
    timed = race_timing(spark, folder)
    lost = timed.groupBy("year", "round").agg(F.lit(None).cast("string").alias("DriverKey"), F.max("best_lap").alias("best_lap"))
    extra = timed.select("year", "round", "DriverKey", "best_lap").unionByName(lost)
    return attach(rows, extra, ["year", "round", "DriverKey"], ["best_lap"], null_safe=["DriverKey"]).select(
        "year", "round", "DriverName", "best_lap"
    )


def landed_laps(spark, folder):
    """Events as laps of months of 1999, and their drivers."""
    events = table(spark, folder, "events")
    who = [F.lit(1999).alias("year"), (1 + F.col("event_id") % 12).cast("int").alias("round"), F.col("user_id").cast("string").alias("driver_number")]
    none = F.lit(None).cast("interval day to second")
    time = F.make_dt_interval(secs=F.round("value", 3).cast("decimal(18,6)"))
    laps = events.select(
        *who, F.col("event_id").cast("int").alias("lap_number"), time.alias("LapTime"),
        F.when(F.col("event_type") == "error", time).alias("PitInTime"), none.alias("PitOutTime"),
        F.lit(1.0).alias("Stint"), F.col("event_type").alias("Compound"),
    )
    drivers = events.select(*who).distinct().withColumns(
        {"FirstName": F.lit("Ann"), "LastName": F.lit("Lee"), "FullName": F.lit("Ann Lee"), "TeamName": F.lit("T")}
    )
    return laps, drivers


def timing_sink(spark, folder):
    """Timing of landed laps through the stored calendar and the stored timing table."""
    rows = read_stored(spark, _stored(spark, folder), "extra")
    return rows.select("year", "round", "DriverNumber", "DriverKey", "best_lap", "pitstops_count", "stint1_length")


def facts_stored(spark, folder):
    """The stored tables as one fact table; the results name no circuit, so the calendar's counts."""
    rows, times = load_facts(spark, _stored(spark, folder), times="_times"), F.col("_times")
    sprints = F.sum(F.when(F.col("sprint_pos").isNotNull(), times))
    return rows.groupBy("year", "round").agg(
        F.sum(times).alias("rows"), F.sum(F.col("grid") * times).alias("grid"), F.coalesce(sprints, F.lit(0)).alias("sprints"),
    )


def calendar_sink(spark, folder):
    """The calendar by season range: a later update of two seasons leaves the others."""
    home = fresh_path(spark)
    responses = _responses(_order_lines(spark, folder), "Results")
    update_calendar_seasons(responses, home, 1990, 2005)
    update_calendar_seasons(responses.where(F.col("l_orderkey") % 2 == 0), home, 1996, 1997)
    return read_stored(spark, home, "calendar").groupBy("year").agg(
        F.count(F.lit(1)).alias("races"), F.max("round").alias("last"), F.max("date").alias("date")
    )


def pit_loss_lists(spark, folder):
    """Timing that holds its pit losses as a list: the mean of the list counts."""
    results = race_results(spark, folder)
    extra = results.where(F.col("round") % 2 == 0).select(
        "year", "round", "DriverKey",
        F.concat(F.lit("["), F.col("grid").cast("string"), F.lit(", 4.0]")).alias("pit_losses"),
    )
    rows = timing(results, extra)
    return rows.select("year", "round", "DriverKey", F.round("mean_pit_loss", 6).alias("mean_pit_loss"), "best_lap")


QUERIES = {
    f.__name__: f
    for f in (
        dense_scaled_nulls, keyed_nulls, features_null_circuits, keyless_features, asof_repeats, importance_by_cutoff,
        importance_by_cutoff_offsets, medians_before_seasons, medians_by_team_and_cutoff, lap_nans, stored_nans,
        lap_scan_repeats, season_sink_csv_new_column, stored_order, timing_sink, facts_stored, calendar_sink, pit_loss_lists, sprint_sink,
        extra_join_unkeyed,
    )
}

LANDED_LAPS = """
laps as (
  select cast(1999 as integer) as "year", cast(1 + event_id % 12 as integer) as "round",
    cast(user_id as varchar) as "DriverNumber", round(value, 3) as lap, event_type from events)"""

SQL = {
    "dense_scaled_nulls": """
with rows_ as (
  select o_orderkey, case when o_orderkey % 4 <> 0 then year(o_orderdate) end as season,
    case when o_orderkey % 5 <> 0 then floor(o_totalprice) end as price from orders),
ranks as (
  select *, case when season is not null and price is not null
    then dense_rank() over (partition by season order by price nulls last) end as dense from rows_)
select o_orderkey, dense,
  round(coalesce(cast(dense as double) / max(dense) over (partition by season), 0.5), 9) as pace_rank from ranks""",
    "keyed_nulls": """
with rows_ as (
  select *, case when o_orderkey % 7 <> 0 then o_custkey end as entity,
    case when o_orderkey % 3 <> 0 then o_orderpriority end as kind from orders)
select o_orderkey, round(coalesce(case when entity is not null and kind is not null then
  avg(o_totalprice) over (partition by entity, kind order by o_orderdate, o_orderkey
    rows between unbounded preceding and 1 preceding) end, 14.0), 6) as skill from rows_""",
    "features_null_circuits": f"""
with {RACE_RESULTS},
placed as (select *, case when "round" % 2 = 0 then 'c' || cast("round" % 3 as varchar) end as circuit from results)
select "year", "round", "DriverKey",
  round(coalesce(case when circuit is not null then avg(grid) over (partition by "DriverKey", circuit
    order by "year", "round" rows between unbounded preceding and 1 preceding) end, 14.0), 8) as circuit_grid_skill,
  round(coalesce(avg(grid) over (partition by "DriverKey"
    order by "year", "round" rows between unbounded preceding and 1 preceding), 14.0), 8) as career_grid_avg
from placed""",
    "keyless_features": f"""
with {RACE_RESULTS}
select "year", "round", lower("DriverName") as "DriverKey", round(coalesce(avg(grid) over (partition by "DriverName"
  order by "year", "round" rows between 3 preceding and 1 preceding), 13.0), 8) as form_grid from results""",
    "asof_repeats": """
with rows_ as (
  select o_custkey as entity, year(o_orderdate) as y, quarter(o_orderdate) as q, o_orderkey, o_totalprice,
    case when o_orderkey % 3 <> 0 then o_orderkey % 20 end as grid from orders),
races as (
  select entity, y, q, o_totalprice as price from rows_
  qualify row_number() over (partition by entity, y, q order by grid desc nulls first, o_orderkey desc) = 1),
lagged as (select entity, y, q, lag(price) over (partition by entity order by y, q) as price from races)
select 'batch' as form, o_orderkey, coalesce(price, 14.0) as o_totalprice from rows_ join lagged using (entity, y, q)
union all
select 'single', o_orderkey, coalesce(price, 14.0) from rows_ join lagged using (entity, y, q) where y = 1999 and q = 3""",
    "importance_by_cutoff": f"""
with {RACE_RESULTS},
finishers as (
  select 'c' || cast("round" % 6 as varchar) as circuit, "year", grid, "position" from results
  where status in ('Finished', '+1 Lap')),
places as (select distinct circuit, "year" from finishers)
select p.circuit, p."year", round(coalesce(case when count(*) filter (known) > 1 and var_pop(x) > 0 and var_pop(y) > 0
  then covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) end, 0.5), 8) as importance
from places p left join (
  select *, grid as x, "position" as y, true as known from finishers where grid is not null and "position" is not null) f
  on f.circuit = p.circuit and f."year" < p."year"
group by 1, 2""",
    "importance_by_cutoff_offsets": f"""
with {RACE_RESULTS},
finishers as (
  select 'c' || cast("round" % 6 as varchar) as circuit, "year",
    case when "round" % 6 = 5 then cast(0.1 as double) else grid + 1e8::double end as x, "position" * 1e-3::double - 1e5::double as y
  from results where status in ('Finished', '+1 Lap')),
places as (select distinct circuit, "year" from finishers)
select p.circuit, p."year", round(coalesce(case when count(f."year") > 1 and min(x) < max(x) and min(y) < max(y)
  then covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) end, 0.5), 5) as importance
from places p left join (select * from finishers where y is not null) f on f.circuit = p.circuit and f."year" < p."year"
group by 1, 2""",
    "medians_by_team_and_cutoff": f"""
with {RACE_RESULTS},
rows_ as (select "year", "position", case when "round" <> 7 then "Team" end as "Team" from results)
select "Team", cast(c as integer) as "year", median("position") as finish
from rows_ join (select unnest([1995, 1997, 2000, 2050]) as c) on "year" < c
where "Team" is not null and "position" is not null group by 1, 2""",
    "medians_before_seasons": f"""
with {BY_SEASON}
select y."year", median(round(o.o_totalprice, 0)) as price from (select distinct "year" from old) y
join old o on o."year" < y."year" group by 1""",
    "lap_nans": """
with laps as (
  select user_id, case when event_type <> 'purchase' then round(value, 3) end as lap,
    case when event_type <> 'error' then (day(ts) - 1) // 16 end as stint from events),
each as (select user_id, stint, count(*) as n, avg(lap) as mean from laps where stint is not null group by all),
numbered as (select *, row_number() over (partition by user_id order by stint) as k from each)
select user_id, count(*) as stint_count, cast(max(n) filter (k = 1) as double) as stint1_length,
  cast(max(n) filter (k = 2) as double) as stint2_length, round(max(mean) filter (k = 1), 6) as stint1_avg
from numbered group by user_id""",
    "stored_nans": """
select cast(year(o_orderdate) as integer) as "year", count(*) filter (o_orderkey % 5 <> 0) as priced,
  round(avg(o_totalprice) filter (o_orderkey % 5 <> 0), 4) as price from orders group by 1""",
    "lap_scan_repeats": INGEST_SQL["lap_scan"],
    "season_sink_csv_new_column": f"""
with {BY_SEASON}
select o_orderkey, o_totalprice, case when "year" <= 1997 then o_orderstatus end as o_orderstatus,
  case when "year" > 1997 then 'late' end as origin, "year" from old""",
    "stored_order": f"""
with {BY_SEASON} select "year", count(*) as rows, cast(0 as bigint) as misplaced from old group by 1""",
    "timing_sink": f"""
with {LANDED_LAPS}
select "year", "round", "DriverNumber", 'a_lee' as "DriverKey", min(lap) as best_lap,
  count(*) filter (event_type = 'error') as pitstops_count, cast(count(*) as double) as stint1_length
from laps where "round" in (select month(o_orderdate) from orders where year(o_orderdate) = 1999)
group by 1, 2, 3""",
    "facts_stored": f"""
with {ORDER_LINES},
results as (select "year", "round", grid from lines),
races as (
  select "year", "round" from lines
  union all select "year", cast("round" * 10 as integer) from lines)
select r."year", r."round", count(*) as rows, sum(grid) as grid, cast(0 as bigint) as sprints
from results r left join races c on r."year" = c."year" and r."round" = c."round" group by 1, 2""",
    "calendar_sink": """
with each as (
  select cast(year(o_orderdate) as integer) as "year", cast(month(o_orderdate) as integer) as m,
    strftime(o_orderdate, '%Y-%m-%d') as "date" from orders
  where year(o_orderdate) not in (1996, 1997) or o_orderkey % 2 = 0)
select "year", 2 * count(*) as races, max(m) * 10 as last, max("date") as "date" from each group by 1""",
    "sprint_sink": f"""
with {ORDER_LINES}
select cast("year" + 23 as integer) as "year", status, count(*) as rows, sum(grid) as sprint_grid,
  sum(pos) as sprint_pos, sum(cast(l_suppkey as double)) as sprint_points
from lines where "year" + 23 >= 2021 and ("year" + 23 <> 2022 or l_orderkey % 2 = 0) group by 1, 2""",
    "extra_join_unkeyed": f"""
with {RACE_RESULTS}, {RACE_TIMING},
races as (select "year", "round", max(best_lap) as best_lap from extra group by 1, 2),
starts as (select *, length("DriverName") * 7 % 10 <> cast(right("DriverKey", 1) as integer) as keyed from results)
select s."year", s."round", "DriverName", case when keyed then e.best_lap else r.best_lap end as best_lap
from starts s left join extra e using ("year", "round", "DriverKey") left join races r using ("year", "round")""",
    "pit_loss_lists": f"""
with {RACE_RESULTS},
losses as (select *, case when "round" % 2 = 0 then (grid + 4.0) / 2 end as loss from results)
select "year", "round", "DriverKey", round(coalesce(loss, (select median(loss) from losses)), 6) as mean_pit_loss,
  cast(0 as double) as best_lap from losses""",
}
