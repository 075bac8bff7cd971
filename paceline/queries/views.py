"""The given tables in the shapes the operators expect, and the same views in SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder, name) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def seasoned_orders(spark, folder) -> DataFrame:
    """Orders with the season they fall in."""
    return table(spark, folder, "orders").withColumn("season", F.year("o_orderdate"))


def race_results(spark, folder) -> DataFrame:
    """Customers as drivers, months as races: a customer's orders of a month make one start."""
    orders = table(spark, folder, "orders")
    price = F.floor("o_totalprice")
    return (
        orders.groupBy(
            F.concat(F.lit("c_"), F.col("o_custkey").cast("string")).alias("DriverKey"),
            F.year("o_orderdate").alias("year"),
            F.month("o_orderdate").alias("round"),
        )
        .agg(
            F.min(1 + F.col("o_orderkey") % 20).cast("double").alias("grid"),
            F.min(F.when(price % 13 != 0, 1 + price % 20)).cast("double").alias("position"),
            F.max(F.when(F.col("o_orderstatus") == "P", "Engine").when(F.col("o_orderstatus") == "F", "+1 Lap")
                  .otherwise("Finished")).alias("status"),
            F.min("o_orderpriority").alias("Team"),
        )
        .withColumn("DriverName", F.concat(F.lit("Customer "), F.substring("DriverKey", 3, 20)))
    )


RACE_RESULTS = """
results as (
  select 'c_' || cast(o_custkey as varchar) as "DriverKey",
    cast(year(o_orderdate) as integer) as "year", cast(month(o_orderdate) as integer) as "round",
    cast(min(1 + o_orderkey % 20) as double) as grid,
    cast(min(case when cast(floor(o_totalprice) as bigint) % 13 <> 0
      then 1 + cast(floor(o_totalprice) as bigint) % 20 end) as double) as position,
    max(case o_orderstatus when 'P' then 'Engine' when 'F' then '+1 Lap' else 'Finished' end) as status,
    min(o_orderpriority) as "Team",
    'Customer ' || cast(o_custkey as varchar) as "DriverName"
  from orders group by o_custkey, 2, 3)"""


def race_calendar(spark, folder) -> DataFrame:
    """One race per month with orders; six circuits take turns. Few rows: one per month."""
    months = table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("round")
    )
    return months.distinct().select(
        "year",
        "round",
        F.concat(F.lit("Grand Prix "), F.col("round").cast("string")).alias("raceName"),
        F.concat(F.lit("circuit"), (F.col("round") % 6).cast("string")).alias("circuitId"),
    )


RACE_CALENDAR = """
calendar as (
  select distinct cast(year(o_orderdate) as integer) as "year", cast(month(o_orderdate) as integer) as "round",
    'Grand Prix ' || cast(month(o_orderdate) as varchar) as "raceName",
    'circuit' || cast(month(o_orderdate) % 6 as varchar) as "circuitId"
  from orders)"""


def race_sprints(spark, folder) -> DataFrame:
    """Every third race of a season has a sprint, run by the starters in the front half."""
    rows = race_results(spark, folder)
    return rows.where((F.col("round") % 3 == 0) & (F.col("grid") <= 10)).select(
        "year",
        "round",
        "DriverKey",
        F.col("grid").alias("sprint_grid"),
        F.col("position").alias("sprint_pos"),
        (20 - F.col("grid")).alias("sprint_points"),
    )


RACE_SPRINTS = """
sprints as (
  select "year", "round", "DriverKey", grid as sprint_grid, position as sprint_pos, 20 - grid as sprint_points
  from results where "round" % 3 = 0 and grid <= 10)"""


def race_timing(spark, folder) -> DataFrame:
    """Timing of the starts that placed an urgent or a high-priority order that month."""
    orders = table(spark, folder, "orders")
    return (
        orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .groupBy(
            F.concat(F.lit("c_"), F.col("o_custkey").cast("string")).alias("DriverKey"),
            F.year("o_orderdate").alias("year"),
            F.month("o_orderdate").alias("round"),
        )
        .agg(
            F.max(80 + F.floor("o_totalprice") % 20).cast("double").alias("avg_race_pace"),
            F.min(70 + F.floor("o_totalprice") % 20).cast("double").alias("best_lap"),
            F.count(F.lit(1)).alias("pitstops_count"),
            F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 20 + F.col("o_orderkey") % 9))
            .cast("double").alias("mean_pit_loss"),
        )
    )


RACE_TIMING = """
extra as (
  select 'c_' || cast(o_custkey as varchar) as "DriverKey",
    cast(year(o_orderdate) as integer) as "year", cast(month(o_orderdate) as integer) as "round",
    cast(max(80 + cast(floor(o_totalprice) as bigint) % 20) as double) as avg_race_pace,
    cast(min(70 + cast(floor(o_totalprice) as bigint) % 20) as double) as best_lap,
    count(*) as pitstops_count,
    cast(max(case when o_orderpriority = '1-URGENT' then 20 + o_orderkey % 9 end) as double) as mean_pit_loss
  from orders where o_orderpriority in ('1-URGENT', '2-HIGH') group by o_custkey, 2, 3)"""


def event_laps(spark, folder) -> DataFrame:
    """Events as laps: users drive, errors are pit laps without a compound, days are stints.

    Purchases carry no lap time, to exercise the null rules.
    """
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "user_id",
        "event_id",
        "ts",
        F.when(kind != "purchase", F.col("value")).alias("lap"),
        (kind == "error").alias("pit"),
        F.floor((F.dayofmonth("ts") - 1) / 8).cast("double").alias("Stint"),
        F.when(kind != "error", kind).alias("Compound"),
    )


EVENT_LAPS = """
laps as (
  select user_id, event_id, ts, case when event_type <> 'purchase' then value end as lap,
    event_type = 'error' as pit, cast((day(ts) - 1) // 8 as integer) as stint,
    case when event_type <> 'error' then event_type end as compound
  from events)"""
