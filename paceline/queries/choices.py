"""Race lookups, participants, the choice of a grid, and plain projections."""

from pyspark.sql import functions as F

from paceline.functions.scalars import before, name_matches, number, outside
from paceline.operators.catalog import (
    choose_entries,
    find_races,
    grid_input,
    has_grid,
    key_collisions,
    participants,
    with_display_name,
)
from paceline.queries.views import RACE_CALENDAR, RACE_RESULTS, race_calendar, race_results, table
from paceline.sources.tables import has_race, present, read_race

KEY = ["year", "round", "DriverKey"]


def name_search(spark, folder):
    """Parts whose name matches a pattern in any case; gaps do not match."""
    name = F.when(F.col("p_partkey") % 6 != 0, F.col("p_name"))
    parts = table(spark, folder, "part")
    return parts.where(name_matches(name, "RING|b.lt$")).select("p_partkey", "p_name")


def race_search(spark, folder):
    """The races named 1 or 10 to 12: one per season, the last one, and the first name."""
    return find_races(race_calendar(spark, folder), "prix 1")


def race_participants(spark, folder):
    return participants(race_results(spark, folder), 1997, 8)


def race_rows(spark, folder):
    """The listed columns of one race."""
    return read_race(race_results(spark, folder), 1998, 2, [*KEY, "grid", "absent"])


def project_present(spark, folder):
    return present(table(spark, folder, "orders"), ["o_orderkey", "nothing", "o_orderstatus"])


def numeric_coercion(spark, folder):
    """Texts to numbers: status letters, blanks and padded numbers."""
    text = (
        F.when(F.col("l_returnflag") == "R", "R")
        .when(F.col("l_linestatus") == "O", F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")))
        .when(F.col("l_returnflag") == "A", F.col("l_linenumber").cast("string"))
    )
    lines = table(spark, folder, "lineitem").select("l_suppkey", number(text).alias("x"))
    return lines.groupBy("l_suppkey").agg(F.count("x").alias("numbers"), F.sum("x").alias("total"))


def history_before(spark, folder):
    """Starts strictly before the fourth race of 1998."""
    return race_results(spark, folder).where(before("year", "round", (1998, 4))).select(*KEY)


def outside_range(spark, folder):
    """Orders outside 1996-1999; a missing season is outside nothing."""
    season = F.when(F.col("o_orderkey") % 8 != 0, F.year("o_orderdate"))
    orders = table(spark, folder, "orders").select("o_orderkey", season.alias("season"))
    return orders.where(outside("season", 1996, 1999))


def grid_choice(spark, folder):
    """Real or predicted grid per start: wanted in odd rounds, known for most."""
    rows = race_results(spark, folder).select(
        *KEY,
        F.when(F.col("grid") < 18, F.col("grid")).alias("real"),
        (F.col("grid") / 2 + 3).alias("predicted"),
    )
    return rows.select(*KEY, grid_input("predicted", "real", F.col("round") % 2 == 1).alias("Grid_Input"))


def entry_source(spark, folder):
    """No grid in the race's own rows: the latest qualifying steps in, if it is of that race."""
    results = race_results(spark, folder)
    unknown = results.withColumn("grid", F.lit(None).cast("double"))
    latest = results.where((F.col("year") == 1999) & (F.col("round") == 3))
    entries = participants(unknown, 1999, 3)
    chosen, real = choose_entries(entries, latest, 1999, 3, True)
    other, real_other = choose_entries(entries, latest, 1999, 4, True)
    return chosen.select("DriverKey", "grid", F.lit(real).alias("real"), F.lit(has_grid(entries)).alias("known")).unionByName(
        other.select("DriverKey", "grid", F.lit(real_other).alias("real"), F.lit(has_race(latest, 1999, 4)).alias("known"))
    )


def display_choice(spark, folder):
    """Name from the history where there is one, else the key in title case."""
    results = race_results(spark, folder)
    names = results.where(F.col("round") <= 6).withColumn(
        "DriverName", F.concat("DriverName", F.lit(" of "), F.col("year").cast("string"))
    )
    return with_display_name(results.select(*KEY), names, ["year", "round"])


def collisions(spark, folder):
    """Shared keys: here the first two digits of a customer's number."""
    rows = race_results(spark, folder).withColumn("DriverKey", F.substring("DriverKey", 1, 4))
    return key_collisions(rows)


QUERIES = {
    "name_search": name_search,
    "race_search": race_search,
    "race_participants": race_participants,
    "race_rows": race_rows,
    "project_present": project_present,
    "numeric_coercion": numeric_coercion,
    "history_before": history_before,
    "outside_range": outside_range,
    "grid_choice": grid_choice,
    "entry_source": entry_source,
    "display_choice": display_choice,
    "key_collisions": collisions,
}

SQL = {
    "name_search": """
select p_partkey, p_name from part
where p_partkey % 6 <> 0 and regexp_matches(p_name, 'RING|b.lt$', 'i')""",
    "race_search": f"""
with {RACE_CALENDAR},
found as (select * from calendar where regexp_matches("raceName", 'prix 1', 'i'))
select "year", cast(max("round") as integer) as "round",
  (select arg_min("raceName", "year" * 100 + "round") from found) as first_name
from found group by "year\"""",
    "race_participants": f"""
with {RACE_RESULTS}
select distinct "DriverKey", "Team", grid from results where "year" = 1997 and "round" = 8""",
    "race_rows": f"""
with {RACE_RESULTS}
select "year", "round", "DriverKey", grid from results where "year" = 1998 and "round" = 2""",
    "project_present": "select o_orderkey, o_orderstatus from orders",
    "numeric_coercion": """
with texts as (
  select l_suppkey, case when l_returnflag = 'R' then 'R'
    when l_linestatus = 'O' then ' ' || cast(l_quantity as varchar) || ' '
    when l_returnflag = 'A' then cast(l_linenumber as varchar) end as x from lineitem)
select l_suppkey, count(try_cast(x as double)) as numbers, sum(try_cast(x as double)) as total
from texts group by l_suppkey""",
    "history_before": f"""
with {RACE_RESULTS}
select "year", "round", "DriverKey" from results where ("year", "round") < (1998, 4)""",
    "outside_range": """
select o_orderkey, cast(year(o_orderdate) as integer) as season from orders
where o_orderkey % 8 <> 0 and year(o_orderdate) not between 1996 and 1999""",
    "grid_choice": f"""
with {RACE_RESULTS}
select "year", "round", "DriverKey",
  case when "round" % 2 = 1 and grid < 18 then grid else grid / 2 + 3 end as "Grid_Input" from results""",
    "entry_source": f"""
with {RACE_RESULTS}, race as (select "DriverKey", grid from results where "year" = 1999 and "round" = 3)
select "DriverKey", grid, true as real, false as known from race
union all
select distinct "DriverKey", cast(null as double), false, false from race""",
    "display_choice": f"""
with {RACE_RESULTS},
named as (
  select "DriverKey", "DriverName" || ' of ' || cast("year" as varchar) as name from results where "round" <= 6
  qualify row_number() over (partition by "DriverKey" order by "year" desc, "round" desc) = 1)
select r."year", r."round", r."DriverKey", coalesce(name, upper(r."DriverKey"[1]) || r."DriverKey"[2:]) as "DriverName"
from results r left join named using ("DriverKey")""",
    "key_collisions": f"""
with {RACE_RESULTS}
select substr("DriverKey", 1, 4) as "DriverKey", count(distinct "DriverName") as names from results
group by 1 having count(distinct "DriverName") > 1""",
}
