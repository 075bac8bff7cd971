"""Landed responses, stored tables and text scalars."""

from pyspark.sql import functions as F

from paceline import schemas
from paceline.functions.scalars import entity_key, full_name, letters_only, list_mean, number, title_key
from paceline.operators.laps import timing_features
from paceline.queries.views import table
from paceline.session import fresh_path
from paceline.sources import landed
from paceline.sources.tables import (
    read_table,
    replace_seasons,
    sprint_range,
    with_defaults,
    write_latest,
    write_seasons,
    write_whole,
)


# Lines of a landed file.
LANDED_LINES = 500_000


def _order_lines(spark, folder):
    """Orders in the shape of lines."""
    orders, key = table(spark, folder, "orders"), F.col("o_orderkey")
    flag = F.when(F.col("o_orderpriority") == "1-URGENT", "A").when(F.col("o_orderpriority") == "2-HIGH", "N").otherwise("R")
    return orders.select(
        key.alias("l_orderkey"), F.col("o_custkey").alias("l_suppkey"), F.col("o_custkey").alias("l_partkey"),
        (1 + key % 7).alias("l_linenumber"), (key % 50).alias("l_quantity"), (key % 10 / 100).alias("l_tax"),
        flag.alias("l_returnflag"), F.col("o_orderstatus").alias("l_linestatus"), F.col("o_orderdate").alias("l_shipdate"),
    )


def _responses(lines, list_name):
    """Every line as the text of a response: its race first, a second race after it."""
    line = F.struct(
        F.struct(
            F.when(F.col("l_returnflag") == "A", "Änne").when(F.col("l_returnflag") == "N", "nïco").alias("givenName"),
            F.concat(F.lit("Ø"), "l_linestatus", F.lit("rémy-"), F.col("l_suppkey").cast("string")).alias("familyName"),
        ).alias("Driver"),
        F.struct(F.when(F.col("l_tax") > 0.01, F.concat(F.lit("Team "), F.col("l_partkey").cast("string"))).alias("name"))
        .alias("Constructor"),
        F.when(F.col("l_returnflag") == "R", "R").otherwise(F.col("l_linenumber").cast("string")).alias("position"),
        F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string"), F.lit(" ")).alias("grid"),
        F.col("l_suppkey").cast("string").alias("points"),
        F.col("l_linestatus").alias("status"),
    )

    def race(round_text, entries):
        return F.struct(
            F.year("l_shipdate").cast("string").alias("season"),
            round_text.alias("round"),
            F.concat(F.lit("Race "), round_text).alias("raceName"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
            F.struct(F.lower("l_linestatus").alias("circuitId")).alias("Circuit"),
            entries.alias(list_name),
        )

    month = F.month("l_shipdate").cast("string")
    races = F.array(race(month, F.array(line)), race(F.concat(month, F.lit("0")), F.array(line)))
    response = F.struct(F.struct(F.struct(races.alias("Races")).alias("RaceTable")).alias("MRData"))
    texts = lines.select("l_orderkey", F.to_json(response).alias("body"))
    return landed.parse_responses(texts, "body")


def json_results(spark, folder):
    """Whole results per driver key; only the first race of a response counts."""
    rows = landed.race_results(_responses(table(spark, folder, "lineitem"), "Results"))
    return rows.groupBy("DriverKey", "year", "round", "status").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("grid").alias("grid"),
        F.sum("position").alias("position"),
        F.max("DriverName").alias("name"),
        F.min("Team").alias("team"),
        F.min("points").alias("points"),
    )


def json_qualifying(spark, folder):
    rows = landed.qualifying_results(_responses(_order_lines(spark, folder), "QualifyingResults"))
    return rows.groupBy("l_orderkey", "year", "round").agg(F.count("grid").alias("placed"), F.sum("grid").alias("grid"))


def late_sprints(lines):
    """Sprint responses from the first sprint season on; the given lines end before it, so shift them."""
    responses = _responses(lines, "SprintResults")
    races = F.transform(
        F.col("MRData.RaceTable.Races"),
        lambda r: r.withField("season", (r["season"].cast("int") + 23).cast("string")),
    )
    return responses.withColumn("MRData", F.struct(F.struct(races.alias("Races")).alias("RaceTable")))


def json_sprints(spark, folder):
    """Sprints from their first season on."""
    return sprint_sums(landed.sprint_results(late_sprints(_order_lines(spark, folder))))


def sprint_sums(rows):
    return rows.groupBy("year", "status").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("sprint_grid").alias("sprint_grid"),
        F.sum("sprint_pos").alias("sprint_pos"),
        F.sum("sprint_points").alias("sprint_points"),
    )


def json_calendar(spark, folder):
    """All races of all responses, each once."""
    rows = landed.calendar(_responses(_order_lines(spark, folder), "Results"))
    return rows.select("year", "round", "raceName", "circuitId", "date").distinct()


def json_props(spark, folder):
    """The number in each event's properties; a text that is no number is null."""
    props = F.from_json("props", "struct<k: string>")
    events = table(spark, folder, "events").select("event_id", props["k"].alias("k"))
    spoiled = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("x"), "k")).otherwise(F.concat(F.lit(" "), "k"))
    return events.select("event_id", number(spoiled).alias("k"))


def landed_files(spark, folder):
    """Responses written as packed files, one document per line, and read back with the fixed schema."""
    path = fresh_path(spark)
    landing = _responses(table(spark, folder, "lineitem"), "Results").drop("l_orderkey").write
    # a packed file is read by one task, so its lines are bounded
    landing.option("maxRecordsPerFile", LANDED_LINES).json(path, compression="gzip")
    rows = landed.race_results(landed.read_responses(spark, path, one_per_line=True))
    return rows.groupBy("DriverKey").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("grid").alias("grid"), F.sum("position").alias("position")
    )


def season_counts(spark, folder):
    orders = table(spark, folder, "orders")
    races = orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("round"))
    return landed.season_counts(races)


def _orders_by_season(spark, folder):
    return table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice", "o_orderstatus"
    )


def season_replace(spark, folder):
    """1996-1998 replaced by orders with a new column; 1998 gets no new rows and goes."""
    old = _orders_by_season(spark, folder)
    new = old.where(F.col("year").between(1996, 1997)).select(
        "year", "o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit("new").alias("origin")
    )
    old = old.where(F.col("o_orderkey") % 3 != 0).withColumn("origin", F.lit("old"))
    return replace_seasons(old, new, 1996, 1998)


def season_sink(spark, folder):
    """The same through a stored table, run twice: the second run changes nothing."""
    path = fresh_path(spark)
    old = _orders_by_season(spark, folder)
    write_seasons(old.where(F.col("o_orderkey") % 3 != 0), path, 1990, 2005, ["o_orderkey"])
    new = old.where(F.col("year").between(1996, 1997))
    for _ in range(2):
        write_seasons(new, path, 1996, 1998, ["o_orderkey"])
    return read_table(spark, path, old.schema).select("year", "o_orderkey", "o_totalprice", "o_orderstatus")


def season_sink_csv(spark, folder):
    """The season sink on CSV files, and a sink without new rows."""
    path = fresh_path(spark)
    old = _orders_by_season(spark, folder)
    write_seasons(old, path, 1990, 2005, ["o_orderkey"], fmt="csv")
    first, last = sprint_range(1996, 2030)
    write_seasons(old.where(F.col("year") >= first), path, first, last, fmt="csv")
    schema = "o_orderkey bigint, o_totalprice double, o_orderstatus string, year int"
    return read_table(spark, path, schema, fmt="csv").select("year", "o_orderkey", "o_totalprice", "o_orderstatus")


def latest_sink(spark, folder):
    """Only the latest race is kept; an empty fetch changes nothing."""
    path = fresh_path(spark)
    orders = _orders_by_season(spark, folder)
    write_whole(orders.where(F.col("year") == 1996), path, ["o_totalprice"])
    write_latest(orders.where(F.col("year") == 1999), path)
    write_latest(orders.where(F.col("year") == 1899), path)
    return read_table(spark, path, orders.schema)


def missing_sources(spark, folder):
    """Orders with the columns of sources that are not there."""
    absent = read_table(spark, fresh_path(spark), schemas.SPRINT)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return with_defaults(orders, {"o_totalprice": 1.0, "importance": 0.5, "sprint_pos": None}).withColumn(
        "stored", F.lit(absent is not None)
    )


def lap_scan(spark, folder):
    """Events as landed laps of calendar days, with their drivers, to timing features."""
    return lap_scan_of(spark, folder)


def lap_scan_of(spark, folder, repeats=1):
    """The same with every driver named so often."""
    at = F.col("ts") - F.date_trunc("day", "ts")
    events = table(spark, folder, "events")
    day, number_ = F.dayofmonth("ts").alias("round"), F.col("user_id").cast("string").alias("driver_number")
    laps = events.select(
        F.year("ts").alias("year"), day, number_, "ts", "event_id",
        F.col("value").alias("lap"), (F.col("event_type") == "error").alias("pit"),
        F.lit(1.0).alias("Stint"), F.col("event_type").alias("Compound"), at.alias("at"),
    )
    drivers = events.where(F.col("user_id") % 9 != 0).select(F.year("ts").alias("year"), day, number_).distinct()
    names = {"FirstName": "Ünal", "LastName": "Müller", "FullName": "Ünal Müller"}
    drivers = drivers.withColumns({c: F.lit(v) for c, v in names.items()})
    drivers = drivers.withColumn("TeamName", F.lit(None).cast("string"))
    drivers = drivers.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(repeats)))).drop("copy")
    races = events.where(F.dayofmonth("ts") % 2 == 0).select(F.year("ts").alias("year"), day).distinct()
    rows = timing_features(landed.race_laps(laps, drivers, races, 2020, 2030), order=("ts", "event_id"))
    return rows.select(
        "year", "round", "DriverNumber", "DriverKey", "DriverName", "Team", "best_lap", "pitstops_count",
        "stint1_length", "stint1_compound", "compound_changes",
    )


def _words(spark, folder):
    """Distinct words of all texts with their counts."""
    documents = table(spark, folder, "documents")
    words = documents.select(F.explode(F.split("text", r"[ \n]")).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("uses"))


def entity_keys(spark, folder):
    """Word uses per entity key, with the word as given and as family name."""
    words = _words(spark, folder).select(entity_key("word", "word").alias("key"), "uses")
    return words.groupBy("key").agg(F.sum("uses").alias("uses"))


def display_names(spark, folder):
    """Full names and title-cased keys of parts."""
    parts = table(spark, folder, "part")
    given = F.when(F.col("p_partkey") % 4 != 0, F.col("p_name"))
    key = F.concat_ws("_", F.substring_index("p_name", " ", 1), F.lit("de"), F.lower("p_type"))
    return parts.select(
        "p_partkey",
        full_name(given, "p_brand").alias("full_name"),
        title_key(letters_key(key)).alias("title"),
        F.lower("p_brand").alias("lower"),
    )


def letters_key(key):
    """Keep the underscores of a key, clean what lies between."""
    return F.array_join(F.transform(F.split(key, "_"), letters_only), "_")


def list_means(spark, folder):
    """Bracketed lists of numbers in strings, some with blanks or bad items."""
    parts = table(spark, folder, "part")
    text = F.concat(
        F.lit("["), F.col("p_size").cast("string"), F.lit(", "), F.col("p_retailprice").cast("string"),
        F.when(F.col("p_partkey") % 5 == 0, ", ").when(F.col("p_partkey") % 7 == 0, ", x").otherwise(", 4.0"), F.lit("]"),
    )
    text = F.when(F.col("p_partkey") % 11 == 0, "[]").otherwise(text)
    return parts.select("p_partkey", F.round(list_mean(text), 6).alias("mean"))


QUERIES = {
    "json_results": json_results,
    "json_qualifying": json_qualifying,
    "json_sprints": json_sprints,
    "json_calendar": json_calendar,
    "json_props": json_props,
    "landed_files": landed_files,
    "season_counts": season_counts,
    "season_replace": season_replace,
    "season_sink": season_sink,
    "season_sink_csv": season_sink_csv,
    "latest_sink": latest_sink,
    "missing_sources": missing_sources,
    "lap_scan": lap_scan,
    "entity_keys": entity_keys,
    "display_names": display_names,
    "list_means": list_means,
}

LINES = """
lines as (
  select l_orderkey, cast(year(l_shipdate) as integer) as "year", cast(month(l_shipdate) as integer) as "round",
    l_shipdate, l_linestatus as status, case l_returnflag when 'A' then 'Änne' when 'N' then 'nïco' else '' end as given,
    'Ø' || l_linestatus || 'rémy-' || cast(l_suppkey as varchar) as family,
    case l_returnflag when 'A' then 'a_' when 'N' then 'n_' end || lower(l_linestatus) || 'remy' as "DriverKey",
    case when l_tax > 0.01 then 'Team ' || cast(l_partkey as varchar) else '' end as team,
    case when l_returnflag <> 'R' then cast(l_linenumber as double) end as pos,
    cast(trunc(l_quantity) as double) as grid, l_suppkey
  from lineitem)"""

ORDER_LINES = """
order_lines as (
  select o_orderkey as l_orderkey, o_custkey as l_suppkey, o_custkey as l_partkey, 1 + o_orderkey % 7 as l_linenumber,
    o_orderkey % 50 as l_quantity, (o_orderkey % 10) / 100 as l_tax,
    case o_orderpriority when '1-URGENT' then 'A' when '2-HIGH' then 'N' else 'R' end as l_returnflag,
    o_orderstatus as l_linestatus, o_orderdate as l_shipdate from orders),""" + LINES.replace("lineitem", "order_lines")

BY_SEASON = """
old as (
  select cast(year(o_orderdate) as integer) as "year", o_orderkey, o_totalprice, o_orderstatus from orders)"""

WORD_KEY = """regexp_replace(lower(strip_accents(word)), '[^a-z]', '', 'g')"""

SQL = {
    "json_results": f"""
with {LINES}
select "DriverKey", "year", "round", status, count(*) as rows, sum(grid) as grid, sum(pos) as "position",
  max(trim(given || ' ' || family)) as name, min(team) as team,
  min(cast(l_suppkey as varchar)) as points
from lines group by 1, 2, 3, 4""",
    "json_qualifying": f"""
with {ORDER_LINES}
select l_orderkey, "year", "round", count(pos) as placed, sum(pos) as grid from lines group by 1, 2, 3""",
    "json_sprints": f"""
with {ORDER_LINES}
select cast("year" + 23 as integer) as "year", status, count(*) as rows, sum(grid) as sprint_grid,
  sum(pos) as sprint_pos, sum(cast(l_suppkey as double)) as sprint_points
from lines where "year" + 23 >= 2021 group by 1, 2""",
    "json_calendar": f"""
with {ORDER_LINES},
races as (
  select "year", "round", status, l_shipdate from lines
  union select "year", "round" * 10, status, l_shipdate from lines)
select distinct "year", cast("round" as integer) as "round", 'Race ' || cast("round" as varchar) as "raceName",
  lower(status) as "circuitId", strftime(l_shipdate, '%Y-%m-%d') as "date" from races""",
    "json_props": """
select event_id, case when event_id % 5 <> 0 then cast(json_extract(props, '$.k') as double) end as k from events""",
    "landed_files": f"""
with {LINES}
select "DriverKey", count(*) as rows, sum(grid) as grid, sum(pos) as "position" from lines group by 1""",
    "season_counts": """
select cast(year(o_orderdate) as integer) as "year", count(distinct month(o_orderdate)) as races
from orders group by 1""",
    "season_replace": f"""
with {BY_SEASON}
select "year", o_orderkey, o_totalprice, o_orderstatus, 'old' as origin from old
where o_orderkey % 3 <> 0 and "year" not between 1996 and 1998
union all
select "year", o_orderkey, o_totalprice * 2, null, 'new' from old where "year" between 1996 and 1997""",
    "season_sink": f"""
with {BY_SEASON}
select * from old where (o_orderkey % 3 <> 0 and "year" not between 1996 and 1998) or "year" between 1996 and 1997""",
    "season_sink_csv": f"with {BY_SEASON} select * from old",
    "latest_sink": f"""with {BY_SEASON} select * from old where "year" = 1999""",
    "missing_sources": """
select o_orderkey, o_totalprice, cast(0.5 as double) as importance, cast(null as double) as sprint_pos,
  false as stored from orders""",
    "lap_scan": """
with laps as (
  select cast(year(ts) as integer) as "year", cast(day(ts) as integer) as "round",
    cast(user_id as varchar) as "DriverNumber", ts, event_id, value, event_type,
    lag(event_type) over (partition by user_id, day(ts) order by ts, event_id) as last_
  from events where user_id % 9 <> 0 and day(ts) % 2 = 0)
select "year", "round", "DriverNumber", 'u_muller' as "DriverKey", 'Ünal Müller' as "DriverName", '' as "Team",
  min(value) as best_lap, count(*) filter (event_type = 'error') as pitstops_count,
  cast(count(*) as double) as stint1_length, arg_min(event_type, ts) as stint1_compound,
  count(*) filter (event_type is distinct from last_) - 1 as compound_changes
from laps group by 1, 2, 3""",
    "entity_keys": f"""
with words as (select unnest(string_split_regex(text, '[ \\n]')) as word from documents),
keys as (select {WORD_KEY} as letters from words where word <> '')
select case when letters <> '' then substr(letters, 1, 1) || '_' || letters end as key, count(*) as uses
from keys group by 1""",
    "display_names": """
with parts as (
  select *, split_part(p_name, ' ', 1) as a, lower(regexp_replace(p_type, '[^a-zA-Z]', '', 'g')) as b from part)
select p_partkey, trim(case when p_partkey % 4 <> 0 then p_name else '' end || ' ' || p_brand) as full_name,
  upper(a[1]) || a[2:] || '_De_' || upper(b[1]) || b[2:] as title, lower(p_brand) as lower from parts""",
    "list_means": """
select p_partkey, round(case when p_partkey % 11 = 0 then null
  when p_partkey % 5 = 0 then (p_size + p_retailprice) / 2
  when p_partkey % 7 = 0 then null
  else (p_size + p_retailprice + 4) / 3 end, 6) as mean from part""",
}
