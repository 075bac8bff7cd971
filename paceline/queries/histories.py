"""Recent form, career means, as-of lookups and positions."""

from pyspark.sql import functions as F

from paceline.operators.history import Career, Carried, Recent, with_history
from paceline.operators.joins import as_of_cutoff, as_of_previous
from paceline.operators.ranking import dense_scaled_rank, finishing_order
from paceline.queries.views import EVENT_LAPS, event_laps, seasoned_orders, table

ORDER = ["o_orderdate", "o_orderkey"]


def form_roll3(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", *ORDER, "o_totalprice")
    rows = with_history(orders, ["o_custkey"], ORDER, [Recent("form", "o_totalprice", 3, 13.0)])
    return rows.select("o_orderkey", F.round("form", 6).alias("form"))


def form_nulls(spark, folder):
    """Two measures, with gaps in the measures and rows without an entity."""
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    rows = events.select(
        "event_id",
        "ts",
        F.when(kind != "signup", F.col("user_id")).alias("entity"),
        F.when(kind != "error", F.col("value")).alias("grid"),
        F.when(kind != "view", F.col("value") * 2).alias("position"),
    )
    features = [Recent("form_grid", "grid", 3, 13.0), Recent("form_race", "position", 3, 13.0)]
    rows = with_history(rows, ["entity"], ["ts", "event_id"], features)
    return rows.select("event_id", *[F.round(c, 6).alias(c) for c in ("form_grid", "form_race")])


def career_expanding(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", *ORDER, "o_totalprice")
    rows = with_history(orders, ["o_custkey"], ORDER, [Career("career", "o_totalprice", 14.0)])
    return rows.select("o_orderkey", F.round("career", 6).alias("career"))


def keyed_expanding(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderpriority", *ORDER, "o_totalprice")
    keys = ["o_custkey", "o_orderpriority"]
    rows = with_history(orders, keys, ORDER, [Career("skill", "o_totalprice", 14.0)])
    return rows.select("o_orderkey", F.round("skill", 6).alias("skill"))


def line_history(spark, folder):
    """Career and form per supplier over every line, ordered by ship date and whole row."""
    keys = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    lines = table(spark, folder, "lineitem").select("l_suppkey", *keys)
    features = [Recent("form", "l_quantity", 3, 13.0), Career("career", "l_quantity", 14.0)]
    rows = with_history(lines, ["l_suppkey"], keys, features)
    return rows.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.round(F.sum("form"), 4).alias("form"),
        F.round(F.sum("career"), 4).alias("career"),
    )


def carried_type(spark, folder):
    rows = event_laps(spark, folder)
    order = ["ts", "event_id"]
    rows = with_history(rows, ["user_id"], order, [Carried("carried", "Compound", tuple(order))])
    return rows.select("event_id", "carried")


def dense_scaled(spark, folder):
    orders = seasoned_orders(spark, folder).select("o_custkey", *ORDER, "o_totalprice", "season")
    rows = with_history(orders, ["o_custkey"], ORDER, [Career("career", "o_totalprice")])
    rows = rows.withColumn("career", F.round("career", 6))
    rows = dense_scaled_rank(rows, ["season"], "career", "pace_rank", rank_name="dense")
    return rows.select("o_orderkey", F.col("dense").cast("bigint"), F.round("pace_rank", 9).alias("pace_rank"))


def asof_last(spark, folder):
    """Every customer with the last order before 1999, and defaults without one."""
    orders = seasoned_orders(spark, folder).withColumn("seq", F.month("o_orderdate"))
    customers = table(spark, folder, "customer").select("c_custkey")
    targets = customers.withColumnRenamed("c_custkey", "o_custkey")
    stats = {"o_totalprice": 0.0, "o_orderpriority": "none"}
    return as_of_cutoff(orders, targets, "o_custkey", "season", "seq", (1999, 1), stats, tie=ORDER)


def asof_batch(spark, folder):
    """Every order with the customer's order before it."""
    orders = table(spark, folder, "orders").select("o_custkey", *ORDER, "o_totalprice", "o_orderstatus")
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    orders = orders.withColumn("o_totalprice", price)
    stats = {"o_totalprice": 14.0, "o_orderstatus": "none"}
    rows = as_of_previous(orders, "o_custkey", ORDER, stats)
    return rows.select("o_orderkey", "o_totalprice", "o_orderstatus")


def rank_delta(spark, folder):
    """Places by key order and by price in each season; the first 20 of each are shown."""
    orders = seasoned_orders(spark, folder).select("o_orderkey", "o_totalprice", "season")
    orders = orders.withColumn("grid_score", F.col("o_orderkey") % 997)
    rows = finishing_order(orders, ["season"], "grid_score", "o_totalprice", "o_orderkey")
    places = [F.col(c).cast("bigint").alias(c) for c in ("Grid", "Pos", "Delta")]
    return rows.where(F.col("Pos") <= 20).select("season", "o_orderkey", *places)


def rank_top20(spark, folder):
    """The 20 cheapest orders of all with their places."""
    return rank_delta(spark, folder).orderBy("Pos", "season").limit(20)


QUERIES = {
    "form_roll3": form_roll3,
    "form_nulls": form_nulls,
    "career_expanding": career_expanding,
    "keyed_expanding": keyed_expanding,
    "line_history": line_history,
    "carried_type": carried_type,
    "dense_scaled": dense_scaled,
    "asof_last": asof_last,
    "asof_batch": asof_batch,
    "rank_delta": rank_delta,
    "rank_top20": rank_top20,
}

RANK_DELTA = """
with places as (
  select cast(year(o_orderdate) as integer) as season, o_orderkey,
    row_number() over (partition by year(o_orderdate) order by o_orderkey % 997, o_orderkey) as "Grid",
    row_number() over (partition by year(o_orderdate) order by o_totalprice, o_orderkey) as "Pos"
  from orders)
select *, "Grid" - "Pos" as "Delta" from places where "Pos" <= 20"""

SQL = {
    "form_roll3": """
select o_orderkey, round(coalesce(avg(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey
  rows between 3 preceding and 1 preceding), 13.0), 6) as form from orders""",
    "form_nulls": """
with rows_ as (
  select event_id, ts, case when event_type <> 'signup' then user_id end as entity,
    case when event_type <> 'error' then value end as grid,
    case when event_type <> 'view' then value * 2 end as position
  from events)
select event_id,
  round(coalesce(case when entity is not null then avg(grid) over w end, 13.0), 6) as form_grid,
  round(coalesce(case when entity is not null then avg(position) over w end, 13.0), 6) as form_race
from rows_ window w as (partition by entity order by ts, event_id rows between 3 preceding and 1 preceding)""",
    "career_expanding": """
select o_orderkey, round(coalesce(avg(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey
  rows between unbounded preceding and 1 preceding), 14.0), 6) as career from orders""",
    "keyed_expanding": """
select o_orderkey, round(coalesce(avg(o_totalprice) over (partition by o_custkey, o_orderpriority
  order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding), 14.0), 6) as skill
from orders""",
    "line_history": """
with features as (
  select l_suppkey,
    coalesce(avg(l_quantity) over (w rows between 3 preceding and 1 preceding), 13.0) as form,
    coalesce(avg(l_quantity) over (w rows between unbounded preceding and 1 preceding), 14.0) as career
  from lineitem window w as (partition by l_suppkey
    order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice))
select l_suppkey, count(*) as lines, round(sum(form), 4) as form, round(sum(career), 4) as career
from features group by l_suppkey""",
    "carried_type": f"""
with {EVENT_LAPS}
select event_id, last_value(compound ignore nulls) over (partition by user_id order by ts, event_id
  rows between unbounded preceding and current row) as carried from laps""",
    "dense_scaled": """
with careers as (
  select o_orderkey, year(o_orderdate) as season, round(avg(o_totalprice) over (partition by o_custkey
    order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding), 6) as career
  from orders),
ranks as (
  select *, case when career is not null
    then dense_rank() over (partition by season order by career nulls last) end as dense
  from careers)
select o_orderkey, dense,
  round(coalesce(cast(dense as double) / max(dense) over (partition by season), 0.5), 9) as pace_rank
from ranks""",
    "asof_last": """
with last_ as (
  select o_custkey, o_totalprice, o_orderpriority from orders where year(o_orderdate) < 1999
  qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
select c_custkey as o_custkey, coalesce(o_totalprice, 0.0) as o_totalprice,
  coalesce(o_orderpriority, 'none') as o_orderpriority
from customer left join last_ on c_custkey = o_custkey""",
    "asof_batch": """
with rows_ as (
  select *, case when o_orderstatus <> 'P' then o_totalprice end as price from orders)
select o_orderkey, coalesce(lag(price) over w, 14.0) as o_totalprice,
  coalesce(lag(o_orderstatus) over w, 'none') as o_orderstatus
from rows_ window w as (partition by o_custkey order by o_orderdate, o_orderkey)""",
    "rank_delta": RANK_DELTA,
    "rank_top20": RANK_DELTA + """ order by "Pos", season limit 20""",
}
