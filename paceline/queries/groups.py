"""Correlation, medians, encoders, last-wins lookups and distinct rows."""

from pyspark.sql import functions as F

from paceline.functions.scalars import finished
from paceline.operators.grouped import (
    correlation_by,
    distinct_rows,
    fill_global_median,
    fill_group_median,
    group_median,
    last_wins,
)
from paceline.operators.ranking import encode_labels, label_index
from paceline.operators.skew import lookup_side
from paceline.plans.features import IMPORTANCE_FILL
from paceline.queries.views import table


def group_corr_guarded(spark, folder):
    """Per supplier over all lines; the x of returned lines and the y of large orders are gaps."""
    lines = table(spark, folder, "lineitem").select(
        "l_suppkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("x"),
        F.when(F.col("l_discount") < 0.09, F.col("l_extendedprice")).alias("y"),
    )
    rows = correlation_by(lines, "l_suppkey", "x", "y", "importance")
    return rows.select("l_suppkey", F.round("importance", 9).alias("importance"))


def corr_no_variance(spark, folder):
    """Groups in which one side never varies take the constant."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_quantity").alias("x"),
        F.when(F.col("l_orderkey") % 2 == 0, F.col("l_tax")).otherwise(F.lit(0.5)).alias("y"),
    )
    rows = correlation_by(lines, "l_orderkey", "x", "y", "importance")
    return rows.groupBy((F.col("l_orderkey") % 2).alias("kind")).agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("importance"), 4).alias("importance")
    )


def circuit_importance(spark, folder):
    """Correlation over finished orders per priority, looked up for every order."""
    orders = table(spark, folder, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "Finished").when(F.col("o_orderstatus") == "O", "+1 Lap")
    rows = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("circuit"),
        status.alias("status"),
        (F.col("o_orderkey") % 20).cast("double").alias("grid"),
        F.col("o_totalprice").alias("position"),
    )
    corr = correlation_by(rows.where(finished("status")), "circuit", "grid", "position", "importance")
    rows = rows.join(lookup_side(corr), "circuit", "left").fillna(IMPORTANCE_FILL, ["importance"])
    return rows.select("o_orderkey", F.round("importance", 9).alias("importance"))


def customer_median(spark, folder):
    orders = table(spark, folder, "orders")
    return group_median(orders, ["o_custkey"], "o_totalprice", "median")


def overall_median(spark, folder):
    """The exact medians of whole columns."""
    lines = table(spark, folder, "lineitem")
    price = group_median(lines, [], "l_extendedprice", "median").withColumn("measure", F.lit("price"))
    quantity = group_median(lines, [], "l_quantity", "median").withColumn("measure", F.lit("quantity"))
    return price.unionByName(quantity)


def _gappy_orders(spark, folder):
    price = F.when((F.col("o_orderkey") % 4 != 0) & (F.col("o_custkey") % 50 != 0), F.col("o_totalprice"))
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", price.alias("price"))


def median_fill(spark, folder):
    """Gaps take the customer's own median; customers without any price keep the gap."""
    rows = fill_group_median(_gappy_orders(spark, folder), ["o_custkey"], ["price"])
    return rows.select("o_orderkey", "price")


def median_fill_all(spark, folder):
    """Gaps take the median of all orders; a column without values takes zero."""
    rows = _gappy_orders(spark, folder).withColumn("none", F.lit(None).cast("double"))
    return fill_global_median(rows, ["price", "none"]).select("o_orderkey", "price", "none")


def label_encode(spark, folder):
    """Segments numbered alphabetically, with a gap as a label of its own."""
    return label_index(_gappy_segments(spark, folder), "segment", "segment_id")


def _gappy_segments(spark, folder):
    segment = F.when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment"))
    return table(spark, folder, "customer").select("c_custkey", segment.alias("segment"))


def encode_parts(spark, folder):
    """Labels fitted on one brand family; unknown brands drop the part, unknown types count as 0."""
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    brands = label_index(parts.where(F.col("p_partkey") % 7 != 0).where(F.col("p_brand") != "Brand#7"), "p_brand", "brand_id")
    types = label_index(parts.where(~F.col("p_type").contains("PROMO")), "p_type", "type_id")
    rows = encode_labels(parts, brands, "p_brand", "brand_id")
    return encode_labels(rows, types, "p_type", "type_id", unknown=0).select("p_partkey", "brand_id", "type_id")


def name_codes(spark, folder):
    """Every distinct customer name numbered, looked up for every customer."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    names = label_index(customers, "c_name", "name_id")
    return encode_labels(customers, names, "c_name", "name_id").select("c_custkey", "name_id")


def last_order(spark, folder):
    """Per customer the status and price of the last order."""
    orders = table(spark, folder, "orders")
    return last_wins(orders, ["o_custkey"], ["o_orderstatus", "o_totalprice"], ["o_orderdate", "o_orderkey"])


def distinct_entries(spark, folder):
    """Distinct listed columns that exist."""
    orders = table(spark, folder, "orders")
    return distinct_rows(orders, ["o_custkey", "o_orderpriority", "no_such_column"])


QUERIES = {
    "group_corr_guarded": group_corr_guarded,
    "corr_no_variance": corr_no_variance,
    "circuit_importance": circuit_importance,
    "customer_median": customer_median,
    "overall_median": overall_median,
    "median_fill": median_fill,
    "median_fill_all": median_fill_all,
    "label_encode": label_encode,
    "encode_parts": encode_parts,
    "name_codes": name_codes,
    "last_order": last_order,
    "distinct_entries": distinct_entries,
}

CORR = """coalesce(case when count(*) filter (x is not null and y is not null) > 1
    and var_pop(x) filter (y is not null) > 0 and var_pop(y) filter (x is not null) > 0
  then covar_pop(y, x) filter (x is not null and y is not null) /
    (stddev_pop(x) filter (y is not null) * stddev_pop(y) filter (x is not null)) end, 0.5)"""

GAPPY = """
gappy as (
  select o_orderkey, o_custkey,
    case when o_orderkey % 4 <> 0 and o_custkey % 50 <> 0 then o_totalprice end as price from orders)"""

SQL = {
    "group_corr_guarded": f"""
with pairs as (
  select l_suppkey, case when l_returnflag <> 'R' then l_quantity end as x,
    case when l_discount < 0.09 then l_extendedprice end as y from lineitem)
select l_suppkey, round({CORR}, 9) as importance from pairs group by l_suppkey""",
    "corr_no_variance": f"""
with pairs as (
  select l_orderkey, l_quantity as x, case when l_orderkey % 2 = 0 then l_tax else 0.5 end as y from lineitem),
each as (select l_orderkey, {CORR} as importance from pairs group by l_orderkey)
select l_orderkey % 2 as kind, count(*) as orders, round(sum(importance), 4) as importance from each group by 1""",
    "circuit_importance": f"""
with pairs as (
  select o_orderkey, case when o_orderpriority <> '5-LOW' then o_orderpriority end as circuit,
    o_orderstatus in ('F', 'O') as done, cast(o_orderkey % 20 as double) as x, o_totalprice as y from orders),
corr as (select circuit, {CORR} as importance from pairs where done group by circuit)
select o_orderkey, round(coalesce(importance, 0.5), 9) as importance
from pairs left join corr using (circuit)""",
    "customer_median": "select o_custkey, median(o_totalprice) as median from orders group by o_custkey",
    "overall_median": """
select 'price' as measure, median(l_extendedprice) as median from lineitem
union all select 'quantity', median(l_quantity) from lineitem""",
    "median_fill": f"""
with {GAPPY}
select o_orderkey, coalesce(price, median(price) over (partition by o_custkey)) as price from gappy""",
    "median_fill_all": f"""
with {GAPPY}
select o_orderkey, coalesce(price, (select median(price) from gappy)) as price, cast(0 as double) as none from gappy""",
    "label_encode": """
with labels as (
  select distinct coalesce(case when c_custkey % 10 <> 0 then c_mktsegment end, 'None') as segment from customer)
select segment, cast(row_number() over (order by segment) - 1 as integer) as segment_id from labels""",
    "encode_parts": """
with brands as (
  select p_brand, cast(row_number() over (order by p_brand) - 1 as integer) as brand_id
  from (select distinct p_brand from part where p_partkey % 7 <> 0 and p_brand <> 'Brand#7')),
types as (
  select p_type, cast(row_number() over (order by p_type) - 1 as integer) as type_id
  from (select distinct p_type from part where p_type not like '%PROMO%'))
select p_partkey, brand_id, coalesce(type_id, 0) as type_id
from part join brands using (p_brand) left join types using (p_type)""",
    "name_codes": """
select c_custkey, cast(dense_rank() over (order by c_name) - 1 as integer) as name_id from customer""",
    "last_order": """
select o_custkey, o_orderstatus, o_totalprice from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
    "distinct_entries": "select distinct o_custkey, o_orderpriority from orders",
}
