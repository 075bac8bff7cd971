"""The physical plans that the operators are meant to get."""

import re

from pyspark.sql import functions as F

from paceline.plans.features import ENTITY, driver_history, form
from paceline.queries import all_queries
from paceline.sources.tables import read_race


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_for_all_histories(spark, data):
    rows = spark.read.parquet(f"{data}/orders.parquet").select(
        F.col("o_custkey").alias(ENTITY), F.year("o_orderdate").alias("year"), F.dayofyear("o_orderdate").alias("round"),
        (F.col("o_orderkey") % 20).cast("double").alias("grid"), F.col("o_totalprice").alias("position"),
        F.col("o_orderpriority").alias("circuitId"),
    )
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", plan(driver_history(form(rows))))
    assert exchanges == ["year", ENTITY]  # the season ranks, and everything by entity


def test_few_jobs(spark, data):
    """Statistics, hot groups and lookups are found in few passes."""
    context, queries = spark.sparkContext, all_queries()
    for name, most in (("race_features", 36), ("asof_last", 12), ("metrics_mode", 20)):
        context.setJobGroup(name, name)
        queries[name](spark, data).write.format("noop").mode("overwrite").save()
        assert len(context.statusTracker().getJobIdsForGroup(name)) <= most, name
    context.setLocalProperty("spark.jobGroup.id", None)


def test_laps_are_shuffled_once(spark, data):
    text = plan(all_queries()["timing_rows"](spark, data))
    scans = text.split("+- FileScan parquet")
    assert len(scans) == 3  # all laps for median and compounds, and for the stint aggregates
    shuffled = re.findall(r"Exchange hashpartitioning\((.*?), 4\)", text)
    names = [re.findall(r"(\w+)#", s) for s in shuffled]
    assert names == [["user_id"], ["user_id"], ["user_id", "_groupingexpression"]]  # the second one moves stints


def test_no_python_and_no_products(spark, data):
    for name, query in all_queries().items():
        if not name.startswith("rf_"):
            text = plan(query(spark, data))
            assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", text), name


def test_pruning_and_pushdown(spark, data):
    results = spark.read.parquet(f"{data}/events.parquet").withColumnsRenamed({"event_id": "year", "user_id": "round"})
    text = plan(read_race(results, 5, 7, ["year", "round", "value"]))
    assert "EqualTo(event_id,5)" in text and "EqualTo(user_id,7)" in text and "props" not in text


def test_rolling_form_reads_four_columns(spark, data):
    text = plan(all_queries()["form_roll3"](spark, data))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    assert text.count("Exchange") == 1
