"""What must not grow faster than the tables: passes, joined rows, rows of a task, bytes of landed files."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paceline.functions.scalars import number, text_number
from paceline.operators import ranking
from paceline.operators.grouped import global_medians
from paceline.operators.joins import with_circuit
from paceline.plans import models
from paceline.plans.features import timing
from paceline.plans.forecast import Encoders
from paceline.plans.load import load_facts
from paceline.queries import edges, ingest, trees
from paceline.sources.landed import race_results
from paceline.sources.tables import write_whole
from tests.helpers import rows


def _counted(spark, df):
    """(the rows, a counter of those that were read)."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    return df.mapInArrow(counted, df.schema), reads


def test_repeated_calendar_rows_are_counted(spark, tmp_path):
    home = str(tmp_path)
    results = spark.range(60).select(
        F.concat(F.lit("d"), F.col("id").cast("string")).alias("DriverKey"), F.when(F.col("id") % 9 != 0, F.col("id") % 20).cast("double").alias("grid"),
        F.lit(1999).alias("year"), F.when(F.col("id") != 7, (1 + F.col("id") % 3).cast("int")).alias("round"),
        F.when(F.col("id") == 5, "own").alias("circuitId"),
    )
    calendar = spark.range(50).select(
        F.lit(1999).alias("year"), (1 + F.col("id") % 2).cast("int").alias("round"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("c"), (F.col("id") % 4).cast("string"))).alias("circuitId"),
    )
    write_whole(results, f"{home}/results")
    write_whole(calendar, f"{home}/calendar")
    each, counted = load_facts(spark, home), load_facts(spark, home, times="_times")
    columns = ["DriverKey", "year", "round", "grid", "circuitId"]
    assert rows(counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))), *columns) == rows(each, *columns)
    assert counted.count() <= 60 * 5 < each.count()


def test_stored_facts_do_not_grow_with_the_square(spark, tmp_path, monkeypatch):
    home = str(tmp_path)
    write_whole(spark.range(300).selectExpr("1999 as year", "1 as round", "double(id) as grid", "concat('d', id) as DriverKey"), f"{home}/results")
    write_whole(spark.range(400).selectExpr("1999 as year", "1 as round", "'c' as circuitId"), f"{home}/calendar")
    made = []
    monkeypatch.setattr(edges, "_stored", lambda *_: home)
    monkeypatch.setattr(edges, "load_facts", lambda *a, **b: made.append(load_facts(*a, **b)) or made[0])
    assert rows(edges.facts_stored(spark, home)) == [(1999, 1, 120_000, 400.0 * 299 * 150, 0)]
    assert made[0].count() == 300


def test_medians_of_many_rows_in_one_pass(spark, small_groups):
    df = spark.range(101).selectExpr("double(id * 7 % 101) as a", "if(id % 3 = 0, null, double(id)) as b", "double(null) as c", "id % 5 as d")
    read, reads = _counted(spark, df)
    assert global_medians(read, ["a", "b", "c"], rows=101) == {"a": 50.0, "b": 50.0, "c": None}
    assert reads.value == 101
    assert global_medians(df, ["a", "d"], rows=101) == {"a": 50.0, "d": 2.0}


def test_timing_of_many_starts_is_joined_once(spark, small_groups):
    starts = spark.range(60).selectExpr("1999 as year", "int(id % 6) as round", "concat('d', id) as DriverKey")
    extra = starts.where("round % 2 = 0").selectExpr("*", "double(substr(DriverKey, 2)) as best_lap", "1.0D as mean_pit_loss")
    extra, reads = _counted(spark, extra)
    found = timing(starts, extra)
    assert found.where("mean_pit_loss = 1.0 and avg_race_pace = 0.0").count() == 60
    assert found.where("round = 1").select("best_lap").distinct().collect() == [(29.0,)]
    assert reads.value == 30


def test_ranks_of_many_rows_by_pairs(spark, small_groups, monkeypatch):
    df = spark.range(48).selectExpr("id", "if(id = 9, null, id % 4) as season", "if(id % 7 = 0, null, double(id % 5)) as pace", "repeat('x', 50) as wide")
    spark.conf.set("spark.paceline.maxGroupRows", "100")
    expected = rows(ranking.dense_scaled_rank(df, ["season"], "pace", "scaled", rank_name="dense"))
    spark.conf.set("spark.paceline.maxGroupRows", "20")  # 48 rows, but no season has more than 12

    def refuse(*_):
        raise AssertionError("whole rows of a season in one task")

    monkeypatch.setattr(ranking, "_ranked_rows", refuse)
    assert rows(ranking.dense_scaled_rank(df, ["season"], "pace", "scaled", rank_name="dense")) == expected


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_calendar_and_few_pairs_are_not_shuffled(spark, small_groups):
    # the threshold stands for starts and calendars whose size Spark cannot tell from their plans
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        starts = spark.range(60).selectExpr("int(1999 + id % 2) as year", "if(id = 9, null, int(id % 3)) as round", "id", "double(id % 5) as pace")
        calendar = spark.range(4).selectExpr("int(1999 + id % 2) as year", "int(id / 2) as round", "concat('c', id) as circuitId")
        calendar = calendar.union(calendar.where("circuitId = 'c2'"))
        joined = with_circuit(starts, calendar)
        assert "SortMergeJoin" not in _plan(joined) and joined.columns == [*starts.columns, "circuitId"]
        assert joined.count() == 70 and joined.where("circuitId = 'c2'").count() == 20 and joined.where("circuitId is null").count() == 21
        ranked = ranking.dense_scaled_rank(starts, ["year"], "pace", "scaled")
        assert "SortMergeJoin" not in _plan(ranked)
        assert sorted({(r["pace"], r["scaled"]) for r in ranked.collect()}) == [(float(k), (k + 1) / 5) for k in range(5)]
        spark.conf.set("spark.paceline.maxLookupRows", "1")
        assert rows(ranking.dense_scaled_rank(starts, ["year"], "pace", "scaled")) == rows(ranked)
        assert rows(with_circuit(starts, calendar)) == rows(joined)
    finally:
        spark.conf.unset("spark.paceline.maxLookupRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_that_are_no_numbers_are_not_tried(spark):
    texts = ["1", " 3 ", "R", "", " ", None, "NaN", "nan", "inf", "-Infinity", "+INF", "1e3", "0x1p3", "1d", ".5", "5.", "\u0663", "e", "DNF", "1_0", "-", "+2"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    assert rows(df.select("id", text_number("text").alias("v"))) == rows(df.select("id", number("text").alias("v")))
    responses = spark.sql("select named_struct('RaceTable', named_struct('Races', array(named_struct('season', '1999', 'round', '1', 'Results', array(named_struct("
                          "'Driver', named_struct('givenName', 'a', 'familyName', 'b'), 'Constructor', named_struct('name', 'c'), 'position', 'R', 'grid', '4', "
                          "'points', '0', 'status', 's', 'circuitId', 'x')))))) as MRData")
    flat = race_results(responses)
    assert rows(flat, "grid", "position") == [(4.0, None)]
    assert flat._jdf.queryExecution().analyzed().toString().count("[0-9nN]") == 2


def test_landed_files_are_packed(spark, tmp_path, monkeypatch):
    lines = spark.range(40).selectExpr(
        "id as l_orderkey", "id % 3 as l_suppkey", "id as l_partkey", "int(1 + id % 7) as l_linenumber", "double(id % 50) as l_quantity",
        "id % 10 / 100 as l_tax", "if(id % 2 = 0, 'R', 'A') as l_returnflag", "'O' as l_linestatus", "timestamp_ntz'1999-03-04' as l_shipdate",
    )
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    path = f"{tmp_path}/landed"
    monkeypatch.setattr(ingest, "fresh_path", lambda _: path)
    monkeypatch.setattr(ingest, "LANDED_LINES", 15)
    found = ingest.landed_files(spark, str(tmp_path))
    assert found.agg(F.sum("rows"), F.sum("position")).first() == (40, sum(1.0 + k % 7 for k in range(40) if k % 2))
    written = list(Path(path).glob("part-*"))
    assert len(written) == 3 and all(f.name.endswith(".json.gz") for f in written)


def test_forest_rows_of_a_task_are_bounded(spark, monkeypatch):
    df = spark.range(1000).selectExpr("double(id % 7) as form_grid", "double(id % 20) as grid", "double(id % 13) as position").coalesce(1)
    settings = {"numTrees": 200}
    assert models._spread(df, 1000, ["form_grid"], settings).rdd.getNumPartitions() == 1
    monkeypatch.setattr(models, "TASK_BYTES", 100_000)
    spread = models._spread(df, 1000, ["form_grid"], settings)
    assert spread.rdd.getNumPartitions() == 9 and rows(spread) == rows(df)  # 868 bytes a row


def test_tree_rows_hold_only_what_is_used(spark, tmp_path, monkeypatch):
    orders = spark.range(240).selectExpr(
        "id as o_orderkey", "id % 12 as o_custkey", "if(id % 5 = 0, 'P', 'O') as o_orderstatus", "double(1000 + id * 37 % 500) as o_totalprice",
        "timestamp_ntz'1999-01-15' + make_interval(0, int(id / 12)) as o_orderdate", "if(id % 2 = 0, '1-URGENT', '3-MEDIUM') as o_orderpriority",
    )
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    seen = {}

    def spy(name, then):
        def call(rows, *rest):
            seen[name] = set(rows.columns)
            return then(rows, *rest)

        monkeypatch.setattr(trees, name, call)

    def stop(*_):
        raise StopIteration

    spy("enrich", trees.enrich)
    spy("train_before", lambda *_: (None, Encoders({})))
    spy("season_entries", stop)
    with pytest.raises(StopIteration):
        trees.tree_two_stage(spark, str(tmp_path))
    assert not seen["enrich"] & {"DriverName", "sprint_points"}
    used = {"year", "round", "DriverKey", "Team", "circuitId", "status", "grid", "position", *models.GRID_FEATURES, *models.RACE_FEATURES}
    assert seen["train_before"] == used - {"driver_id", "team_id", "circuit_id"}
    assert seen["season_entries"] == seen["train_before"] - {"position", "status"}
