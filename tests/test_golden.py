"""Small cases with known values."""

import datetime

import pytest
from pyspark.sql import functions as F

from paceline.functions import scalars
from paceline.operators.catalog import find_races, grid_input, with_display_name
from paceline.operators.grouped import correlation_by, fill_group_median, global_medians, group_median, last_wins
from paceline.operators.history import Career, Carried, Recent, with_history
from paceline.operators.joins import as_of_cutoff, sprint_features, with_circuit, with_sprint
from paceline.operators.laps import compound_changes, lap_seconds, pace, stints, timing_features
from paceline.operators.ranking import dense_scaled_rank, label_index
from paceline.sources.tables import replace_seasons
from tests.helpers import by, rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def values(spark, items, entity="e"):
    data = [(entity, i, None if v is None else float(v)) for i, v in enumerate(items)]
    return spark.createDataFrame(data, "entity string, seq int, v double")


def feature(spark, df, *features):
    found = with_history(df, ["entity"], ["seq"], list(features)).orderBy("seq").collect()
    return [[r[f.name] for r in found] for f in features]


def test_form_and_career(spark):
    form, career = feature(spark, values(spark, [1, None, 3, 5, 9]), Recent("f", "v"), Career("c", "v"))
    assert form == [None, 1, 1, 2, 4]
    assert career == [None, 1, 1, 2, 3]


def test_fill_and_unknown_entity(spark):
    [form] = feature(spark, values(spark, [7, 8, 9], entity=None), Recent("f", "v", 3, 13.0))
    assert form == [13.0, 13.0, 13.0]


def test_many_unknown_entities(spark, small_groups):
    df = values(spark, range(50), entity=None).unionByName(values(spark, [1, 2]))
    found = with_history(df, ["entity"], ["seq"], [Career("c", "v", 14.0)])
    assert by(found.where("entity is null").groupBy("c").count(), "c", "count") == {14.0: 50}
    assert by(found.where("entity = 'e'"), "seq", "c") == {0: 14.0, 1: 1.0}


def test_correlation(spark):
    data = [("x", 1, 2), ("x", 2, 1), ("x", 3, 3), ("y", 1, 1), ("y", 1, 2), ("z", 4, 4), ("n", None, 1), ("n", 2, None)]
    df = spark.createDataFrame(data, "k string, a int, b int")
    assert by(correlation_by(df, "k", "a", "b", "r"), "k", "r") == {"x": 0.5, "y": 0.5, "z": 0.5, "n": 0.5}
    assert by(correlation_by(df, "k", "a", "b", "r", None), "k", "r") == {"x": 0.5, "y": None, "z": None, "n": None}


def test_dense_rank(spark):
    df = spark.createDataFrame([(0, 2.0), (1, None), (2, 1.0), (3, 2.0)], "id int, v double").withColumn("s", F.lit(1))
    found = dense_scaled_rank(df, ["s"], "v", "scaled", rank_name="rank")
    assert by(found, "id", "rank") == {0: 2, 1: None, 2: 1, 3: 2}
    assert by(found, "id", "scaled") == {0: 1.0, 1: 0.5, 2: 0.5, 3: 1.0}


@pytest.mark.parametrize(
    "compounds, changes",
    [
        (["S"], 0),
        (["S", "S", None, "M"], 1),
        ([None, None, "S"], 0),
        ([None, None], 0),
        (["S", "M", None, "M", "S"], 2),
    ],
)
def test_compound_changes(spark, compounds, changes):
    data = [("d", i, 90.0, False, 1.0, c) for i, c in enumerate(compounds)]
    laps = spark.createDataFrame(data, "d string, lap_number int, lap double, pit boolean, Stint double, Compound string")
    assert timing_features(laps, ["d"]).first()["compound_changes"] == changes


def test_forward_fill(spark):
    df = spark.createDataFrame([("e", i, c) for i, c in enumerate([None, "S", None, "M", None])], "e string, i int, c string")
    found = with_history(df, ["e"], ["i"], [Carried("x", "c", ("i",))])
    assert by(found, "i", "x") == {0: None, 1: "S", 2: "S", 3: "M", 4: "M"}


def test_pit_loss(spark):
    data = [("d", 1, 90.0, False), ("d", 2, 91.0, True), ("d", 3, None, True), ("d", 4, 100.0, True), ("e", 1, None, True)]
    laps = spark.createDataFrame(data, "d string, lap_number int, lap double, pit boolean")
    [row] = pace(laps, ["d"]).collect()  # a driver without lap times drops out
    assert (row["d"], row["mean_pit_loss"], row["pitstops_count"], row["best_lap"]) == ("d", 4.5, 3, 90.0)


@pytest.mark.parametrize("means, loss", [([], None), ([90.0, 92.0], 2.0), ([90.0, 91.0, 95.0], 5.0), ([1.0, 2.0, 3.0, 4.0], None)])
def test_degradation(spark, means, loss):
    data = [("d", i, m, float(i + 5), None) for i, m in enumerate(means)] + [("d", 99, 80.0, None, "S")]
    laps = spark.createDataFrame(data, "d string, lap_number int, lap double, Stint double, Compound string")
    found = stints(laps, ["d"]).collect()
    assert (found[0]["degradation_global"] if found else None) == loss
    if len(means) == 2:
        assert (found[0]["stint1_length"], found[0]["stint3_length"], found[0]["stint_count"]) == (1.0, None, 2)


def test_lap_seconds(spark):
    span = datetime.timedelta
    data = [(1, span(seconds=92, milliseconds=345), None, None), (2, None, span(minutes=3), None), (3, span(0), None, span(1))]
    schema = "n int, LapTime interval day to second, PitInTime interval day to second, PitOutTime interval day to second"
    found = lap_seconds(spark.createDataFrame(data, schema))
    assert rows(found) == [(1, 92.345, False), (2, None, True), (3, 0.0, True)]


def test_numbers(spark):
    found = [one(spark, scalars.number(F.lit(x).cast("string"))) for x in ("1", "R", None, " 3 ", "NaN")]
    assert found == [1.0, None, None, 3.0, None]


@pytest.mark.parametrize(
    "text, mean",
    [("[1.0, 2.5]", 1.75), ("[]", None), ("[1,x]", None), (None, None), ("4.0", 4.0), ("[1, , 3]", 2.0), ("", None)],
)
def test_list_mean(spark, text, mean):
    assert one(spark, scalars.list_mean(F.lit(text).cast("string"))) == mean


@pytest.mark.parametrize(
    "given, family, key",
    [
        ("Kimi", "Räikkönen", "k_raikkonen"),
        ("Nico", "Hülkenberg", "n_hulkenberg"),
        ("Ünal", "Sørensen", "u_srensen"),
        ("Łukasz", "Kubica", "u_kubica"),
        ("周冠宇", "Zhou", None),
        ("", "X", None),
        (None, "X", None),
        ("Jean-Éric", "d'Ambrosio Jr.", "j_dambrosiojr"),
        ("ﬁlip", "Ǆ㎏", "f_dzkg"),
        ("𝐀nna", "Ⅷ", "a_viii"),
    ],
)
def test_entity_key(spark, given, family, key):
    text = lambda x: F.lit(x).cast("string")
    assert one(spark, scalars.entity_key(text(given), text(family))) == key


def test_letters_follow_the_unicode_decomposition(spark):
    import random
    import re
    import unicodedata

    pick = random.Random(5)
    chars = [chr(c) for c in range(0x20, 0x3000) if unicodedata.category(chr(c)) != "Cs"]
    texts = ["".join(pick.choices(chars, k=12)) + pick.choice(["é", "ﬀ", "x"]) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scalars.letters_only("t").alias("x"))
    for row in df.collect():
        decomposed = unicodedata.normalize("NFKD", row["t"]).encode("ascii", "ignore").decode()
        assert row["x"] == re.sub("[^a-zA-Z]", "", decomposed).lower(), row["t"]


def test_names(spark):
    assert one(spark, scalars.title_key(F.lit("m_de_x"))) == "M_De_X"
    assert one(spark, scalars.full_name(F.lit(None).cast("string"), F.lit("Hill"))) == "Hill"


def test_finish_and_search(spark):
    status = ["Finished", "+1 Lap", "Lapped", "finished", "Engine", None]
    assert [one(spark, scalars.finished(F.lit(s).cast("string"))) for s in status] == [True, True, True, False, False, False]
    names = ["Monaco Grand Prix", "GRAND PRIX DE MONACO", "Italian", None]
    assert [one(spark, scalars.name_matches(F.lit(n).cast("string"), "mona.o")) for n in names] == [True, True, False, False]


def test_replace_seasons(spark):
    old = spark.createDataFrame([(2020, 1), (2021, 2), (2022, 3), (None, 4)], "year int, a int")
    new = spark.createDataFrame([(2021, "x")], "year int, b string")
    assert rows(replace_seasons(old, new, 2021, 2021)) == [(2020, 1, None), (2021, None, "x"), (2022, 3, None)]
    assert rows(replace_seasons(None, new, 2021, 2021)) == [(2021, "x")]


def test_last_wins_and_search(spark):
    calendar = spark.createDataFrame(
        [(2020, 3, "Austrian GP"), (2020, 4, "AUSTRIAN two"), (2019, 9, "Old Austria"), (2020, 5, "Monza")],
        "year int, round int, raceName string",
    )
    assert rows(find_races(calendar, "austria")) == [(2019, 9, "Old Austria"), (2020, 4, "Old Austria")]
    assert rows(find_races(calendar, "nothing")) == []
    assert rows(last_wins(calendar, ["year"], ["raceName"], ["round"])) == [(2019, "Old Austria"), (2020, "Monza")]


def test_sprints(spark):
    facts = spark.createDataFrame(
        [(2021, 1, None, 4.0), (2021, 1, "a", 8.0), (2021, 2, "a", 6.0)], "year int, round int, DriverKey string, grid double"
    )
    sprint = spark.createDataFrame(
        [(2021, 1, None, 5.0, 3.0, 1.0)],
        "year int, round int, DriverKey string, sprint_grid double, sprint_pos double, sprint_points double",
    )
    found = sprint_features(with_sprint(facts, sprint))
    assert rows(found, "DriverKey", "grid", "has_sprint", "sprint_delta", "sprint_pos") == [
        (None, 4.0, 1, 2.0, 3.0), ("a", 6.0, 0, 0.0, 6.0), ("a", 8.0, 0, 0.0, 8.0)
    ]
    absent = with_sprint(facts, None)
    assert absent.where("sprint_pos is not null or sprint_grid is not null").isEmpty()


def test_circuits(spark):
    facts = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, "b")], "year int, round int, circuitId_x string, circuitId_y string")
    merged = with_circuit(facts, None)
    assert rows(merged, "round", "circuitId") == [(1, "a"), (2, "b")] and "circuitId_x" not in merged.columns


def test_as_of(spark):
    history = spark.createDataFrame(
        [("a", 2020, 1, 1.0), ("a", 2020, 3, None), ("a", 2021, 2, 9.0), ("b", 2021, 5, 3.0)],
        "DriverKey string, year int, round int, form double",
    )
    targets = spark.createDataFrame([("a",), ("b",), ("c",)], "DriverKey string")
    at = lambda cutoff: by(as_of_cutoff(history, targets, "DriverKey", "year", "round", cutoff, {"form": 13.0}), "DriverKey", "form")
    assert at((2020, 2)) == {"a": 1.0, "b": 13.0, "c": 13.0}
    assert at((2021, 2)) == {"a": 13.0, "b": 13.0, "c": 13.0}  # the last row counts, even when it is null
    assert at((2021, 3)) == {"a": 9.0, "b": 13.0, "c": 13.0}


def test_medians_and_labels(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 4.0), ("b", None), (None, None), (None, 3.0)], "k string, v double")
    assert rows(fill_group_median(df, ["k"], ["v"])) == [
        (None, None), (None, 3.0), ("a", 1.0), ("a", 2.5), ("a", 4.0), ("b", None)
    ]
    assert by(label_index(df, "k", "n"), "k", "n") == {"None": 0, "a": 1, "b": 2}


def test_display_name_and_grid(spark):
    rows_ = spark.createDataFrame([("a_x", "own"), ("b_y", None)], "DriverKey string, DriverName string")
    names = spark.createDataFrame([("a_x", "Old", 1), ("a_x", "New", 2), ("a_x", None, 3)], "DriverKey string, DriverName string, o int")
    assert by(with_display_name(rows_, names, ["o"]), "DriverKey", "DriverName") == {"a_x": "New", "b_y": "B_Y"}
    grids = spark.createDataFrame([(1, 2.0, 7.0), (2, None, 8.0)], "i int, real double, pred double")
    pick = lambda use: by(grids.select("i", grid_input("pred", "real", use).alias("g")), "i", "g")
    assert pick(True) == {1: 2.0, 2: 8.0} and pick(False) == {1: 7.0, 2: 8.0}


def test_compound_changes_without_any_compound(spark):
    laps = spark.createDataFrame([("d", 1, None)], "d string, lap_number int, Compound string")
    assert rows(compound_changes(laps, ["d"], ["lap_number"])) == [("d", 0)]


def test_approximate_medians(spark):
    df = spark.range(1, 1002).select(F.col("id").cast("double").alias("v"), (F.col("id") % 2).alias("k"))
    assert global_medians(df, ["v"], approx=True) == {"v": 501.0}
    assert rows(group_median(df, ["k"], "v", "m", approx=True)) == [(0, 500.0), (1, 501.0)]
