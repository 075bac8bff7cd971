"""The grid model and the race model on Spark ML, and their two-stage use."""

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.operators.catalog import grid_input
from paceline.operators.grouped import global_medians
from paceline.session import durable

# The feature vectors, in order.
GRID_FEATURES = [
    "team_id", "driver_id", "year", "form_grid", "circuit_importance", "circuit_id",
    "career_grid_avg", "circuit_grid_skill",
]
RACE_FEATURES = [
    "grid", "form_race", "career_race_avg", "pace_rank_season", "team_id", "driver_id", "year",
    "circuit_importance", "circuit_id", "circuit_race_skill", "career_race_pace", "career_best_lap",
    "career_pit_loss", "has_sprint", "sprint_delta",
]

# What a task of a forest may hold of the rows, and what a row takes besides its numbers.
TASK_BYTES = 128 << 20
ROW_BYTES = 64

# The forests. Spark bounds the depth at 30 and has no minimum split size;
# a leaf minimum is its nearest setting.
# Splits are binned: maxBins bounds how many values of a feature can be told apart.
COMMON = dict(seed=42, maxBins=128)
GRID_FOREST = dict(numTrees=200, maxDepth=30, minInstancesPerNode=3, featureSubsetStrategy="sqrt", bootstrap=False, **COMMON)
RACE_FOREST = dict(numTrees=200, maxDepth=18, minInstancesPerNode=8, featureSubsetStrategy="all", bootstrap=True, **COMMON)


@dataclass(frozen=True)
class ForestSettings:
    """Forest parameters; ``override`` changes some for smaller runs."""

    grid: dict = field(default_factory=lambda: dict(GRID_FOREST))
    race: dict = field(default_factory=lambda: dict(RACE_FOREST))

    @classmethod
    def smaller(cls, **override):
        return cls({**GRID_FOREST, **override}, {**RACE_FOREST, **override})


@dataclass(frozen=True)
class TwoStage:
    """Two fitted forests, the features they use and the medians that stand in for gaps."""

    grid: object
    race: object
    grid_features: list
    race_features: list
    medians: dict


def train(rows: DataFrame, settings: ForestSettings | None = None) -> TwoStage:
    """Fit both forests on the features present; rows without the label are left out.

    Gaps that the feature steps leave (an entity without any timing) take the
    column's median over the training rows. The rows are written once, since every tree
    level passes over them.
    """
    settings = settings or ForestSettings()
    grid_features = [c for c in GRID_FEATURES if c in rows.columns]
    race_features = [c for c in RACE_FEATURES if c in rows.columns]
    wanted = list(dict.fromkeys([*grid_features, *race_features]))
    rows = durable(rows.select(*dict.fromkeys([*wanted, "grid", "position"])))
    gaps = rows.select(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in wanted]).first()
    medians = {c: m or 0.0 for c, m in global_medians(rows, [c for c in wanted if gaps[c]]).items()}
    grid_rows = rows.where(F.col("grid").isNotNull()).fillna(medians)
    race_rows = rows.where(F.col("position").isNotNull()).fillna(medians)
    grid_rows = _spread(grid_rows, gaps["_rows"], grid_features, settings.grid)
    race_rows = _spread(race_rows, gaps["_rows"], race_features, settings.race)
    return TwoStage(
        _forest(grid_features, "grid", "pred_grid", settings.grid).fit(_assemble(grid_rows, grid_features)),
        _forest(race_features, "position", "Course_Score", settings.race).fit(_assemble(race_rows, race_features)),
        grid_features,
        race_features,
        medians,
    )


def _spread(rows, count, features, settings):
    """The rows in enough parts that a forest's copy of a part stays near TASK_BYTES.

    The forest keeps for each row its bins and how often each tree draws it: four bytes for
    a feature and a tree. Files are read by their size on disk, which says little about that.
    """
    each = 4 * (len(features) + settings["numTrees"]) + ROW_BYTES
    parts = -(-count * each // TASK_BYTES)
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def _assemble(rows, features):
    return VectorAssembler(inputCols=features, outputCol="features").transform(rows)


def _forest(features, label, prediction, settings):
    return RandomForestRegressor(
        featuresCol="features", labelCol=label, predictionCol=prediction, **settings
    )


def score(models: TwoStage, entries: DataFrame, use_real) -> DataFrame:
    """Predict the grid, choose predicted or real per row, and predict the finish.

    ``entries`` carries every feature but the predicted grid; a ``grid`` column, if
    there is one, is the real grid. One map-only pass over all races.
    """
    if "grid" not in entries.columns:
        entries = entries.withColumn("grid", F.lit(None).cast("double"))
    fill = {c: m for c, m in models.medians.items() if c != "grid"}
    rows = entries.fillna(fill).withColumnRenamed("grid", "real_grid")
    rows = models.grid.transform(_assemble(rows, models.grid_features)).drop("features")
    rows = rows.withColumn("Grid_Input", grid_input("pred_grid", "real_grid", use_real)).withColumn(
        "grid", F.col("Grid_Input")
    )
    rows = models.race.transform(_assemble(rows, models.race_features)).drop("features", "grid")
    return rows


def importances(model, features) -> DataFrame:
    """(feature, importance) of a fitted forest, largest first."""
    spark = SparkSession.active()
    rows = list(zip(features, [float(x) for x in model.featureImportances.toArray()]))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))
