"""Backtest metrics over predictions joined with what happened."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_K = (3, 5, 10)


def scored(predictions: DataFrame, actuals: DataFrame, race=("year", "round"), entity="DriverKey") -> DataFrame:
    """Predictions with the actual place and the real grid of the same entry."""
    real = actuals.select(*race, entity, F.col("position").alias("actual"), F.col("grid").alias("real_grid"))
    return predictions.drop("actual", "real_grid").join(real, [*race, entity])


def backtest(rows: DataFrame, by=(), predicted="Pos", actual="actual", grid="real_grid") -> DataFrame:
    """Winner accuracy, strict top-k shares, MAE and the real grid's MAE, per ``by``.

    A strict top-k share is the share of the slots 1..k whose predicted driver is the
    one that finished there. Everything is one aggregate with map-side combine.
    """
    p, a = F.col(predicted), F.col(actual)
    hit = (p == a).cast("double")
    measures = [F.avg(F.when(p == 1, hit)).alias("winner")]
    measures += [F.avg(F.when(p <= k, hit)).alias(f"top{k}") for k in TOP_K]
    measures += [
        F.avg(F.abs(p - a)).alias("mae"),
        F.avg(F.abs(F.col(grid) - a)).alias("grid_mae"),
        F.count(F.lit(1)).alias("rows"),
    ]
    return rows.groupBy(*by).agg(*measures)
