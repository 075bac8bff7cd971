"""The stored tables as one fact table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline import schemas
from paceline.operators.joins import with_circuit, with_sprint
from paceline.sources.tables import read_table

# The stored tables.
TABLES = {
    "results": schemas.RESULTS,
    "calendar": schemas.CALENDAR,
    "sprint": schemas.SPRINT,
    "extra": schemas.TIMING,
    "latest_qualifying": schemas.QUALIFYING,
}


def read_stored(spark: SparkSession, folder, name, fmt="parquet") -> DataFrame | None:
    return read_table(spark, f"{folder}/{name}", TABLES[name], fmt)


def load_facts(spark: SparkSession, folder, fmt="parquet", times=None) -> DataFrame | None:
    """Results with circuit and sprint columns, or None if no results are stored.

    A circuit the results name themselves goes before the calendar's. A stored calendar may repeat a race;
    then a result is there once for each of these rows, or, with ``times``, once for each circuit with
    the number of rows in that column: the rows then do not grow with the square of a race's rows.
    """
    results = read_stored(spark, folder, "results", fmt)
    if results is None:
        return None
    calendar = read_stored(spark, folder, "calendar", fmt)
    if calendar is not None:
        own = results.withColumnRenamed("circuitId", "_own")
        results = with_circuit(own, calendar, times=times).withColumn("circuitId", F.coalesce("_own", "circuitId")).drop("_own")
    elif times:
        results = results.withColumn(times, F.lit(1).cast("long"))
    return with_sprint(results, read_stored(spark, folder, "sprint", fmt))
