"""Stored tables: readers, optional sources and the season-range sinks."""

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from paceline.functions.scalars import outside, without_nan
from paceline.session import durable
from paceline.sources.landed import FIRST_SPRINT_SEASON


def read_table(spark: SparkSession, path, schema, fmt="parquet") -> DataFrame | None:
    """The table with its fixed schema, or None where nothing is stored.

    Columns the files lack read as null, and so does NaN. CSV columns are found by the
    header of each file, so files of several headers make one table.
    """
    try:
        stored = _read_csv(spark, path, schema) if fmt == "csv" else spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return without_nan(stored)


def _read_csv(spark, path, schema):
    """The files of each header by name, and all of them together.

    A pass over the first block of each file finds its header; it keeps a row per file.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    first = lines.where(F.col("at") == 0).groupBy("file").agg(F.first("value").alias("header"))
    headers = first.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    if len(headers) <= 1:
        return typed(spark.read.options(header=True, enforceSchema=False).csv(path), fields)
    read = spark.read.options(header=True, enforceSchema=False, basePath=path)
    parts = [typed(read.csv(row["files"]), fields) for row in headers]
    return reduce(DataFrame.unionByName, parts)


def typed(df: DataFrame, schema) -> DataFrame:
    """The schema's columns; texts that do not convert, and missing columns, are null."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    texts = [F.col(f.name) if f.name in df.columns else F.lit(None) for f in fields]
    return df.select(*[text.try_cast(f.dataType).alias(f.name) for text, f in zip(texts, fields)])


def read_race(table: DataFrame | None, year, rnd, columns) -> DataFrame | None:
    """The rows of one race; the filter reaches the scan."""
    if table is None:
        return None
    race = table.where((F.col("year") == year) & (F.col("round") == rnd))
    return present(race, columns)


def present(df: DataFrame, columns) -> DataFrame:
    """Project the listed columns that exist."""
    return df.select(*[c for c in columns if c in df.columns])


def has_race(table: DataFrame | None, year, rnd) -> bool:
    """Whether a table holds any row of the race."""
    if table is None or not {"year", "round"} <= set(table.columns):
        return False
    return not read_race(table, year, rnd, ["year"]).isEmpty()


def with_defaults(df: DataFrame, defaults) -> DataFrame:
    """Add the columns that are missing, each with its constant."""
    missing = {c: F.lit(v).cast("double") for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def replace_seasons(old: DataFrame | None, new: DataFrame, first, last, season="year") -> DataFrame:
    """Old rows outside the range of seasons, and all new rows, matched by column name."""
    if old is None:
        return new
    return old.where(outside(season, first, last)).unionByName(new, allowMissingColumns=True)


def sprint_range(first, last):
    """There are no sprints before the first sprint season."""
    return max(first, FIRST_SPRINT_SEASON), last


def write_seasons(new: DataFrame, path, first, last, order=(), season="year", fmt="parquet") -> bool:
    """Replace a range of seasons of a stored table; other seasons are not touched.

    The table is partitioned by season. New seasons replace theirs through Spark's
    dynamic partition overwrite (staged, committed at the end); seasons of the range
    without new rows are dropped afterwards. Running it again gives the same table.
    Nothing happens when there are no new rows, and a row outside the range fails the
    write before it is committed. Rows are laid out by range, so a season of any size
    is spread over files and sorted along ``order``. The new rows are computed once, into
    the shared folder; laying them out by range needs them twice. The seasons that arrived
    are observed while writing.
    """
    new = durable(new)
    if new.isEmpty():
        return False
    stray = F.raise_error(F.concat_ws(" ", F.lit(f"season outside {first}-{last}:"), F.col(season)))
    checked = new.withColumn(season, F.when(F.col(season).between(first, last), F.col(season)).otherwise(stray))
    arrived = Observation()
    overwrite_arrived(checked.observe(arrived, F.collect_set(season).alias("seasons")), path, order, season, fmt)
    drop_seasons(new.sparkSession, path, set(range(first, last + 1)) - set(arrived.get["seasons"]), season)
    return True


def overwrite_arrived(new: DataFrame, path, order=(), season="year", fmt="parquet") -> None:
    """Replace exactly the seasons that have new rows."""
    by = [F.col(season), *[F.col(c).asc_nulls_last() for c in order]]
    writer = new.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.partitionBy(season).option("partitionOverwriteMode", "dynamic").format(fmt).save(path)


def drop_seasons(spark: SparkSession, path, seasons, season="year"):
    """Remove the partitions of the given seasons, where they exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for value in sorted(seasons):
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{season}={value}"), True)


def write_whole(df: DataFrame, path, order=(), fmt="parquet") -> None:
    """Overwrite a table with the given rows only."""
    by = [F.col(c).asc_nulls_last() for c in order]
    out = df.repartitionByRange(*by).sortWithinPartitions(*by) if by else df
    writer = out.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def write_latest(df: DataFrame, path, fmt="parquet") -> bool:
    """Keep only the latest race; an empty fetch leaves the old one in place."""
    df = durable(df)
    if df.isEmpty():
        return False
    write_whole(df, path, fmt=fmt)
    return True
