"""Session helpers: the shared folder and durable intermediate results."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# By application: the folder of a session without a setting, and the paths given out.
_OWN, _WRITTEN = {}, {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session within one process (``local`` and ``local[...]``) may do without the
    setting; it gets a temporary folder of its own, and only for this library.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="paceline-")
    return _OWN[context.applicationId]


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this run has written to the shared folder; call it when its results are stored elsewhere."""
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fresh_path(spark: SparkSession) -> str:
    """A new path in the shared folder, for rows that only this run needs."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """The rows, written to a table in the shared folder and read back.

    This cuts the lineage: a lost executor can neither change the rows nor make them
    be computed again. Readers prune columns and know the size.
    """
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
