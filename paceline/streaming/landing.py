"""Keep a stored table current from a folder that responses land in."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline import schemas
from paceline.operators.skew import lookup_side
from paceline.session import durable
from paceline.sources.tables import overwrite_arrived, read_table


def stream_responses(spark: SparkSession, folder) -> DataFrame:
    """Landed responses, one document per line, as a stream. The flatteners apply as they are."""
    return spark.readStream.schema(schemas.RESPONSE).json(folder)


def keep_current(flattened: DataFrame, path, checkpoint, order=(), season="year", seq="round"):
    """Writer that replaces, batch by batch, the races a batch brings.

    The other races of a season stay, so a season may land in any number of batches. The
    seasons concerned are put together anew and replace theirs in one commit; running a
    batch again after a failure gives the same table.
    """

    def replace(batch, _):
        rows = durable(batch)
        stored = read_table(rows.sparkSession, path, rows.schema)
        if stored is not None:
            seasons, races = (lookup_side(rows.select(*keys).distinct()) for keys in ([season], [season, seq]))
            kept = stored.join(seasons, season, "left_semi").join(races, [season, seq], "left_anti")
            rows = durable(rows.unionByName(kept, allowMissingColumns=True))
        overwrite_arrived(rows.where(F.col(season).isNotNull()), path, order, season)

    return flattened.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
