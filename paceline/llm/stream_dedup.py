"""Exact deduplication as a stream with keyed state on disk.

Rows land once in a content store. A stream over the store's narrow columns keeps, for each
digest and without expiry, how often it came, the identifier of the best row so far and the
row's locator in the store. The state lives in RocksDB under the stream's checkpoint, so it
can outgrow memory, survives executors and is taken up again by the next run. A digest alone
never decides: every hit is compared with the whole text of the row it hit.
"""

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from paceline.llm.batches import without
from paceline.llm.sharding import PARTITION_BITS
from paceline.session import durable, fresh_path

#: State on disk. A store is closed after each commit: an open one reserves megabytes of each executor's disk.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
}
#: Files that one micro-batch reads.
BATCH_FILES = 10_000
#: Hits are broadcast as (locator, locator) pairs up to this many rows; beyond it they are joined by shuffle.
BROADCAST_HITS = 500_000
RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def normal(text):
    """The text without the characters that do not count; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def sha256(normal_text):
    return F.sha2(normal_text, 256)


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def land(docs: DataFrame, folder: str, key="doc_id", text="text", digest=sha256) -> int:
    """Append rows to the content store, with a locator, a digest and the order of preference; the first locator is returned.

    A locator is unique in the store: the high bits number the partitions of all landings so far, the
    low bits the rows of one. Landings in one store must follow each other and have the same columns.
    """
    content = normal(F.col(f"`{text}`"))
    first = next_locator(docs.sparkSession, folder)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{key}`").cast("long").alias("id"),
        F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("chars"),
        (F.monotonically_increasing_id() + first).alias("locator"),
        F.sha2(content, 256).alias("sha256"),
        digest(content).alias("digest"),
    )
    rows.write.mode("append").parquet(folder)
    return first


def next_locator(spark, folder: str) -> int:
    """The first locator of the partition that follows all that the store has; 0 for a store that is not there yet."""
    try:
        last = spark.read.parquet(folder).agg(F.max("locator").alias("last")).first()["last"]
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return 0
        raise
    return 0 if last is None else ((last >> PARTITION_BITS) + 1) << PARTITION_BITS


def preference():
    """The larger, the better: most code points, then the smallest identifier (null last), then the first place."""
    return F.struct(
        "chars", F.bitwise_not(F.col("id")).alias("least_id"), F.bitwise_not(F.col("locator")).alias("least_locator")
    )


def update_state(spark, store: str, checkpoint: str, batch_files=BATCH_FILES) -> None:
    """Take all files that the store has got since the last call into the state.

    Within a micro-batch equal digests are combined before the shuffle, so a digest of any
    number of rows costs each task one row.
    """
    schema = spark.read.parquet(store).select("id", "chars", "locator", "digest").schema
    with settings(spark, DISK_STATE):
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", batch_files).parquet(store)
        state = rows.groupBy("digest").agg(F.max(preference()).alias("best"), F.count(F.lit(1)).alias("copies"))
        # The result is the state itself, which read_state() reads from the checkpoint.
        query = (
            state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()


def read_state(spark, checkpoint: str) -> DataFrame:
    """(digest, keep_id, keep_locator, copies) of every digest seen so far."""
    kept = spark.read.format("statestore").load(checkpoint)
    best, copies = [f"value.`{f.name}`" for f in kept.schema["value"].dataType.fields]
    return kept.select(F.col("key.digest").alias("digest"), F.col(best).alias("best"), F.col(copies).alias("copies")).select(
        "digest",
        F.bitwise_not(F.col("best.least_id")).alias("keep_id"),
        F.bitwise_not(F.col("best.least_locator")).alias("keep_locator"),
        "copies",
    )


def exact_dedup(docs: DataFrame, key="doc_id", text="text", digest=sha256, batch_files=BATCH_FILES) -> DataFrame:
    """The rows that stay and those that go, with ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if they are identical without white space. Of equal ones the row with the
    most code points stays, then the smallest key; of rows equal in both exactly one. A null
    text counts as empty, a null key comes last. Columns of the four names are replaced; an
    empty table gives an empty one.
    """
    spark = docs.sparkSession
    docs = without(docs, RESULT)
    names = docs.columns
    store = fresh_path(spark)
    land(docs, store, key, text, digest)
    found = decisions(spark, store, text, batch_files)
    rows = spark.read.parquet(store)
    joined = rows.select("row", "locator").join(found, "locator")
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in names], *RESULT)


def kept_rows(docs: DataFrame, key="doc_id", text="text", digest=sha256, batch_files=BATCH_FILES) -> DataFrame:
    """Only the rows that stay, with the columns they came with."""
    spark = docs.sparkSession
    names = docs.columns
    store = fresh_path(spark)
    land(docs, store, key, text, digest)
    gone = decisions(spark, store, text, batch_files).where(~F.col("kept")).select("locator")
    rows = spark.read.parquet(store).select("row", "locator")
    return rows.join(checked_broadcast(durable(gone)), "locator", "left_anti").select(*[F.col(f"row.`{c}`").alias(c) for c in names])


def dedup_more(docs: DataFrame, store: str, checkpoint: str, key="doc_id", text="text", digest=sha256, batch_files=BATCH_FILES) -> DataFrame:
    """Land rows in a store and take them into the state kept at ``checkpoint``; decide for every group that got one.

    Store and checkpoint are folders of the caller's, empty at first and used together from then
    on, in this session or a later one. The result has the rows that are new and the earlier rows of
    the same texts, in the form of ``exact_dedup`` and with ``landed_now``: an earlier row may have to make
    way for a new one. No rows change nothing and give no rows. If a call fails after the rows
    have landed, ``update_state`` takes them in.
    """
    spark = docs.sparkSession
    docs = without(docs, (*RESULT, "landed_now"))
    names = docs.columns
    first = land(docs, store, key, text, digest)
    found = decisions(spark, store, text, batch_files, checkpoint, first)
    joined = spark.read.parquet(store).select("row", "locator").join(found, "locator")
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in names], *RESULT, (F.col("locator") >= first).alias("landed_now"))


def decisions(spark, store: str, text="text", batch_files=BATCH_FILES, checkpoint=None, first=0) -> DataFrame:
    """(locator, id, keep_id, group_size, kept, text_sha256) for every row of the store.

    With a ``checkpoint`` the state kept there goes on; without, it is made anew. ``first`` leaves out
    the texts of which no row has a locator from there on.
    """
    checkpoint = checkpoint or fresh_path(spark)
    rows = spark.read.parquet(store)
    if rows.isEmpty():
        state = spark.createDataFrame([], "digest string, keep_id long, keep_locator long, copies long")
    else:
        update_state(spark, store, checkpoint, batch_files)
        state = read_state(spark, checkpoint)
    narrow = rows.select("locator", "id", "chars", "digest", "sha256")
    if first:
        fresh = durable(narrow.where(F.col("locator") >= first).select("digest").distinct())
        narrow = narrow.join(fresh, "digest", "left_semi")
    placed = durable(narrow.join(state, "digest"))
    differing = durable(false_hits(rows, placed, text))
    result = placed
    if not differing.isEmpty():  # different texts share a digest: these digests are settled by the text itself
        shared = placed.join(differing, "digest", "left_semi")
        by_text = (
            rows.select("locator", normal(F.col(f"row.`{text}`")).alias("content")).join(shared, "locator")
            .withColumn("content", F.concat("sha256", F.lit(":"), "content"))
        )
        best = by_text.groupBy("content").agg(F.max(preference()).alias("best"), F.count(F.lit(1)).alias("copies"))
        settled = by_text.drop("copies", "keep_id", "keep_locator").join(best, "content").select(
            "digest", "locator", "id", "chars", "sha256",
            F.bitwise_not(F.col("best.least_id")).alias("keep_id"),
            F.bitwise_not(F.col("best.least_locator")).alias("keep_locator"), "copies",
        )
        result = placed.join(differing, "digest", "left_anti").unionByName(settled)
    return result.select(
        "locator", "id", "keep_id", F.col("copies").alias("group_size"),
        (F.col("locator") == F.col("keep_locator")).alias("kept"), F.col("sha256").alias("text_sha256"),
    )


def checked_broadcast(table: DataFrame) -> DataFrame:
    """A stored table of numbers as a broadcast side if its rows are few enough, else for a shuffle."""
    return F.broadcast(table) if table.count() <= BROADCAST_HITS else table


def false_hits(rows: DataFrame, placed: DataFrame, text) -> DataFrame:
    """The digests under which a row's whole text differs from the text of the row it hit.

    Only texts of hits and of the rows they hit are moved. The hit rows may pile up on one
    locator; the join can split them.
    """
    hits = durable(placed.where((F.col("copies") > 1)).select("locator", "keep_locator", "digest"))
    content = rows.select("locator", normal(F.col(f"row.`{text}`")).alias("content"))
    texts = content.join(checked_broadcast(hits), "locator")
    first = texts.where(F.col("locator") == F.col("keep_locator")).select("keep_locator", F.col("content").alias("kept_content"))
    others = texts.where(F.col("locator") != F.col("keep_locator"))
    pairs = others.join(first, "keep_locator")
    return pairs.where(F.col("content") != F.col("kept_content")).select("digest").distinct()
