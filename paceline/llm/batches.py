"""Small helpers for operators that walk Arrow batches inside tasks."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

#: Bytes of text that an operator turns into Python objects at a time. One longer text still makes one slice.
SLICE_BYTES = 2_000_000
#: Bytes of an Arrow batch on its way to Python. Spark's default suits narrow rows; here rows hold whole texts.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark):
    """Keep Arrow batches small for the rest of the session, unless it was set up with a size of its own."""
    if not spark.sparkContext.getConf().contains(BATCH_CONF):
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def texts_of(batch, column):
    """The column of a batch as bytes; null counts as empty."""
    return pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")


def slices(batch, column, limit=SLICE_BYTES):
    """(first row, texts as bytes) of consecutive rows with about ``limit`` bytes of text each."""
    texts = texts_of(batch, column)
    lengths = pc.binary_length(texts).to_pylist()
    first, size = 0, 0
    for row, length in enumerate(lengths):
        if row > first and size + length > limit:
            yield first, texts.slice(first, row - first).to_pylist()
            first, size = row, 0
        size += length
    if first < len(lengths):
        yield first, texts.slice(first).to_pylist()


def word_blocks(text, limit=SLICE_BYTES):
    """Lists of consecutive words of a text whose separators are spaces, from about ``limit`` bytes each.

    A word is never cut, so one of more bytes makes a longer block.
    """
    first = 0
    while first < len(text):
        last = text.find(b" ", first + limit)
        last = len(text) if last < 0 else last
        yield text[first:last].split()
        first = last


def with_columns(batch, columns):
    """The batch with these columns; columns of the same name (in any case) are replaced."""
    taken = {name.lower() for name in columns}
    names = [n for n in batch.schema.names if n.lower() not in taken]
    arrays = [batch.column(n) for n in names]
    return pa.RecordBatch.from_arrays([*arrays, *columns.values()], names=[*names, *columns])


def without(df, names):
    """The frame without columns of these names, in any case."""
    taken = {n.lower() for n in names}
    return df.select([f"`{c}`" for c in df.columns if c.lower() not in taken])


def free_name(df, name):
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(docs, text):
    """The column ``text`` under that name and all other columns in a struct ``row``, so that no added column can clash with one."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(F.struct(*(others or [F.lit(0)])).alias("row"), F.col(f"`{text}`").alias("text"))


def unpacked(rows, names, text):
    """The columns as they came to ``packed``, in their order."""
    return rows.select([F.col("text" if c == text else f"row.`{c}`").alias(c) for c in names])
