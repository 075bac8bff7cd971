"""Token ids in seekable zstandard files.

A file is a row of independent zstandard frames, then an index frame and a seek table, both in
skippable frames, so any zstandard tool reads the ids. A document has frames of its own
(several if it is long), so a reader decompresses only the documents it was asked for.

Layout of a file:

* data frames: ids as little-endian unsigned 32-bit integers
* skippable frame ``INDEX``: zstandard frame of one entry (``ENTRY``) per document in file order
* skippable frame ``TABLE``: per data frame compressed size, size and checksum (``FRAME``), then the
  footer: number of frames, a descriptor byte (checksums present), ``SEEKABLE``

Checksums are the lower 32 bits of xxhash64 over the decompressed bytes of a frame.
"""

import struct
import uuid
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paceline.llm.batches import free_name, slices, small_batches
from paceline.llm.words import TextIds
from paceline.session import durable

#: Fixed values of the published seekable format.
TABLE, INDEX, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1, 0x80
FRAME = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
ENTRY = np.dtype([("key", "<i8"), ("has_key", "<u1"), ("frame", "<u4"), ("frames", "<u4"), ("tokens", "<u8")])
FRAME_IDS = 1 << 20
RUN_BYTES = 1 << 20
LEVEL = 3
END_ID = 2
MANIFEST = "part int, path string, documents long, tokens long, bytes long"
FOUND = "part int, place long, doc_id long, n_tokens long, ids_crc32 long, ids binary"


class Encoder(TextIds):
    """Ids of whole texts by the tokenizers library, which is asked once for each distinct word.

    One serves all tasks of a Python worker: they have most words in common, and no other
    operator with a memory of its own runs beside it.
    """

    most = 600_000
    shared = {}

    @classmethod
    def of(cls, path):
        if path not in cls.shared:
            cls.shared[path] = cls(path)
        return cls.shared[path]

    def word_ids(self, words):
        tokenize = self.tokenizer.model.tokenize
        return [array("I", [t.id for t in tokenize(w)]).tobytes() for w in words]


@dataclass
class Writer:
    """Writes one file: frames first, index and seek table at the end."""

    out: object

    def __post_init__(self):
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames, self.entries, self.bytes = [], [], 0

    def _put(self, data):
        self.out.write(data)
        self.bytes += len(data)

    def add(self, key, ids: bytes):
        first = len(self.frames)
        for k in range(0, len(ids), 4 * FRAME_IDS):
            piece = ids[k : k + 4 * FRAME_IDS]
            packed = self.packer.compress(piece)
            self.frames.append((len(packed), len(piece), xxhash.xxh64_intdigest(piece) & 0xFFFFFFFF))
            self._put(packed)
        self.entries.append((key or 0, key is not None, first, len(self.frames) - first, len(ids) // 4))

    def close(self):
        index = self.packer.compress(np.array(self.entries, dtype=ENTRY).tobytes())
        table = np.array(self.frames, dtype=FRAME).tobytes() + struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        for magic, body in ((INDEX, index), (TABLE, table)):
            self._put(struct.pack("<II", magic, len(body)) + body)


class Reader:
    """Reads the seek table and the index of an open file, then single documents."""

    def __init__(self, source):
        self.source, size = source, source.size()
        frames, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or descriptor != CHECKSUMS:
            raise ValueError("no seek table")
        at = size - 9 - frames * FRAME.itemsize - 8
        self.frames = np.frombuffer(self._at(at + 8, frames * FRAME.itemsize), dtype=FRAME)
        self.starts = np.concatenate([[0], np.cumsum(self.frames["packed"], dtype=np.int64)])
        first = int(self.starts[-1])
        packed = self._at(first + 8, at - first - 8)
        self.unpacker = zstandard.ZstdDecompressor()
        self.entries = np.frombuffer(self.unpacker.decompress(packed), dtype=ENTRY)

    def _at(self, start, size):
        self.source.seek(start)
        return self.source.read(size)

    def ids(self, place) -> bytes:
        """The ids of the document at this place of the file, its frames checked."""
        return next(self.row(place, place + 1))

    def row(self, start, stop):
        """The ids of neighbouring documents; runs of about RUN_BYTES are read at once."""
        while start < stop:
            first = int(self.entries[start]["frame"])
            end = start + 1
            while end < stop and self._end(end) - int(self.starts[first]) <= RUN_BYTES:
                end += 1
            base = int(self.starts[first])
            packed = self._at(base, self._end(end - 1) - base)
            for place in range(start, end):
                yield b"".join(self._frames(place, packed, base))
            start = end

    def _end(self, place):
        entry = self.entries[place]
        return int(self.starts[int(entry["frame"]) + int(entry["frames"])])

    def _frames(self, place, packed, base):
        first = int(self.entries[place]["frame"])
        for number in range(first, first + int(self.entries[place]["frames"])):
            frame, at = self.frames[number], int(self.starts[number]) - base
            piece = self.unpacker.decompress(packed[at : at + int(frame["packed"])])
            if len(piece) != frame["size"] or xxhash.xxh64_intdigest(piece) & 0xFFFFFFFF != frame["checksum"]:
                raise ValueError(f"frame of document {place} is damaged")
            yield piece


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, key="doc_id", text="text", end_id=END_ID) -> DataFrame:
    """Encode every text, append ``end_id`` and write files in ascending key order; returns the manifest.

    Null texts count as empty and null keys come first; rows of equal key are ordered by their text,
    and a hot key spreads over as many files as it needs. Other columns are not written. The manifest
    has a row per file; without documents it has none. A task writes under a name of its own and renames
    at the end, so a repeated task leaves the same file.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    read = free_name(docs, "read")
    by = ["doc_id", F.xxhash64("text"), "text", read]
    docs = docs.withColumn(read, F.monotonically_increasing_id()).repartitionByRange(*by[:2], read).sortWithinPartitions(*by)

    def write(batches):
        part = TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        store.create_dir(base, recursive=True)
        name, own = f"{base}/part-{part:06d}.ids.zst", f"{base}/.{uuid.uuid4().hex}"
        encoder, writer, out = Encoder.of(tokenizer), None, None
        end = struct.pack("<I", end_id)
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for first, texts in slices(batch, "text"):
                if writer is None:
                    out = store.open_output_stream(own)
                    writer = Writer(out)
                for row, ids in enumerate(encoder.encode([t.decode() for t in texts]), first):
                    writer.add(keys[row], ids + end)
        if writer is None:
            return
        writer.close()
        out.close()
        if store.get_file_info(name).type != fs.FileType.NotFound:  # left by an earlier attempt of this task
            store.delete_file(name)
        store.move(own, name)
        tokens = sum(e[4] for e in writer.entries)
        row = [[part], [name], [len(writer.entries)], [tokens], [writer.bytes]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], names=["part", "path", "documents", "tokens", "bytes"]).cast(
            pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())])
        )

    return durable(docs.select("doc_id", "text").mapInArrow(write, MANIFEST))


def read_token_files(manifest: DataFrame, folder: str, doc_ids: DataFrame | None = None, with_ids=False) -> DataFrame:
    """The documents as the files hold them: key, place in the file, token count, crc32 and on request the ids.

    With ``doc_ids`` (one column, ``doc_id``; as small as a request is) only their frames are decompressed.
    """
    import zlib

    context = manifest.sparkSession.sparkContext
    wanted = None
    if doc_ids is not None:
        wanted = context.broadcast({r["doc_id"] for r in doc_ids.select("doc_id").toLocalIterator()})

    def read(batches):
        store = fs.FileSystem.from_uri(folder)[0] if "://" in folder or folder.startswith("file:") else fs.LocalFileSystem()
        for batch in batches:
            for part, path in zip(batch.column("part").to_pylist(), batch.column("path").to_pylist()):
                with store.open_input_file(path) as source:
                    reader = Reader(source)
                    keys = [int(e["key"]) if e["has_key"] else None for e in reader.entries]
                    for first in range(0, len(keys), 256):
                        places = range(first, min(first + 256, len(keys)))
                        if wanted is None:
                            found = zip(places, reader.row(places[0], places[-1] + 1))
                        else:
                            found = ((p, reader.ids(p)) for p in places if keys[p] in wanted.value)
                        rows = [(part, p, keys[p], len(ids) // 4, zlib.crc32(ids), ids if with_ids else None) for p, ids in found]
                        columns = list(zip(*rows)) if rows else [[]] * 6
                        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                        names = ["part", "place", "doc_id", "n_tokens", "ids_crc32", "ids"]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return spread(manifest).select("part", "path").mapInArrow(read, FOUND)


def spread(manifest: DataFrame) -> DataFrame:
    """A task for each file or so: the manifest's rows are tiny, the files are not."""
    files = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(files, "path")


def starts(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all documents before each one, across all files.

    Running sums stay within a file; what crosses files is one total per file.
    """
    before = F.sum("tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = manifest.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.sum("n_tokens").over(W.partitionBy("part").orderBy("place").rowsBetween(W.unboundedPreceding, -1))
    placed = found.withColumn("within", F.coalesce(within, F.lit(0)))
    return placed.join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("within")).drop("offset", "within")
