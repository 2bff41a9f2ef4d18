"""Token ids in files of independent zstandard frames with a seek table.

A table of tokens is a folder: `data/` holds files, `manifest/` (Parquet) names
those that count, in order. A file is plain zstandard, so `zstd -d` gives its
ids, all documents end to end, as little-endian unsigned numbers of 2 or 4 bytes:

    frame, frame, ...        whole documents, up to FRAME_IDS ids; a longer
                             document has frames of its own, of at most LARGEST
    skippable frame          document index: width, then doc_id and number of ids
    skippable frame          seek table: per frame compressed size, plain size and
                             the low half of xxh64 of the plain bytes; then the
                             number of frames, a flag for checksums, a magic number

The seek table is that of zstandard's seekable format. A reader looks at the end
of a file, then at the frames of the documents it wants; each frame is checked
against its sum as it is decompressed.

Documents are in ascending order of doc_id over all files: nulls first, equal
doc_ids in any order, each row a document of its own. Null text is empty and has
the end id alone, as has any text without tokens. An empty table gives a manifest
without rows. Columns other than doc_id and text are not read.

A task writes each file under a name of its own attempt and returns that name;
only the manifest makes it part of the table, so lost or repeated attempts leave
files that nobody reads. Files end at FILE_IDS ids, so memory is bounded by one
frame, one text and one file's index. Paths are those that pyarrow's file systems
know (local or mounted folders, hdfs, s3, gcs), the same on all executors.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from altigrid.llm.common import hold, small_batches
from altigrid.llm.packing import BLOCK, ChunkIds

END = 2
FRAME_IDS = 32_768
LARGEST = 4_194_304
FILE_IDS = 33_554_432
KNOWN_PARTS = 500_000  # parts of texts whose ids a worker remembers
_READY: dict[str, ChunkIds] = {}
# Fixed values of zstandard's seekable format: skippable frames, footer, flag for checksums.
INDEX_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
WITH_SUMS = 0x80
_ENTRY = np.dtype([("size", "<u4"), ("plain", "<u4"), ("sum", "<u4")])
_FOOTER = struct.Struct("<IBI")
_INDEX = struct.Struct("<BQ")

MANIFEST = "part int, nth int, file string, n_docs long, n_ids long, n_bytes long"
TOKENS = "doc_id long, start long, n_tokens long, ids binary"


def _sum(plain: bytes) -> int:
    return xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF


def open_store(url: str) -> tuple[fs.FileSystem, str]:
    """File system and path; a bare path or a file: address is a mounted folder."""
    bare = re.sub(r"^file:/+", "/", url)
    return fs.FileSystem.from_uri(bare) if "://" in bare else (fs.LocalFileSystem(), bare)


def _chunk_ids(path: str) -> ChunkIds:
    """One cache for each Python worker and vocabulary."""
    if path not in _READY:
        _READY[path] = ChunkIds(path, KNOWN_PARTS)
    return _READY[path]


class FrameWriter:
    """Writes documents to a binary stream; close() adds the index and the seek table."""

    def __init__(self, out, width: int = 4, frame_ids: int = FRAME_IDS, level: int = 1):
        self.out, self.width, self.frame_ids = out, width, frame_ids
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.held: list[bytes] = []
        self.n_held = self.n_ids = self.n_bytes = 0
        self.entries: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """One document: its ids as little-endian unsigned 32-bit numbers."""
        n = len(ids) // 4
        if self.held and self.n_held + n > self.frame_ids:
            self._flush()
        step = 4 * LARGEST
        for at in range(0, len(ids), step):
            piece = ids[at:at + step] if len(ids) > step else ids
            self.held.append(piece)
            self.n_held += len(piece) // 4
            if self.n_held > self.frame_ids:
                self._flush()
        self.doc_ids.append(doc_id)
        self.lengths.append(n)
        self.n_ids += n

    def _put(self, data: bytes, plain: bytes) -> None:
        self.out.write(data)
        self.entries.append((len(data), len(plain), _sum(plain)))
        self.n_bytes += len(data)

    def _flush(self) -> None:
        if self.held:
            ids = np.frombuffer(b"".join(self.held), "<u4")
            plain = ids.astype(f"<u{self.width}").tobytes()
            self._put(self.compressor.compress(plain), plain)
            self.held, self.n_held = [], 0

    def close(self) -> None:
        self._flush()
        known = np.array([d is not None for d in self.doc_ids], bool)
        numbers = np.array([d or 0 for d in self.doc_ids], "<i8")
        body = _INDEX.pack(self.width, len(known)) + self.compressor.compress(
            np.packbits(known).tobytes() + numbers.tobytes() + np.array(self.lengths, "<i8").tobytes())
        self._put(struct.pack("<II", INDEX_MAGIC, len(body)) + body, b"")
        table = np.array(self.entries, _ENTRY).tobytes() + _FOOTER.pack(len(self.entries), WITH_SUMS, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)
        self.n_bytes += len(table) + 8


class FrameReader:
    """Reads documents of a file by seeking; source has seek and read."""

    def __init__(self, source, size: int):
        self.source = source
        self.plain_reader = zstandard.ZstdDecompressor()
        n, flags, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != FOOTER_MAGIC or flags != WITH_SUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        length = n * _ENTRY.itemsize
        head = self._at(size - _FOOTER.size - length - 8, length + 8)
        if struct.unpack("<II", head[:8]) != (SEEK_MAGIC, length + _FOOTER.size):
            raise ValueError("the seek table has another length than it says")
        self.table = np.frombuffer(head[8:], _ENTRY)
        ends = np.cumsum(self.table["size"].astype(np.int64))
        self.offsets = ends - self.table["size"]
        self.plain_ends = np.cumsum(self.table["plain"].astype(np.int64))[:-1]
        body = self._at(int(self.offsets[-1]), int(self.table["size"][-1]))[8:]
        self.width, n_docs = _INDEX.unpack(body[:_INDEX.size])
        raw = self.plain_reader.decompress(body[_INDEX.size:])
        bits = -(-n_docs // 8)
        self.known = np.unpackbits(np.frombuffer(raw[:bits], np.uint8), count=n_docs).astype(bool)
        self.doc_ids = np.frombuffer(raw, "<i8", n_docs, bits)
        self.lengths = np.frombuffer(raw, "<i8", n_docs, bits + 8 * n_docs)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.frames_read = 0

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def frame(self, k: int) -> np.ndarray:
        """The ids of frame k, checked against its sum."""
        plain = self.plain_reader.decompress(self._at(int(self.offsets[k]), int(self.table["size"][k])))
        if len(plain) != self.table["plain"][k] or _sum(plain) != self.table["sum"][k]:
            raise ValueError(f"frame {k} does not match its checksum")
        self.frames_read += 1
        return np.frombuffer(plain, f"<u{self.width}")

    def documents(self, wanted: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(place in the file, ids) of documents in ascending places; a frame is read once and only if needed."""
        last, held = -1, None
        for at in wanted.tolist():
            first, end = int(self.starts[at]) * self.width, int(self.starts[at] + self.lengths[at]) * self.width
            parts = []
            k = int(np.searchsorted(self.plain_ends, first, side="right"))
            while first < end:
                if k != last:
                    last, held = k, self.frame(k)
                base = int(self.plain_ends[k]) - int(self.table["plain"][k])
                stop = min(end, int(self.plain_ends[k]))
                parts.append(held[(first - base) // self.width:(stop - base) // self.width])
                first, k = stop, k + 1
            ids = parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, "<u4"), *parts])
            yield at, ids.astype("<u4").tobytes()


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end: int = END, frame_ids: int = FRAME_IDS, file_ids: int = FILE_IDS) -> DataFrame:
    """Write a table of tokens under path and return its manifest, without the places of documents.

    vocabulary is the tokenizer's file on every executor. Texts are dealt out in
    ranges of (doc_id, hash of the text, row), so equal doc_ids can be split.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, part = _chunk_ids(vocabulary), TaskContext.get().partitionId()
        hold("frames", ready.clear)
        width = 2 if max(end, len(ready.ends) - 1) < 1 << 16 else 4
        store, folder = open_store(f"{path}/data")
        mark = end.to_bytes(4, "little")
        rows, writer, name = [], None, None

        def done() -> None:
            writer.close()
            writer.out.close()
            rows.append((part, len(rows), name, len(writer.lengths), writer.n_ids, writer.n_bytes))

        for batch in small_batches(batches, "text", BLOCK):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ready.of(batch.column("text").to_pylist())):
                if writer is not None and writer.n_ids >= file_ids:
                    done()
                    writer = None
                if writer is None:
                    store.create_dir(folder, recursive=True)
                    name = f"{part:06d}-{len(rows):04d}-{uuid.uuid4().hex}.zst"
                    writer = FrameWriter(store.open_output_stream(f"{folder}/{name}", compression=None), width, frame_ids)
                writer.add(doc_id, ids + mark)
        if writer is not None:
            done()
        if rows:
            types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["part", "nth", "file", "n_docs", "n_ids", "n_bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    keys = ["doc_id", "_text_hash", "_row"]
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns(
        {"_text_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    dealt = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    dealt.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files in order with `start`, the ids of all documents before each.

    Sums run over blocks of 1,024 parts, then over the blocks.
    """
    files = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").withColumn("block", F.expr("part div 1024"))

    def before(w):
        return w.rowsBetween(W.unboundedPreceding, -1)

    sums = files.groupBy("block").agg(F.sum("n_ids").alias("sum"))
    bases = sums.select("block", F.coalesce(F.sum("sum").over(before(W.orderBy("block"))), F.lit(0)).alias("base"))
    own = F.coalesce(F.sum("n_ids").over(before(W.partitionBy("block").orderBy("part", "nth"))), F.lit(0))
    return files.withColumn("own", own).join(bases, "block").select(
        "part", "nth", "file", "n_docs", "n_ids", "n_bytes", (F.col("base") + F.col("own")).alias("start"))


def _open(path: str, name: str) -> FrameReader:
    store, folder = open_store(f"{path}/data")
    source = store.open_input_file(f"{folder}/{name}")
    return FrameReader(source, source.size())


def _batches(rows: Iterator[tuple], types: list, names: list[str], most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Rows whose last value is bytes, in batches of about `most` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + 64
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


_TOKEN_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_TOKEN_NAMES = ["doc_id", "start", "n_tokens", "ids"]


def _of_file(path: str, name: str, base: int, places) -> Iterator[tuple]:
    reader = _open(path, name)
    wanted = np.arange(len(reader.lengths)) if places is None else np.unique(np.asarray(places, np.int64))
    for at, ids in reader.documents(wanted):
        yield int(reader.doc_ids[at]) if reader.known[at] else None, base + int(reader.starts[at]), int(reader.lengths[at]), ids
    reader.source.close()


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """All documents: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit numbers)."""
    files = manifest(spark, path).select("file", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for r in b.to_pylist() for row in _of_file(path, r["file"], r["start"], None))
        yield from _batches(rows, _TOKEN_TYPES, _TOKEN_NAMES)

    # A number of its own, as the planner would merge these few short rows into one task.
    return files.repartition(max(1, files.count())).mapInArrow(read, TOKENS)


def directory(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, file, base, place of every document, from the indexes alone; no frame is read."""
    files = manifest(spark, path).select("file", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                reader = _open(path, r["file"])
                n = len(reader.lengths)
                reader.source.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.doc_ids, mask=~reader.known), pa.array([r["file"]] * n), pa.array(np.full(n, r["start"])), pa.array(np.arange(n))],
                    names=["doc_id", "file", "base", "place"])

    return files.repartition(max(1, files.count())).mapInArrow(read, "doc_id long, file string, base long, place long")


def fetch_tokens(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The documents whose doc_id is in wanted (doc_id), each once; only their frames are decompressed."""
    asked = directory(spark, path).join(wanted.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                names, places = np.asarray(batch.column("file").to_pylist()), np.asarray(batch.column("place"))
                bases = np.asarray(batch.column("base"))
                cuts = np.flatnonzero(names[1:] != names[:-1]) + 1
                for a, b in zip([0, *cuts], [*cuts, len(names)]):
                    yield from _of_file(path, str(names[a]), int(bases[a]), places[a:b])

        yield from _batches(rows(), _TOKEN_TYPES, _TOKEN_NAMES)

    n_files = max(1, manifest(spark, path).count())
    return asked.repartition(n_files, "file").sortWithinPartitions("file", "place").mapInArrow(read, TOKENS)
