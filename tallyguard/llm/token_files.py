"""Token ids in binary files: bit-plane shuffled blocks, each plane compressed, with a chunk index.

A file holds the ids of a run of documents, in ascending id order over all files:

    magic | chunk ... chunk | footer | footer's length (8 bytes) | magic

A chunk is ``BLOCK`` ids (the last one fewer), transposed into planes: plane k holds byte
k (or bit k) of every id. Each plane is one zstandard frame; a plane of zeros is left
out. The footer is a zstandard frame of JSON with the chunk index (place, ids and the
bytes of each plane of every chunk) and the places of the two document columns, ids
and lengths, which are stored as byte planes too. One chunk is in memory at a time,
writing or reading. All numbers are little-endian.

Tasks write files of their own under a fresh name and report them; only reported files
belong to the data set, so a task that is run again leaves a file that no one names.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyguard.llm.common import stage, whole_text
from tallyguard.llm.encoders import encoder
from tallyguard.session import qualified, scratch_dir

MAGIC = b"TGPLANE1"
BLOCK = 1 << 16  # ids
LEVEL = 3
DOCUMENTS = 4096  # rows of the document columns in a block


SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs",
           "abfss": "abfss"}  # as Hadoop names them, and as pyarrow does


def _uri(path: str) -> str:
    """The path for pyarrow. It must name its file system: without a scheme each machine would take its own disk."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme not in SCHEMES:
        raise ValueError(f"token files need a folder in one of {sorted(SCHEMES)}, not {path}")
    return f"{SCHEMES[scheme]}:{'//' if scheme == 'file' and not rest.startswith('//') else ''}{rest}"


def _open(path: str):
    """File system and plain path of a folder or file that all executors share."""
    return pa.fs.FileSystem.from_uri(_uri(path))


def planes(values: np.ndarray, bits: bool) -> list[bytes]:
    """The byte or bit planes of unsigned integers; a plane of zeros is empty."""
    width = values.dtype.itemsize
    if bits:
        # the bytes of each integer from the highest, then all their bits, from the highest
        table = np.unpackbits(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width)[:, ::-1]), axis=1)
        rows = [np.packbits(table[:, 8 * width - 1 - k]) for k in range(8 * width)]
    else:
        rows = [np.ascontiguousarray(x) for x in values.view(np.uint8).reshape(-1, width).T]
    return [x.tobytes() if x.any() else b"" for x in rows]


def unplanes(stored: list[bytes], n: int, dtype: np.dtype, bits: bool) -> np.ndarray:
    """The integers whose planes these are."""
    width = dtype.itemsize
    if bits:
        table = np.zeros((n, 8 * width), np.uint8)
        for k, plane in enumerate(stored):
            if plane:
                table[:, 8 * width - 1 - k] = np.unpackbits(np.frombuffer(plane, np.uint8), count=n)
        return np.ascontiguousarray(np.packbits(table, axis=1)[:, ::-1]).view(dtype).ravel()
    table = np.zeros((n, width), np.uint8)
    for k, plane in enumerate(stored):
        if plane:
            table[:, k] = np.frombuffer(plane, np.uint8)
    return table.view(dtype).ravel()


class Writer:
    """Writes one file; ``add`` documents in order, then ``close``."""

    def __init__(self, sink, bits: bool = False, block: int = BLOCK):
        self.sink, self.bits, self.block = sink, bits, block
        self.press = zstandard.ZstdCompressor(level=LEVEL)
        self.at, self.ids, self.held = len(MAGIC), [], 0
        self.index: dict[str, list] = {"chunks": [], "doc_id": [], "length": [], "null": []}
        self.docs: list[tuple[int | None, int]] = []
        self.n_docs = self.n_ids = 0
        sink.write(MAGIC)

    def _put(self, kind: str, values: np.ndarray, bits: bool) -> None:
        frames = [self.press.compress(p) if p else b"" for p in planes(values, bits)]
        self.index[kind].append([self.at, len(values), [len(f) for f in frames]])
        for f in frames:
            self.sink.write(f)
            self.at += len(f)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        self.docs.append((doc_id, n))
        if len(self.docs) == DOCUMENTS:
            self._documents()
        self.n_docs, self.n_ids = self.n_docs + 1, self.n_ids + n
        self.ids.append(ids)
        self.held += n
        if self.held >= self.block:
            data = np.frombuffer(b"".join(self.ids), "<u4")
            whole = len(data) // self.block * self.block
            for i in range(0, whole, self.block):
                self._put("chunks", data[i:i + self.block], self.bits)
            self.ids, self.held = [data[whole:].tobytes()], len(data) - whole

    def _documents(self) -> None:
        if self.docs:
            self._put("doc_id", np.array([d or 0 for d, _ in self.docs], "<i8").view("<u8"), False)
            self._put("length", np.array([n for _, n in self.docs], "<u8"), False)
            self._put("null", np.array([d is None for d, _ in self.docs], "<u1"), False)
            self.docs = []

    def close(self) -> None:
        if self.held:
            self._put("chunks", np.frombuffer(b"".join(self.ids), "<u4"), self.bits)
        self._documents()
        footer = self.press.compress(json.dumps(self.index | {"bits": self.bits, "ids": self.n_ids, "docs": self.n_docs}).encode())
        self.sink.write(footer + len(footer).to_bytes(8, "little") + MAGIC)


class Reader:
    """Reads one file: its index at once, its blocks one by one."""

    def __init__(self, source):
        self.source, self.unpress = source, zstandard.ZstdDecompressor()
        size, tail = source.size(), 8 + len(MAGIC)
        end = self._bytes(size - tail, tail)
        if self._bytes(0, len(MAGIC)) != MAGIC or end[8:] != MAGIC:
            raise ValueError("not a file of token ids, or one cut short")
        n = int.from_bytes(end[:8], "little")
        self.index = json.loads(self.unpress.decompress(self._bytes(size - tail - n, n)))

    def _bytes(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _block(self, entry, dtype: str, bits: bool) -> np.ndarray:
        at, n, sizes = entry
        data, frames = self._bytes(at, sum(sizes)), []
        for size in sizes:
            frames.append(self.unpress.decompress(data[:size]) if size else b"")
            data = data[size:]
        return unplanes(frames, n, np.dtype(dtype), bits)

    def documents(self):
        """(doc_id, length) of each document in turn."""
        for a, b, c in zip(self.index["doc_id"], self.index["length"], self.index["null"]):
            found = zip(self._block(a, "<u8", False).view("<i8").tolist(), self._block(b, "<u8", False).tolist(),
                        self._block(c, "<u1", False).tolist())
            for doc_id, n, null in found:
                yield (None if null else doc_id), n

    def ids(self):
        """Each chunk's ids as bytes."""
        for entry in self.index["chunks"]:
            yield self._block(entry, "<u4", self.index["bits"]).tobytes()

    def each(self):
        """(doc_id, length, parts): a document's ids come in parts, one per chunk it touches."""
        chunks, held = self.ids(), b""
        for doc_id, n in self.documents():
            parts, want = [], 4 * n
            while want:
                if not held:
                    held = next(chunks)
                parts.append(held[:want])
                held, want = held[want:], want - len(parts[-1])
            yield doc_id, n, parts


def write_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, bits: bool = False, tasks: int | None = None,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text and write all ids below ``folder``, ascending by document id; a row per file.

    Returned: file_no (files ascend with it), path, n_docs, n_ids, start (ids in all files before).
    A null text is empty and so only its end id; null ids come first. Repeated ids are
    documents of their own, in the order of the input.
    """
    end, folder = end_id.to_bytes(4, "little"), qualified(docs.sparkSession, folder)
    _uri(folder)  # refused here rather than in a task

    def run(batches):
        writer = sink = None
        encode = encoder(tokenizer).encode
        for batch in batches:
            for part, doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if writer is None:
                    path = f"{folder}/{part:06d}-{uuid.uuid4().hex}.ids"
                    files, plain = _open(path)
                    files.create_dir(_open(folder)[1], recursive=True)
                    sink, number = files.open_output_stream(plain), part
                    writer = Writer(sink, bits)
                writer.add(doc, encode(t) + end)
        if writer:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"file_no": pa.array([number], pa.int32()), "path": [path],
                                              "n_docs": pa.array([writer.n_docs], pa.int64()),
                                              "n_ids": pa.array([writer.n_ids], pa.int64())})

    n = tasks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"),
                         F.monotonically_increasing_id().alias("row"))
    sorted_rows = source.repartitionByRange(n, "doc_id", "row").sortWithinPartitions("doc_id", "row")
    files = sorted_rows.select(F.spark_partition_id().alias("file_no"), "doc_id", "text").mapInArrow(
        run, "file_no int, path string, n_docs long, n_ids long")
    files = stage(files, "token-files")  # from here on the names of the files are fixed
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as files
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def read_documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files of ``write_files``."""
    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, plain = _open(path)
                with store.open_input_file(plain) as source:
                    out = []
                    for doc_id, n, parts in Reader(source).each():
                        crc = 0
                        for p in parts:
                            crc = zlib.crc32(p, crc)
                        out.append((doc_id, start, n, crc))
                        start += n
                        if len(out) == 10_000:
                            yield _rows(out)
                            out = []
                    yield _rows(out)

    def _rows(out):
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, files.count())
    return files.select("path", "start").repartition(n).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, bits: bool = False) -> DataFrame:
    """Write the ids of all documents to the shared folder, and read every document back."""
    spark: SparkSession = docs.sparkSession
    return read_documents(write_files(docs, tokenizer, scratch_dir(spark, "ids"), end_id, bits))
