"""Token ids in compressed shard files: one zstandard frame per document, all with one shared dictionary.

A folder holds ``dictionary`` and shard files in ascending id order. A shard file is

    8 bytes  magic, 32 bytes  SHA-256 of the dictionary, 8 bytes  bytes per id (2 or 4)
    frames, one per document: its ids little-endian, compressed by themselves
    index, five arrays: id known (u1), doc_id (i8), frame offset (u8), frame size (u8), ids (u8)
    8 bytes  index offset, 8 bytes  documents, 8 bytes  magic

so one document is read by its index entry and its frame alone. The dictionary is trained on a bounded
sample (the ``SAMPLE_TEXTS`` texts of smallest hash, of at most ``SAMPLE_BYTES`` each).
Files are written under another name and moved when whole, so a task that runs again does no harm.

Defined results: null texts are empty and have the end id only. Null ids come first. Repeated ids and
rows are kept, in an order that is fixed once the ids are encoded. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow.fs import FileSelector, FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, stored, table
from tidemark.llm.registry import query
from tidemark.llm.tokens import encoder
from tidemark.session import work_folder

MAGIC = b"ZIDS0001"
DICTIONARY_BYTES = 32 << 10
SAMPLE_TEXTS = 600
SAMPLE_BYTES = 1 << 16
SHARD_ROWS = 20_000
LEVEL = 3
TOKENIZER = "byte_bpe_50k.json"
END = 0
_INDEX = (("known", "u1"), ("doc_id", "<i8"), ("offset", "<u8"), ("size", "<u8"), ("count", "<u8"))


def open_folder(folder: str) -> tuple[FileSystem, str]:
    """The file system of a folder that all executors share, and the folder's path in it."""
    system, path = FileSystem.from_uri(folder)
    return system, path.rstrip("/")


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of at most ``size`` bytes; empty if the samples do not suffice."""
    if len(samples) < 10:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def packed(ids: bytes, width: int) -> bytes:
    """32-bit ids in the width of the files."""
    return np.frombuffer(ids, "<u4").astype("<u2").tobytes() if width == 2 else ids


def write_shard(system: FileSystem, path: str, name: str, raw: bytes, width: int, rows: Iterator[tuple]) -> tuple[int, int]:
    """Write (doc_id, n_tokens, frame) rows as one file; returns documents and ids."""
    index: dict[str, list] = {n: [] for n, _ in _INDEX}
    part = f"{path}/.{name}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
    with system.open_output_stream(part) as out:
        out.write(MAGIC + hashlib.sha256(raw).digest() + struct.pack("<Q", width))
        at = 48
        for doc_id, count, frame in rows:
            for field, value in zip(index.values(), (doc_id is not None, doc_id or 0, at, len(frame), count), strict=True):
                field.append(value)
            out.write(frame)
            at += len(frame)
        for field, kind in _INDEX:
            out.write(np.array(index[field], kind).tobytes())
        out.write(struct.pack("<QQ", at, len(index["count"])) + MAGIC)
    system.move(part, f"{path}/{name}")
    return len(index["count"]), sum(index["count"])


class Shard:
    """A shard file: its index, and single documents by position."""

    def __init__(self, system: FileSystem, path: str, raw: bytes) -> None:
        self.file = system.open_input_file(path)
        size = self.file.size()
        at, documents = struct.unpack("<QQ", self.file.read_at(24, size - 24)[:16])
        head = self.file.read_at(48, 0)
        if head[:8] != MAGIC or head[8:40] != hashlib.sha256(raw).digest():
            raise ValueError(f"{path} was written with another dictionary")
        self.width = struct.unpack("<Q", head[40:])[0]
        body = self.file.read_at(size - 24 - at, at)
        self.index, pos = {}, 0
        for field, kind in _INDEX:
            self.index[field] = np.frombuffer(body, kind, documents, pos)
            pos += documents * np.dtype(kind).itemsize
        self.decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))

    def ids(self, k: int, frame: bytes | None = None) -> np.ndarray:
        if frame is None:
            frame = self.file.read_at(int(self.index["size"][k]), int(self.index["offset"][k]))
        return np.frombuffer(self.decompressor.decompress(frame), f"<u{self.width}").astype("<u4")

    def all_ids(self, at_once: int = 8 << 20) -> Iterator[np.ndarray]:
        """Ids of every document in order, reading many frames at a time."""
        offset, size = self.index["offset"].astype(np.int64), self.index["size"].astype(np.int64)
        k, n = 0, len(offset)
        while k < n:
            end = max(k + 1, int(np.searchsorted(offset + size, offset[k] + at_once, "right")))
            block = self.file.read_at(int(offset[end - 1] + size[end - 1] - offset[k]), int(offset[k]))
            for i in range(k, end):
                yield self.ids(i, block[offset[i] - offset[k] : offset[i] - offset[k] + size[i]])
            k = end


def read_dictionary(folder: str) -> bytes:
    system, path = open_folder(folder)
    with system.open_input_file(f"{path}/dictionary") as file:
        return file.read()


def read_document(folder: str, doc_id: int) -> np.ndarray | None:
    """Ids of one document: looks at shard indexes and decompresses a single frame."""
    system, path = open_folder(folder)
    raw = read_dictionary(folder)
    for info in sorted(system.get_file_info(FileSelector(path)), key=lambda i: i.path):
        if info.base_name.startswith("shard-"):
            shard = Shard(system, info.path, raw)
            found = np.flatnonzero((shard.index["known"] == 1) & (shard.index["doc_id"] == doc_id))
            if len(found):
                return shard.ids(int(found[0]))
    return None


def sample(documents: DataFrame) -> list[str]:
    """At most SAMPLE_TEXTS different texts of at most SAMPLE_BYTES each: those of least hash.

    Tasks send hashes to the driver; only the texts chosen by them follow.
    """
    short = documents.where(F.octet_length("text") <= SAMPLE_BYTES).select("text", F.xxhash64("text").alias("at"))
    least = [r["at"] for r in short.select("at").distinct().orderBy("at").limit(SAMPLE_TEXTS).collect()]
    if not least:
        return []
    chosen = short.where(F.col("at") <= least[-1]).groupBy("at").agg(F.min("text").alias("text"))
    return [r["text"] for r in chosen.orderBy("at").collect()]


def encode_to_files(documents: DataFrame, folder: str, tokenizer: str = TOKENIZER, end: int = END) -> DataFrame:
    """Write the ids of all texts; returns the shards (shard, file, documents, tokens, start)."""
    spark = documents.sparkSession
    width = 2 if encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else 4
    last = np.array([end], "<u4").tobytes()

    def ids(texts):
        return [x + last for x in encoder(tokenizer).encode(texts)]

    raw = train_dictionary([packed(x, width) for x in ids(sample(documents))])
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/dictionary") as out:
        out.write(raw)

    def frames(doc_ids, texts):
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw), write_checksum=False)
        found = ids(texts)
        return {
            "doc_id": doc_ids,
            "n_tokens": [len(x) // 4 for x in found],
            "frame": [compressor.compress(packed(x, width)) for x in found],
        }

    encoded = map_rows(documents, frames, "doc_id long, n_tokens long, frame binary", "doc_id", "text")
    encoded = stored(encoded.withColumn("row", F.monotonically_increasing_id()), "token-frames")
    shards = max(1, -(-encoded.count() // SHARD_ROWS))

    def write(parts):
        number = TaskContext.get().partitionId()
        rows = (
            row
            for part in parts
            for row in zip(*(part.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame")), strict=True)
        )
        first = next(rows, None)
        if first is None:
            return
        name = f"shard-{number:08d}"
        system, path = open_folder(folder)
        documents, tokens = write_shard(system, path, name, raw, width, _with(first, rows))
        yield pa.RecordBatch.from_pydict({"shard": [number], "file": [name], "documents": [documents], "tokens": [tokens]})

    order = [F.asc_nulls_first("doc_id"), F.asc("row")]
    ranged = encoded.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    written = stored(
        ranged.select("doc_id", "n_tokens", "frame").mapInArrow(write, "shard long, file string, documents long, tokens long"),
        "token-shards",
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _with(first, rows):
    yield first
    yield from rows


def read_files(shards: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and CRC-32 of the ids of every document, read from the files."""
    raw = read_dictionary(folder)

    def read(parts):
        system, path = open_folder(folder)
        for part in parts:
            for name, start in zip(part.column("file").to_pylist(), part.column("start").to_pylist(), strict=True):
                shard = Shard(system, f"{path}/{name}", raw)
                index = shard.index
                got = [(len(x), zlib.crc32(x.tobytes())) for x in shard.all_ids()]
                counts = np.array([g[0] for g in got], np.int64)
                if not np.array_equal(counts, index["count"].astype(np.int64)):
                    raise ValueError(f"{name}: ids and index differ")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(index["doc_id"], mask=index["known"] == 0),
                        pa.array(start + np.cumsum(counts) - counts),
                        pa.array(counts),
                        pa.array([g[1] for g in got], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = shards.select("shard", "file", "start").repartitionByRange(max(1, shards.count()), "shard")
    return spread.select("file", "start").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query()
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "token-files")
    shards = encode_to_files(table(spark, sf_dir, "documents"), folder)
    return read_files(shards, folder)
