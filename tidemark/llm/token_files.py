"""Token-ID files: one concatenated id array per shard, its document boundaries in Elias-Fano code.

A shard holds consecutive documents in ascending identifier order:

    8 bytes  magic "TMIDS001"
    8 x u64  bytes per id, documents, ids, documents without identifier, least identifier,
             bytes of the boundary code, bytes of the identifier code, crc32 of both codes
    boundary code, identifier code (both Elias-Fano), then the ids, little-endian

Elias-Fano keeps the low bits of n ascending values side by side and the high parts in unary: about
2 + log2(range / n) bits a value. Sampled select positions (one 32-bit word for 256 values) lead to any
offset without a table of 64-bit offsets.

Files are written under a temporary name and renamed, so a task that runs again replaces its own shard.
Defined cases: a null text is empty and holds its end id only. Null identifiers come first. Repeated
identifiers keep a row each. An empty table writes no shard and reads back no rows. Other columns are
not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SMALL_BATCH_BYTES, batches_with, giving_back, materialize, scratch_path
from .tokens import ByteBpe, default_path, groups_by_size

MAGIC = b"TMIDS001"
_HEAD = struct.Struct("<8Q")
SAMPLE = 256
#: Characters that are cut and encoded at once: a worker holds their chunks beside those that it keeps.
ENCODE_CHARS = 500_000


class EliasFano:
    """Ascending non-negative integers in near-minimal space, with select."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        place = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        ones = np.zeros(int(place[-1]) + 1 if n else 0, bool)
        ones[place] = True
        lows = ((v[:, None] >> np.arange(bits, dtype=np.uint64)[None, :]) & np.uint64(1)).astype(bool).reshape(-1)
        return cls(n, bits, np.packbits(lows, bitorder="little"), np.packbits(ones, bitorder="little"), place[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return struct.pack("<4Q", self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, b: bytes) -> EliasFano:
        n, bits, a, c = struct.unpack_from("<4Q", b)
        raw = np.frombuffer(b, np.uint8, offset=32)
        return cls(n, bits, raw[:a], raw[a : a + c], np.frombuffer(b, "<u4", offset=32 + a + c))

    def select(self, i: int) -> int:
        """The i-th value: from its sample, count ones in the high part, then add its low bits."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        cur = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (k := cur.bit_count()) <= left:
            left -= k
            byte += 1
            cur = int(self.high[byte])
        for _ in range(left):
            cur &= cur - 1
        high = byte * 8 + (cur & -cur).bit_length() - 1 - i
        first, low = i * self.low_bits, 0
        if self.low_bits:
            window = int.from_bytes(self.low[first >> 3 : (first + self.low_bits + 7) >> 3].tobytes(), "little")
            low = (window >> (first & 7)) & ((1 << self.low_bits) - 1)
        return (high << self.low_bits) | low

    def all(self) -> np.ndarray:
        if not self.n:
            return np.empty(0, np.int64)
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        if not self.low_bits:
            return high
        lows = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
        low = lows.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return (high << self.low_bits) | low


def encode_shard(doc_ids: list[int | None], counts: np.ndarray, ids: bytes, width: int) -> bytes:
    """doc_ids ascending, nulls first; counts: ids of each document; ids: all of them, width bytes each."""
    ends = np.cumsum(counts)
    known = np.array([i for i in doc_ids if i is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    bounds = EliasFano.build(ends).to_bytes()
    names = EliasFano.build((known - least).astype(np.uint64)).to_bytes()
    head = _HEAD.pack(width, len(doc_ids), len(ids) // width, len(doc_ids) - len(known), least & (2**64 - 1), len(bounds), len(names), zlib.crc32(names, zlib.crc32(bounds)))
    return MAGIC + head + bounds + names + ids


class Shard:
    """An opened shard: document number -> identifier, offsets and ids."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token-id shard")
        self.width, self.n_docs, self.n_ids, self.n_null, least, a, b, crc = _HEAD.unpack_from(data, 8)
        self.least = least - (1 << 64) if least >= 1 << 63 else least
        at = 8 + _HEAD.size
        bounds, names = data[at : at + a], data[at + a : at + a + b]
        if zlib.crc32(names, zlib.crc32(bounds)) != crc:
            raise ValueError("damaged shard")
        self.ends, self.names = EliasFano.from_bytes(bounds), EliasFano.from_bytes(names)
        self.ids = np.frombuffer(data, f"<u{self.width}", count=self.n_ids, offset=at + a + b)

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.names.select(i - self.n_null) + self.least

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + (self.names.all() + self.least).tolist()


def write_bytes(path: str, data: bytes) -> None:
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    tmp = f"{at}.{uuid.uuid4().hex}.tmp"
    store.create_dir(at.rpartition("/")[0], recursive=True)
    with store.open_output_stream(tmp) as f:
        f.write(data)
    store.move(tmp, at)


def read_bytes(path: str) -> bytes:
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    with store.open_input_stream(at) as f:
        return f.read()


def as_uri(spark: SparkSession, path: str) -> str:
    """The path as Spark itself would read it: without a scheme it is one of the default file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().replace("file:/", "file:///", 1).replace("file://///", "file:///", 1)


def write_token_files(docs: DataFrame, out: str, end_id: int = 2, vocab_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = 16_000_000, width: int = 2) -> DataFrame:
    """Write the shards under out; returns their manifest (path, part, shard, n_docs, n_ids), already complete.

    width: bytes per id; two suffice for vocabularies of up to 65,536 ids. A shard closes at shard_ids ids.
    """
    vocab, root = vocab_path or default_path("byte_bpe_50k.json"), as_uri(docs.sparkSession, out)

    @giving_back
    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.shared(vocab, f"<u{width}")
        end = np.array([end_id], f"<u{width}").tobytes()
        part, shard = TaskContext.get().partitionId(), 0
        names, counts, blobs, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            path = f"{root}/part-{part:06d}-{shard:04d}.ids"
            write_bytes(path, encode_shard(names, np.array(counts, np.int64), b"".join(blobs), width))
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(names)], pa.int64()), pa.array([size], pa.int64())], ["path", "part", "shard", "n_docs", "n_ids"])

        for ids, texts in batches_with(["doc_id", "text"], it):
            for lo, hi in groups_by_size(texts, ENCODE_CHARS):
                for i, b in zip(ids[lo:hi], bpe.encode(texts[lo:hi])):
                    n = len(b) // width + 1
                    if size and size + n > shard_ids:
                        yield close()
                        shard += 1
                        names, counts, blobs, size = [], [], [], 0
                    names.append(i)
                    counts.append(n)
                    blobs += (b, end)
                    size += n
        if names:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    return materialize(ordered.mapInArrow(write, "path string, part int, shard int, n_docs long, n_ids long"), "token-manifest", SMALL_BATCH_BYTES)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    earlier = F.coalesce(F.sum("n_ids").over(Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    based = manifest.select("path", earlier.alias("base"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    @giving_back
    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths, bases in batches_with(["path", "base"], it):
            for path, base in zip(paths, bases):
                s = Shard(read_bytes(path))
                for first in range(0, s.n_docs, 10_000):
                    own = range(first, min(s.n_docs, first + 10_000))
                    # each document by its select structures, as a reader of single documents would find it
                    spans = [s.span(i) for i in own]
                    crcs = [zlib.crc32(s.ids[a:b].astype("<u4").tobytes()) for a, b in spans]
                    cols = [[s.doc_id(i) for i in own], [base + a for a, _ in spans], [b - a for a, b in spans], crcs]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return based.repartition(parts, "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files_round_trip(docs: DataFrame, **options) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    return read_token_files(write_token_files(docs, scratch_path(spark, "token-files"), **options))
