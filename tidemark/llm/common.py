"""Helpers that the operators share: table reading, scratch tables, word hashing, components."""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .wordscan import mix64, window_hashes  # noqa: F401  # used by the operators

WHITE = r"[\x20\x09-\x0D]"
_SPLIT = re.compile(r"[\x20\x09-\x0D]+")
_ODD_WHITE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_own_root = ""
#: Entries a worker keeps in a word cache before it starts anew; bounds memory, never results.
CACHE_ENTRIES = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table. createDataFrame makes an RDD of Python's for it, for which every executor starts a daemon and workers of their own."""
    return spark.range(0).select(F.from_json(F.lit(None).cast("string"), schema).alias("row")).select("row.*")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a folder of our own only where it is unset (tests)."""
    global _own_root
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_root
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = _own_root = tempfile.mkdtemp(prefix="tidemark-")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: While a table is written: its shuffle files go as soon as it stands, and Python gets Arrow batches of bounded bytes.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Bytes of a batch; fewer for work that takes whole texts apart and needs many times a batch's bytes.
BATCH_BYTES, SMALL_BATCH_BYTES = 8 << 20, 2 << 20


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_table(df: DataFrame, path: str, *partitions: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Write df to a folder that all executors share and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    with settings(spark, _WRITING | {"spark.sql.execution.arrow.maxBytesPerBatch": str(batch_bytes)}):
        df.write.partitionBy(*partitions).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """A scratch table that nobody deletes but the owner of the shared folder: for what a returned DataFrame reads."""
    return write_table(df, scratch_path(df.sparkSession, name), batch_bytes=batch_bytes)


class Scratch:
    """The scratch tables of one run of one operator: deleted when it is done with them, at the latest at its end.

    A table made with keep=True is read by the operator's result and stays. No run touches another's tables.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[str, list[str]] = {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        self.drop(*list(self._paths))

    def table(self, df: DataFrame, name: str, keep: bool = False, batch_bytes: int = BATCH_BYTES) -> DataFrame:
        path = scratch_path(self.spark, name)
        if not keep:
            self._paths.setdefault(name, []).append(path)
        return write_table(df, path, batch_bytes=batch_bytes)

    def drop(self, *names: str, but_last: bool = False) -> None:
        """Delete the tables made under these names (but the last one of each), which nothing reads any more."""
        for name in names:
            paths = self._paths.pop(name, [])
            if but_last:
                paths, self._paths[name] = paths[:-1], paths[-1:]
            for path in paths:
                remove_path(self.spark, path)


def words_of(text: str | None) -> list[str]:
    """Maximal runs of characters outside [\\x20\\x09-\\x0D]."""
    if not text:
        return []
    if _ODD_WHITE.search(text):
        return [w for w in _SPLIT.split(text) if w]
    return text.split()


class WordHashes(dict):
    """word -> signed 64-bit hash, computed once for each distinct word seen by a worker."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        h = h - (1 << 64) if h >= 1 << 63 else h
        self[word] = h
        return h

    def array(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words)).view(np.uint64)


def sequence_key(h: np.ndarray) -> bytes:
    """128-bit digest of a whole word sequence or set."""
    return xxhash.xxh3_128_digest(h.tobytes())


def batches_with(columns: list[str], it: Iterator) -> Iterator[tuple]:
    """Python lists of the named columns of each Arrow batch."""
    for batch in it:
        yield tuple(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns)


def give_back() -> None:
    """Return to the system what this worker has freed; its allocators would hold on to it."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # other C libraries
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """Work on Arrow batches that leaves its worker small: one that waits beside the JVM's stages keeps its memory else."""

    @functools.wraps(work)
    def run(it: Iterator) -> Iterator:
        try:
            yield from work(it)
        finally:
            give_back()

    return run


@giving_back
def _union_find(it: Iterator) -> Iterator:
    """A forest of the edges that a task gets: each of their vertices tied to the smallest that it reaches by them."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.setdefault(x, x)) != x:
            root[x] = root[y]
            x = root[x]
        return x

    for us, vs in batches_with(["u", "v"], it):
        for u, v in zip(us, vs):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
    ids = [x for x in root if find(x) != x]
    for i in range(0, len(ids), 100_000):
        own = ids[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([find(x) for x in own], pa.int64())], ["u", "v"])


def connected_components(edges: DataFrame, max_rounds: int = 60, into: Scratch | None = None) -> DataFrame:
    """(a long, b long) -> (id, component): the smallest id reachable, for every id in an edge.

    Each partition first thins its own edges to a forest, which for a graph of one partition is the answer.
    Then large-star and small-star alternate; a round is a pair of grouped minima, written to the shared
    folder. A vertex of high degree meets partial aggregation, never one collected group.
    Nulls on either end and self-loops are ignored; repeated edges count once. The result is a table of
    `into` where that is given, else one that stays.
    """
    with Scratch(edges.sparkSession) as scratch:
        cur = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
        cur = scratch.table(cur.hint("rebalance").mapInArrow(_union_find, "u long, v long").distinct(), "cc")
        for _ in range(max_rounds):
            # stars only: no vertex has two parents and no parent is itself a child
            ends = cur.select("u", F.lit(1).alias("child"), F.lit(0).alias("parent")).union(cur.select("v", F.lit(0), F.lit(1)))
            if ends.groupBy("u").agg(F.sum("child").alias("c"), F.max("parent").alias("p")).where("c > 1 OR c + p > 1").isEmpty():
                break
            # large star: each vertex ties its larger neighbours to its smallest neighbour
            both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
            large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            # small star: each vertex ties its smaller neighbours, and itself, to the smallest of them
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = (
                large.join(low, "u")
                .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                .select("e.u", "e.v")
                .where("u <> v")
                .distinct()
            )
            cur = scratch.table(small, "cc")
            scratch.drop("cc", but_last=True)
        else:
            raise RuntimeError("components did not converge")
        found = cur.select(F.col("u").alias("id"), F.col("v").alias("component")).union(cur.select(F.col("v"), F.col("v")).distinct())
        return into.table(found, "components") if into else materialize(found, "components")


#: Bytes of a written, compressed table up to which it may be broadcast (sorted identifiers take a byte or two each there and
#: some fifty in a hash table, so about 100 MB); beyond them the shuffled, skew-split join is used.
BROADCAST_BYTES = 2 << 20


def small_side(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A scratch table, or rows chosen from one, hinted: broadcast if its statistics prove it small, else hash tables by key.

    In neither case is the other side, which may hold texts, sorted.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= most else df.hint("shuffle_hash")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like those wanted that no column of df has, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
