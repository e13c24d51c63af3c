"""BPE by a distinct-word table: split, encode each distinct word once, join ids back by position; decode by pieces.

Texts are split at white space, where the tokenizer always cuts. A block of documents keeps its distinct
words, frequent ones first, and, for each document, their places in that list. The blocks' words are dealt
out by hash into buckets; a bucket's task sees each of its words from all blocks and encodes every distinct
one once. Ids return to their block, ahead of its documents, and are joined to these by position. Decoding
joins ids with the id-to-piece table (as many rows as the vocabulary, so it is a broadcast, map-side join)
and concatenates. Rows of the word table travel packed, a bucket's words of a block in one row: a row each
would move more than the texts themselves. A block's documents come in parts of bounded words, and a worker
holds words' ids and pieces as arrays, so no row is large and no word costs an object once it is encoded.

A word that every block holds comes to its bucket once for each block, never once for each occurrence.
Defined cases: a null or blank text has no ids and decodes to the empty string. Null and repeated
identifiers keep a row each. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_with, giving_back, materialize, remove_path, scratch_path, words_of, write_table
from .tokens import default_path

#: Characters after which a block closes.
BLOCK_CHARS = 40_000_000
#: Words after which a part of a block's documents closes, and words that are spelled out at once.
PART_WORDS, SPAN_WORDS = 1_000_000, 50_000
#: Words that a worker encodes at once.
_AT_ONCE = 50_000


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class _Places(dict):
    """word -> its place in the block's list."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _packed(values: np.ndarray, zip_: zstandard.ZstdCompressor) -> bytes:
    """Non-negative integers below 2**32, one plane of bytes after another, zstd: frequent small ones take few bits."""
    return zip_.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(blob: bytes, unzip: zstandard.ZstdDecompressor) -> np.ndarray:
    planes = np.frombuffer(unzip.decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _stretches(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of flat, one after another: those that begin at start and are size long."""
    ends = np.cumsum(size)
    return flat[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def split_blocks(docs: DataFrame, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """(block, bucket, words, ids, counts, places, dealt): a row per bucket with its words, and one (bucket -1, -2, ...) per part of the documents.

    words: the bucket's words of the block, frequent ones first, joined by a blank, zstd; places: for each
    document the places of its words among all the block's words by falling frequency; dealt: the bucket of
    each of these, in the first part.
    """

    @giving_back
    def split(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        zip_ = zstandard.ZstdCompressor(level=3)
        schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("places", pa.binary()), ("dealt", pa.binary())])

        def rows_of(*rows: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        def close() -> Iterator[pa.RecordBatch]:
            use = np.zeros(len(places), np.int64)
            for c in codes:
                np.add.at(use, c, 1)
            words = np.array(list(places), object)
            places.clear()
            by_use = np.argsort(-use, kind="stable")
            words = words[by_use]
            rank = np.empty(len(words), np.uint32)
            rank[by_use] = np.arange(len(words))
            bucket = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) % buckets for w in words), np.int64, len(words))
            block = (part << 24) | seq
            order = np.argsort(bucket, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
                yield rows_of((block, int(bucket[own[0]]), zip_.compress(" ".join(words[own].tolist()).encode("utf-8", "surrogatepass")), None, None, None, None))
            del words
            ends = np.cumsum(counts)
            first, a = 0, 0
            while a < len(names):
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PART_WORDS, side="right")))
                first -= 1
                own = _packed(rank[np.concatenate(codes[a:b])], zip_)
                codes[a:b] = [None] * (b - a)
                yield rows_of((block, first, None, names[a:b], counts[a:b], own, _packed(bucket, zip_) if first == -1 else None))
                a = b

        places, codes, names, counts, size = _Places(), [], [], [], 0
        for ids, texts in batches_with(["doc_id", "text"], it):
            for i, t in zip(ids, texts):
                if size >= BLOCK_CHARS:
                    yield from close()
                    seq += 1
                    places, codes, names, counts, size = _Places(), [], [], [], 0
                w = words_of(t)
                codes.append(np.fromiter(map(places.__getitem__, w), np.int32, len(w)))
                names.append(i)
                counts.append(len(w))
                size += len(t or "") + 64
        if names:
            yield from close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(split, "block long, bucket int, words binary, ids array<long>, counts array<int>, places binary, dealt binary")


def encode_words(blocks: DataFrame, buckets: int, vocab_path: str) -> DataFrame:
    """(block, bucket, sizes, ids): the ids of each bucket's words; a distinct word is encoded once for all blocks.

    sizes: ids of each word; ids: little-endian uint16, or uint32 for a vocabulary beyond its range; both zstd.
    """

    @giving_back
    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(vocab_path)
        wide = tok.get_vocab_size() > 1 << 16
        zip_, unzip = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        table: dict[str, list[int]] = {}
        bucket = None
        for blks, bkts, blobs in batches_with(["block", "bucket", "words"], it):
            for b, k, blob in zip(blks, bkts, blobs):
                if k != bucket:
                    bucket, table = k, {}
                words = unzip.decompress(blob).decode("utf-8", "surrogatepass").split(" ")
                new = [w for w in words if w not in table]
                for i in range(0, len(new), _AT_ONCE):
                    cut = new[i : i + _AT_ONCE]
                    for w, e in zip(cut, tok.encode_batch_fast(cut, add_special_tokens=False)):
                        table[w] = np.array(e.ids, "<u4" if wide else "<u2").tobytes()
                got = [table[w] for w in words]
                sizes = np.fromiter(map(len, got), np.int32, len(got)) // (4 if wide else 2)
                yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([k], pa.int32()), pa.array([_packed(sizes, zip_)]), pa.array([zip_.compress(b"".join(got))])], ["block", "bucket", "sizes", "ids"])

    own = blocks.where("bucket >= 0").select("block", "bucket", "words")
    return own.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(encode, "block long, bucket int, sizes binary, ids binary")


def piece_table(vocab_path: str) -> list[str]:
    tok = load_tokenizer(vocab_path)
    return [tok.id_to_token(i) or "" for i in range(tok.get_vocab_size())]


def encode_decode(docs: DataFrame, vocab_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None, with_values: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded on demand)."""
    spark = docs.sparkSession
    path = vocab_path or default_path("word_bpe_49k.json")
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = split_blocks(docs, buckets, id_col, text_col).withColumn("kind", F.expr("if(bucket < 0, 'texts', 'words')"))
    at = scratch_path(spark, "bpe-blocks")
    coded = materialize(encode_words(write_table(blocks, at, "kind").where("kind = 'words'"), buckets, path), "bpe-coded")
    remove_path(spark, f"{at}/kind=words")
    blocks = spark.read.schema(blocks.schema).parquet(at).where("kind = 'texts'")
    # of each block the ids of its words first, then the parts of its documents
    texts = blocks.select("block", (F.lit(buckets - 1) - F.col("bucket")).alias("slot"), F.lit(None).cast("binary").alias("sizes"), F.lit(None).cast("binary").alias("word_ids"), "ids", "counts", "places", "dealt")
    coded = coded.select("block", F.col("bucket").alias("slot"), "sizes", F.col("ids").alias("word_ids"), *(F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in ("ids", "counts", "places", "dealt")))
    joined = coded.union(texts).repartition("block").sortWithinPartitions("block", "slot")
    pieces = spark.sparkContext.broadcast(piece_table(path))
    wide = len(pieces.value) > 1 << 16
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_values

    @giving_back
    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        # the library puts a blank between pieces where its file names no decoder
        spelled = [(x + " ").encode("utf-8") for x in pieces.value]
        piece, piece_size = np.frombuffer(b"".join(spelled), np.uint8), np.fromiter(map(len, spelled), np.int64, len(spelled))
        piece_at = np.cumsum(piece_size) - piece_size
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
        fields = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]

        def row(i: int | None, own: np.ndarray) -> tuple:
            """One document's row; own: the places of its words."""
            ids_sha, text_sha, n, last, kept = hashlib.sha256(), hashlib.sha256(), 0, b"", []
            for a in range(0, len(own), SPAN_WORDS):
                cut = own[a : a + SPAN_WORDS]
                ids = _stretches(flat, start[cut], size[cut])
                if not len(ids):
                    continue
                ids_sha.update(ids.astype("<u4").tobytes())
                text_sha.update(last)
                last = _stretches(piece, piece_at[ids], piece_size[ids]).tobytes()
                n += len(ids)
                if with_values:
                    kept.append((ids, last))
            # no blank behind the last piece
            text_sha.update(last[:-1])
            out = (i, n, ids_sha.hexdigest(), text_sha.hexdigest())
            if not with_values:
                return out
            return (*out, np.concatenate([np.empty(0, np.int32), *(x.astype(np.int32) for x, _ in kept)]), b"".join(x for _, x in kept)[:-1].decode("utf-8"))

        block, sizes, coded = None, [], []
        flat = start = size = np.empty(0, np.int64)
        for batch in it:
            col = {c: batch.column(batch.schema.get_field_index(c)) for c in ("block", "slot", "sizes", "word_ids", "ids", "counts", "places", "dealt")}
            for j in range(batch.num_rows):
                at = lambda c: col[c][j].as_py()  # noqa: B023, E731
                if at("block") != block:
                    block, sizes, coded = at("block"), [], []
                if at("slot") < buckets:
                    sizes.append(_unpacked(at("sizes"), unzip))
                    coded.append(np.frombuffer(unzip.decompress(at("word_ids")), "<u4" if wide else "<u2"))
                    continue
                if at("slot") == buckets:
                    # bucket after bucket, back to the order by frequency
                    order = np.argsort(_unpacked(at("dealt"), unzip), kind="stable")
                    own = np.concatenate([np.empty(0, np.int64), *sizes])
                    if len(own) != len(order):
                        raise RuntimeError(f"block {block} has {len(order)} words, of which {len(own)} came back")
                    flat = np.concatenate([np.empty(0, "<u4" if wide else "<u2"), *coded])
                    size, start = np.empty(len(own), np.int64), np.empty(len(own), np.int64)
                    size[order], start[order] = own, np.cumsum(own) - own
                    sizes, coded = [], []
                places = _unpacked(at("places"), unzip)
                ends = np.cumsum(at("counts")).tolist()
                rows = [row(i, places[b:e]) for i, b, e in zip(at("ids"), [0, *ends], ends)]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], fields[: len(cols)])

    return joined.mapInArrow(place, schema)
