"""Substring dedup by De Bruijn compaction of repeated k-word windows.

A k-word window is an edge from its first to its last k-1 words. Only edges that occur in two documents
matter; they are found by winnowing: each window holds the least-hash m-word gram of its grams, so a
shared window shares that gram, and grams seen in one document only are dropped before any window is
made. Documents with one word sequence are one class; only its smallest identifier is walked, the
others' windows all repeat it.

Runs of windows whose gram is shared are cut into segments at edges that their own hash picks, so that
copies of a passage are cut alike; a segment is named by a 128-bit digest of its words and of the word
behind it. Only the first occurrence of each distinct segment is taken apart into edges. The repeated
edges form a graph. Joins of each edge with its neighbours tell where it does not branch: every
occurrence goes on to one edge, all of whose occurrences come from there. Such stretches are compacted
into paths, first within blocks of a few positions, then by joins that double each block's reach until
it meets its path's head; a path holds the coordinates of its first source (document, first word,
words). An occurrence of a path's first edge is an occurrence of the path; it counts only if its words'
digest equals that of the words read again at the source coordinates.

Defined cases: null or wordless text has no words and loses none; texts with fewer words than a window
lose none. Null identifiers are passed through unchanged and are nobody's source; rows that repeat an
identifier are one document with several texts, none of which is the source of another. An empty table
gives an empty result. Other columns are not read, and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SMALL_BATCH_BYTES, Scratch, free_names, giving_back, sequence_key
from .tokens import forget
from .wordscan import Words, binary_column, list_column, mix64, sliding_least, text_slices, window_hashes, words_in


@dataclass(frozen=True)
class SubstringParams:
    #: Words in a window.
    k: int = 50
    #: An edge whose hash is a multiple of it begins a new segment.
    segment: int = 32

    @property
    def gram(self) -> int:
        """Words of the grams that winnowing picks from."""
        return max(1, min(self.k - 1, 2 * self.k // 5))


#: Positions of a source that are compacted at once, as a power of two.
_BLOCK = 5
#: Bytes of text that a worker takes apart at once: its words, grams and windows take many times as many.
_SLICE = 1 << 19


def _k64(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Words, np.ndarray, list[int]]]:
    """(first row, row behind the last, words, hashes, word_at) of the slices of a batch of (id, text, ...)."""
    for lo, hi, data, text_at in text_slices(batch.column(1), _SLICE):
        words = words_in(data, text_at)
        yield lo, hi, words, words.hashes(), words.word_at.tolist()


def _winnowed(h: np.ndarray, p: SubstringParams) -> np.ndarray:
    """Least gram hash of the window at each word of a slice; of windows that reach into the next text, nothing."""
    grams = mix64(window_hashes(h, p.gram))
    return grams[sliding_least(grams, p.k - p.gram + 1)]


def _scan(src: DataFrame, p: SubstringParams) -> DataFrame:
    """(id, n_words, key, k64, words_sha, grams): the distinct winnowed grams of each row; words_sha of all its words."""
    names = ["id", "n_words", "key", "k64", "words_sha", "grams"]

    @giving_back
    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in it:
            for lo, hi, words, h, ends in _slices(batch):
                least = _winnowed(h, p)
                plain, at = words.joined()
                plain, at = plain.tobytes(), at.tolist()
                keys, shas, grams = [], [], [np.empty(0, np.uint64)]
                for i, (a, b) in enumerate(zip(ends, ends[1:])):
                    keys.append(sequence_key(h[a:b]))
                    shas.append(hashlib.sha256(plain[at[i] : at[i + 1]]).hexdigest())
                    grams.append(np.unique(least[a : b - p.k + 1]) if b - a >= p.k else grams[0])
                sizes = np.array([len(g) for g in grams[1:]])
                cols = [batch.column(0).slice(lo, hi - lo), pa.array(words.counts()), binary_column(keys), pa.array([_k64(x) for x in keys], pa.int64()), pa.array(shas, pa.string()), list_column(np.concatenate(grams).view(np.int64), sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names)

    return src.mapInArrow(scan, "id long, n_words long, key binary, k64 long, words_sha string, grams array<long>")


def _runs(rows: DataFrame, p: SubstringParams) -> DataFrame:
    """(id, k64, start, n, seg, edges): segments of the runs of windows whose winnowed gram is in shared.

    edges: the segment's n edges, and the next one where the run goes on; seg: digest of the words of all these.
    """
    names = ["id", "k64", "start", "n", "seg", "edges"]

    @giving_back
    def runs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            shared = batch.column(2)
            for lo, hi, words, h, ends in _slices(batch):
                least, edges = _winnowed(h, p), window_hashes(h, p.k)
                plain, at = words.joined()
                plain = memoryview(plain.tobytes())
                # where each word stands among the joined words of all texts: they lie one behind another with a space between
                size = words.end - words.start
                first = np.concatenate(([0], np.cumsum(size + 1)))
                first[:-1] -= np.repeat(first[words.word_at[:-1]] - at[:-1], words.counts())
                out, flat, lens = [], [np.empty(0, np.uint64)], []
                for i, (a, b) in enumerate(zip(ends, ends[1:])):
                    if b - a < p.k:
                        continue
                    hit = np.flatnonzero(np.isin(least[a : b - p.k + 1], shared[lo + i].values.to_numpy().view(np.uint64)))
                    if not len(hit):
                        continue
                    own = edges[a + hit]
                    gap = np.diff(hit) != 1
                    cuts = np.flatnonzero(gap | (own[1:] % p.segment == 0)) + 1
                    k64 = _k64(sequence_key(h[a:b]))
                    for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(hit)]):
                        on = e < len(hit) and not gap[e - 1]
                        w0, w1 = a + int(hit[s]), a + int(hit[e - 1]) + p.k - 1 + on
                        seg = xxhash.xxh3_128_digest(plain[first[w0] : first[w1] + size[w1]])
                        out.append((ids[lo + i], k64, int(hit[s]), e - s, seg))
                        flat.append(own[s : e + on])
                        lens.append(e + on - s)
                if out:
                    cols = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()])]
                    yield pa.RecordBatch.from_arrays([*cols, list_column(np.concatenate(flat).view(np.int64), np.array(lens), pa.int64())], names)

    return rows.select("id", "text", "shared").mapInArrow(runs, "id long, k64 long, start int, n int, seg binary, edges array<long>")


def _with_texts(src: DataFrame, per_doc: DataFrame) -> DataFrame:
    """Texts of the documents that per_doc names: texts move, unsorted, to its hash tables, in one way at every size."""
    return src.join(per_doc.hint("shuffle_hash"), "id")


def _digests(src: DataFrame, ranges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, k64, start, words, digest): the digest of the words at given coordinates, read from the texts."""
    ranges = ranges.groupBy("id", "k64").agg(F.collect_set(F.struct("start", "words")).alias("ranges"))
    per_doc = scratch.table(ranges.groupBy("id").agg(F.collect_list(F.struct("k64", "ranges")).alias("texts")), "substring-wanted")
    names = ["id", "k64", "start", "words", "digest"]

    @giving_back
    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids = batch.column(0).to_pylist()
            for lo, hi, words, h, ends in _slices(batch):
                plain, at = words.joined()
                plain = plain.tobytes()
                out = []
                for i, (a, b) in enumerate(zip(ends, ends[1:])):
                    k64 = _k64(sequence_key(h[a:b]))
                    for form in batch.column(2)[lo + i].as_py():
                        if form["k64"] == k64:
                            spot = at[i] + np.concatenate(([0], np.cumsum(words.end[a:b] - words.start[a:b] + 1)))
                            for r in form["ranges"]:
                                s, n = r["start"], r["words"]
                                out.append((ids[lo + i], k64, s, n, xxhash.xxh3_128_digest(plain[spot[s] : spot[s + n] - 1])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()])], names)

    rows = _with_texts(src, per_doc).select("id", "text", "texts")
    return rows.mapInArrow(read, "id long, k64 long, start int, words int, digest binary").distinct()


def _paths(edges: DataFrame, p: SubstringParams, scratch: Scratch) -> DataFrame:
    """(edge, src_id, src_k, src_start, words): head edge and source coordinates of each nonbranching path.

    edges: (edge, src_id, src_k, src_pos, n, nxt); n: occurrences; nxt: the edge that follows all of them, or null.
    """
    # all that stands before the edge goes on to it, and all of its occurrences come from there
    back = edges.where("nxt IS NOT NULL").groupBy(F.col("nxt").alias("edge")).agg(F.max("n").alias("n_before"), F.count(F.lit(1)).alias("n_in"))
    linked = edges.join(back, "edge", "left").select("edge", "src_id", "src_k", "src_pos", F.expr("coalesce(n_in = 1 AND n_before = n, false)").alias("follows"))
    # within blocks of a few positions first
    block = [F.col("src_id"), F.col("src_k"), F.shiftright("src_pos", _BLOCK).alias("block")]
    along = Window.partitionBy("src_id", "src_k", "block").orderBy("src_pos")
    cells = linked.select("*", block[2])
    cells = cells.withColumn("head", (~(F.col("follows") & F.coalesce(F.lag("src_pos").over(along) + 1 == F.col("src_pos"), F.lit(False)))).cast("int"))
    cells = cells.withColumn("part", F.sum("head").over(along))
    pieces = cells.groupBy("src_id", "src_k", "block", "part").agg(F.min("src_pos").alias("at"), F.max("src_pos").alias("end"), F.max(F.expr("if(head = 1, edge, null)")).alias("edge"), F.max(F.expr("head = 1 AND follows")).alias("more"))
    # root: where what is known of the path in front of a piece begins; more: something goes on in front of it
    pieces = scratch.table(pieces.select("src_id", "src_k", "edge", "at", "end", F.col("at").alias("root"), "more"), "substring-pieces")
    while not pieces.where("more").isEmpty():
        front = pieces.select("src_id", "src_k", (F.col("end") + 1).alias("root"), F.col("root").alias("root2"), F.col("more").alias("more2"))
        # a piece without a front there is a head after all
        nxt = pieces.join(front, ["src_id", "src_k", "root"], "left")
        nxt = nxt.select("src_id", "src_k", "edge", "at", "end", F.expr("if(more, coalesce(root2, root), root)").alias("root"), F.expr("more AND coalesce(more2, false)").alias("more"))
        pieces = scratch.table(nxt, "substring-pieces")
        scratch.drop("substring-pieces", but_last=True)
    tails = pieces.groupBy("src_id", "src_k", F.col("root").alias("at")).agg(F.max("end").alias("last"))
    heads = pieces.where("at = root").join(tails, ["src_id", "src_k", "at"])
    return heads.select("edge", "src_id", "src_k", F.col("at").alias("src_start"), (F.col("last") - F.col("at") + p.k).cast("int").alias("words"))


def repeated_spans(docs: DataFrame, scratch: Scratch, p: SubstringParams = SubstringParams(), id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows (id, n_words, k64, words_sha, copy_of); spans (id, k64, start, words, src_id, src_k, src_start, digest).

    copy_of is a smaller identifier with the same word sequence, else null. A span is words whose windows
    all start in the document src_id, src_id < id, whose words have that digest; whoever takes a span compares
    it with the words at start. Spans are given for rows that are no copies. Both are scratch tables; only rows stays.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scanned = scratch.table(_scan(src, p), "substring-scan", batch_bytes=SMALL_BATCH_BYTES)
    named = scanned.where(f"id IS NOT NULL AND n_words >= {p.k}")
    classes = scratch.table(named.groupBy("key").agg(F.min("id").alias("rep")), "substring-classes")
    copies = scratch.table(named.select("id", "key").join(classes, "key").where("rep < id").select("id", "key", "rep").distinct(), "substring-copies")
    rows = scanned.select("id", "n_words", "key", "k64", "words_sha").join(copies.hint("shuffle_hash"), ["id", "key"], "left").select("id", "n_words", "k64", "words_sha", F.col("rep").alias("copy_of"))
    rows = scratch.table(rows, "substring-rows", keep=True)
    # copies are fewer than documents: they are taken out
    grams = named.select("id", "key", "grams").join(copies.hint("shuffle_hash"), ["id", "key"], "left_anti").select("id", F.explode("grams").alias("gram"))
    shared = scratch.table(grams.groupBy("gram").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("gram"), "substring-grams")
    mine = grams.join(shared.hint("shuffle_hash"), "gram").groupBy("id").agg(F.collect_set("gram").alias("shared"))
    mine = scratch.table(mine, "substring-mine")
    twins = not scanned.where("id IS NOT NULL").groupBy("id", "key").count().where("count > 1").isEmpty()
    scratch.drop("substring-scan", "substring-classes", "substring-grams")
    occ = _runs(_with_texts(src, mine), p)
    occ = scratch.table(occ.distinct() if twins else occ, "substring-runs", batch_bytes=SMALL_BATCH_BYTES)
    # of each segment the first occurrence; the narrow columns alone are compared
    first = occ.groupBy("seg").agg(F.min(F.struct("id", "k64", "start")).alias("s"), F.max("id").alias("last"), F.count(F.lit(1)).alias("w"))
    first = scratch.table(first.select("seg", "s.id", "s.k64", "s.start", "last", "w"), "substring-firsts")
    distinct = occ.join(first.hint("shuffle_hash"), ["seg", "id", "k64", "start"]).select("seg", "id", "k64", "start", "n", "last", "w", "edges")
    distinct = scratch.table(distinct, "substring-segments")
    scratch.drop("substring-firsts", "substring-mine")
    # their edges: who has it first, how often it stands, what follows it
    at = distinct.select("id", "k64", "start", "last", "w", "edges", F.posexplode(F.slice("edges", F.lit(1), F.col("n"))).alias("i", "edge"))
    at = at.select("edge", "id", "k64", "last", "w", (F.col("start") + F.col("i")).alias("pos"), F.get("edges", F.col("i") + 1).alias("nxt"))
    edges = at.groupBy("edge").agg(F.min(F.struct("id", "k64", "pos")).alias("src"), F.max("last").alias("hi"), F.sum("w").alias("n"), F.sum(F.expr("if(nxt IS NULL, 0, w)")).alias("n_next"), F.min("nxt").alias("lo_next"), F.max("nxt").alias("hi_next"))
    edges = edges.where("src.id < hi").select("edge", F.col("src.id").alias("src_id"), F.col("src.k64").alias("src_k"), F.col("src.pos").alias("src_pos"), "n", F.expr("if(n_next = n AND lo_next = hi_next AND lo_next <> edge, lo_next, null)").alias("nxt"))
    paths = scratch.table(_paths(scratch.table(edges, "substring-edges"), p, scratch), "substring-paths")
    scratch.drop("substring-edges", "substring-pieces")
    # sources are read again; then heads are found in the distinct segments, and through these in all documents
    read = _digests(src, paths.select(F.col("src_id").alias("id"), F.col("src_k").alias("k64"), F.col("src_start").alias("start"), "words"), scratch)
    read = read.select(F.col("id").alias("src_id"), F.col("k64").alias("src_k"), F.col("start").alias("src_start"), "words", "digest")
    paths = scratch.table(paths.join(read, ["src_id", "src_k", "src_start", "words"]), "substring-sources", batch_bytes=SMALL_BATCH_BYTES)
    heads = distinct.select("seg", F.posexplode(F.slice("edges", F.lit(1), F.col("n"))).alias("i", "edge")).join(paths.hint("shuffle_hash"), "edge")
    heads = scratch.table(heads.drop("edge"), "substring-heads")
    spans = occ.select("id", "k64", "start", "seg").join(heads.hint("shuffle_hash"), "seg").where("src_id < id")
    spans = spans.select("id", "k64", (F.col("start") + F.col("i")).alias("start"), "words", "src_id", "src_k", "src_start", "digest")
    spans = scratch.table(spans, "substring-spans")
    scratch.drop("substring-runs", "substring-segments", "substring-paths", "substring-sources", "substring-heads", "substring-wanted")
    return rows, spans


def _cut(src: DataFrame, spans: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, k64, n_removed, kept): the rows that lose words, with the kept words joined by one space.

    A span whose words have another digest than its source's is left.
    """
    per_doc = spans.groupBy("id", "k64").agg(F.collect_set(F.struct("start", "words", "digest")).alias("ranges"))
    per_doc = scratch.table(per_doc.groupBy("id").agg(F.collect_list(F.struct("k64", "ranges")).alias("texts")), "substring-ranges")
    names = ["id", "k64", "n_removed", "kept"]

    @giving_back
    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids = batch.column(0).to_pylist()
            for lo, hi, words, h, ends in _slices(batch):
                plain, at = words.joined()
                plain = plain.tobytes()
                keep = np.ones(len(words.start), bool)
                changed = []
                for i, (a, b) in enumerate(zip(ends, ends[1:])):
                    k64 = _k64(sequence_key(h[a:b]))
                    for form in batch.column(2)[lo + i].as_py():
                        if form["k64"] == k64:
                            spot = at[i] + np.concatenate(([0], np.cumsum(words.end[a:b] - words.start[a:b] + 1)))
                            for r in form["ranges"]:
                                s, e = r["start"], r["start"] + r["words"]
                                if e <= b - a and xxhash.xxh3_128_digest(plain[spot[s] : spot[e] - 1]) == r["digest"]:
                                    keep[a + s : a + e] = False
                            changed.append((i, k64, int(b - a - keep[a:b].sum())))
                data, off = words.joined(keep)
                data, off = data.tobytes(), off.tolist()
                out = [(ids[lo + i], k64, n, data[off[i] : off[i + 1]].decode()) for i, k64, n in changed if n]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.int64(), pa.string()])], names)

    rows = _with_texts(src, per_doc).select("id", "text", "texts")
    return rows.mapInArrow(cut, "id long, k64 long, n_removed long, kept string")


def substring_dedup(docs: DataFrame, p: SubstringParams = SubstringParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_removed, changed, kept (text of rows that lose words; else null), kept_sha256."""
    with Scratch(docs.sparkSession) as scratch:
        src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        rows, spans = repeated_spans(docs, scratch, p, id_col, text_col)
        cut = _cut(src, spans, scratch).withColumn("sha", F.sha2("kept", 256))
        cut = scratch.table(cut.dropDuplicates(["id", "k64"]) if not rows.groupBy("id", "k64").count().where("count > 1").isEmpty() else cut, "substring-cut", keep=True, batch_bytes=SMALL_BATCH_BYTES)
    out = rows.join(cut.hint("shuffle_hash"), ["id", "k64"], "left")
    copy = F.col("copy_of").isNotNull()
    return out.select(
        "id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        (copy | F.col("n_removed").isNotNull()).alias("changed"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "words_sha")).alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, p: SubstringParams = SubstringParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, without the repeated words; rows that lose nothing keep their text as it is.

    Rows left without a word are dropped if they had one. Rows are matched by identifier and text.
    """
    with Scratch(docs.sparkSession) as scratch:
        src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        rows, spans = repeated_spans(docs, scratch, p, id_col, text_col)
        copies = rows.where("copy_of IS NOT NULL").select("id", "words_sha", F.lit("").alias("kept"))
        cut = scratch.table(_cut(src, spans, scratch), "substring-cut", batch_bytes=SMALL_BATCH_BYTES)
        cut = cut.join(rows.select("id", "k64", "words_sha"), ["id", "k64"]).select("id", "words_sha", "kept")
        change = cut.union(copies).dropDuplicates(["id", "words_sha"])
        by_id, forms = free_names(docs, "row_id", "row_forms")
        change = change.groupBy(F.col("id").alias(by_id)).agg(F.collect_list(F.struct("words_sha", "kept")).alias(forms))
        change = scratch.table(change, "substring-changes", keep=True)
    redo = docs.join(change.hint("shuffle_hash"), F.col(id_col) == F.col(by_id), "left")
    # only texts of documents that change are hashed again
    sha = F.sha2(F.trim(F.regexp_replace(text_col, r"[\x20\x09-\x0D]+", " ")), 256)
    new = F.when(F.col(forms).isNotNull(), F.get(F.filter(forms, lambda x: x["words_sha"] == sha), F.lit(0))["kept"])
    redo = redo.withColumn(forms, new).where(F.col(forms).isNull() | (F.col(forms) != ""))
    return redo.select([F.coalesce(forms, text_col).alias(c) if c == text_col else F.col(c) for c in docs.columns])
