"""N-gram Jaccard join: rare-first prefix filter with length, positional and suffix filters.

A document's set holds its distinct k-word shingles. Documents with one set are one class; only a
class's smallest identifier goes on. Shingles have one global order: counted ones first, rare before
frequent, then the rest by hash. Counted are those whose hash falls below a fixed share of the hash
range (all of them for small sets), which suffices for the prefix and cuts what is shuffled. Two sets
that reach the threshold share a shingle in their prefixes, so sets are joined on prefix shingles.

A shingle found in one set only can join nothing: it takes its place in the prefix and is then dropped,
so a set whose prefix is all its own is never joined. A place in the prefix bounds the size of a partner
(positional filter), so each row of a list carries the sizes that it can still meet; lists are kept by
classes of size, and a row that no size of another component meets leaves its list before any pair is
made. Short lists pair off. Two documents of a longer one are both of the few that stand in long lists;
these are listed anew with all of their shingles counted among themselves, so that a place in the prefix
bounds partners as tightly as it can. Where up to `pairwise` rows of a list are outside its largest
component, these meet all the others, and the list is done. In another one a few members, its hubs, meet
the others; eight times as many in each round. Pairs within one component are not made any more, so a
list of near copies is done after a few hubs, and no pair that could connect two components is left out.

A pair made in a round is verified in it and set aside, so it is verified once: first on sketches, the
counts of both sets in fixed ranges of the hash range, whose lesser counts bound the overlap (suffix
filter), then on the full sets, which only the survivors fetch.

Defined cases: null or wordless text has an empty set, linked with nothing; a text with fewer words than
k has its whole sequence as its one shingle. Null identifiers get their row back without a component.
Rows that repeat an identifier are linked through it. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SMALL_BATCH_BYTES, Scratch, connected_components, giving_back, materialize, no_rows, sequence_key, small_side
from .tokens import forget
from .wordscan import binary_column, list_column, mix64, text_slices, window_hashes, words_in


@dataclass(frozen=True)
class JaccardParams:
    k: int = 5
    #: Similarity as a fraction num / den.
    num: int = 4
    den: int = 5
    #: Sets of up to about so many shingles count every shingle.
    small: int = 64
    #: Share of the hash range that is counted for larger sets, as a multiple of 1 - similarity.
    share: float = 2.0
    #: A list is done at once when so many of its rows or fewer are outside its largest component; others go through hubs.
    pairwise: int = 16

    def prefix(self, n: int) -> int:
        return n - (self.num * n + self.den - 1) // self.den + 1


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, row behind the last, sorted distinct shingle hashes of each text), slice by slice."""
    for lo, hi, data, text_at in text_slices(texts):
        words = words_in(data, text_at, lower=True)
        h = words.hashes()
        grams = window_hashes(h, k)
        ends = words.word_at.tolist()
        out = []
        for a, b in zip(ends, ends[1:]):
            if b - a >= k:
                out.append(np.unique(grams[a : b - k + 1]))
            else:
                out.append(mix64(window_hashes(h[a:b], b - a) + np.uint64(b - a)) if b > a else np.empty(0, np.uint64))
        yield lo, hi, out


#: Kinds of counted shingles, held in a token's two lowest bits: of small sets, of large sets, and uncounted ones.
LOW, HIGH, REST = 0, 1, 2
#: Ranges of the hash range that a sketch counts, as a power of two.
_SKETCH = 7


def _tagged(a: np.ndarray, kind: int) -> np.ndarray:
    return (a & np.uint64(2**64 - 4)) | np.uint64(kind)


def build_sets(docs: DataFrame, p: JaccardParams, id_col: str, text_col: str) -> DataFrame:
    """(id, n, key, n_low, n_counted, tokens, sketch) per row.

    tokens: all shingles of small sets (LOW); of large sets those in the counted share of the hash range
    (HIGH) and, rarely, the uncounted ones that a prefix still needs (REST). Sets of between small and
    small / similarity shingles are in both kinds, since their partners may be in either.
    """
    limit = np.uint64(int(min(1.0, p.share * (1 - p.num / p.den)) * (2**64 - 2**12)))
    top_small = p.small * p.den // p.num
    names = ["id", "n", "key", "n_low", "n_counted", "tokens", "sketch"]

    @giving_back
    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in it:
            for lo, hi, got in shingle_sets(batch.column(1), p.k):
                n = np.array([len(s) for s in got], np.int64)
                low = np.where(n <= top_small, n, 0)
                counted = np.zeros(len(got), np.int32)
                tokens, sizes = [np.empty(0, np.uint64)], []
                sketch = np.zeros((len(got), 1 << _SKETCH), np.int32)
                for i, s in enumerate(got):
                    parts = [_tagged(s, LOW)] if low[i] else []
                    if len(s) >= p.small:
                        cut = counted[i] = np.searchsorted(s, limit)
                        parts += [_tagged(s[:cut], HIGH), _tagged(s[cut : cut + max(0, p.prefix(len(s)) - cut)], REST)]
                    tokens += parts
                    sizes.append(sum(map(len, parts)))
                    sketch[i] = np.bincount((s >> np.uint64(64 - _SKETCH)).astype(np.int64), minlength=1 << _SKETCH)
                cols = [batch.column(0).slice(lo, hi - lo), pa.array(n), binary_column([sequence_key(s) for s in got]), pa.array(low.astype(np.int32)), pa.array(counted)]
                cols += [list_column(np.concatenate(tokens).view(np.int64), np.array(sizes), pa.int64()), list_column(sketch.reshape(-1), np.full(len(got), 1 << _SKETCH), pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(sets, "id long, n long, key binary, n_low int, n_counted int, tokens array<long>, sketch array<int>")


def _n_of(kind: int) -> Column:
    return F.size(F.filter("shared", lambda s: s["kind"] == kind))


def prefix_lists(reps: DataFrame, p: JaccardParams, scratch: Scratch) -> DataFrame:
    """(token, class, own, id, n, pos, most): prefix shingles that at least two sets hold.

    pos: the shingle's 0-based place in the set's order; most: the largest partner that it still allows.
    class: by size, so that partners are at most one class apart; a row stands in its own class's list (own)
    and in the next one's.
    """
    shared = scratch.table(reps.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "jaccard-shared")
    held = F.struct((F.col("token").bitwiseAND(3)).alias("kind"), F.col("df"), F.col("token"))
    # those of a set come together again: no more than the set itself holds
    mine = reps.select(F.explode("tokens").alias("token"), "id").join(shared.hint("shuffle_hash"), "token")
    mine = scratch.table(mine.groupBy("id").agg(F.array_sort(F.collect_list(held)).alias("shared")), "jaccard-mine")
    got = mine.join(reps.select("id", "n", "n_low", "n_counted"), "id")
    # counted before the rows are made: once for a set, not once for each of its rows
    got = got.select("id", "n", "n_low", "n_counted", "shared", _n_of(LOW).alias("m0"), _n_of(HIGH).alias("m1"))
    rows = got.select("id", "n", "n_low", "n_counted", "m0", "m1", F.posexplode("shared").alias("i", "s"))
    # shingles that only this set holds come first; uncounted ones follow all counted ones, and their least place is a safe bound
    pos = F.when(F.col("s.kind") == LOW, F.col("n_low") - F.col("m0") + F.col("i")).when(F.col("s.kind") == HIGH, F.col("n_counted") - F.col("m1") + F.col("i") - F.col("m0")).otherwise(F.col("n_counted"))
    rows = rows.select(F.col("s.token").alias("token"), "id", "n", pos.cast("long").alias("pos"), F.col("s.kind").alias("kind"))
    rows = rows.where((F.col("kind") == REST) | (F.col("pos") < F.expr(f"n - ({p.num} * n + {p.den - 1}) div {p.den} + 1")))
    rows = rows.withColumn("most", F.expr(f"({p.num + p.den} * (n - pos)) div {p.num} - n")).where(f"{p.den} * most >= {p.num} * n")
    size = F.floor(F.log("n") / F.lit(float(np.log(p.den / p.num) * (1 + 1e-9)))) if p.num < p.den else F.col("n")
    both = F.explode(F.array(F.struct(size.cast("long").alias("class"), F.lit(True).alias("own")), F.struct((size + 1).cast("long").alias("class"), F.lit(False).alias("own")))).alias("c")
    return rows.select("token", both, "id", "n", "pos", "most").select("token", "c.class", "c.own", "id", "n", "pos", "most")


def _partners(x: str, y: str, y_most: str, p: JaccardParams) -> str:
    """Rows x and y of one list may be similar: length and positional filter."""
    return f"({x}.own OR {y}.own) AND {y}.n <= {x}.most AND {x}.n <= {y}.{y_most} AND {p.den} * least({x}.n, {y}.n) >= {p.num} * greatest({x}.n, {y}.n)"


def live_rows(lists: DataFrame, p: JaccardParams) -> DataFrame:
    """Rows (with their component c) that a size of another component in their list still meets, and m, how many these are."""
    cells = lists.groupBy("token", "class", "own", "n").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.max("most").alias("top"))
    meets = F.expr(f"x.token = y.token AND x.class = y.class AND (y.c0 <> x.c OR y.c1 <> x.c) AND {_partners('x', 'y', 'top', p)}")
    return lists.alias("x").join(cells.alias("y"), meets, "left_semi")


def _candidates(hubs: DataFrame, lists: DataFrame, p: JaccardParams) -> DataFrame:
    """Pairs (a, b), a < b, of hubs and other rows of their lists, of two components, that pass the length and positional filters."""
    once = "(x.main IS NULL OR y.c = x.main OR x.id < y.id)"  # where all but the main component are hubs
    meets = F.expr(f"x.token = y.token AND x.class = y.class AND x.c <> y.c AND {once} AND {_partners('x', 'y', 'most', p)}")
    return hubs.alias("x").join(lists.alias("y"), meets).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _sketched(pairs: DataFrame, sketches: DataFrame, p: JaccardParams) -> DataFrame:
    """Pairs whose sketches allow enough overlap."""
    a = sketches.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = sketches.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    bound = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    return pairs.join(b, "b").join(a, "a").where(F.expr(f"{p.num} * (na + nb)") <= (p.num + p.den) * bound).select("a", "b")


def _verified(pairs: DataFrame, full: DataFrame, p: JaccardParams) -> DataFrame:
    """Pairs that reach the threshold on their full sets."""
    ends = small_side(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    full = full.join(ends, "id", "left_semi")
    a = full.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = full.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return pairs.join(b, "b").join(a, "a").where(F.expr(f"{p.num} * (na + nb)") <= (p.num + p.den) * F.size(F.array_intersect("ta", "tb"))).select("a", "b")


def _full_sets(docs: DataFrame, ids: DataFrame, p: JaccardParams, id_col: str, text_col: str) -> DataFrame:
    """(id, n, key, tokens) of the documents named by ids."""

    @giving_back
    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for lo, hi, got in shingle_sets(batch.column(1), p.k):
                n = np.array([len(s) for s in got], np.int64)
                flat = np.concatenate([np.empty(0, np.uint64), *got]).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n), binary_column([sequence_key(s) for s in got]), list_column(flat, n, pa.int64())], ["id", "n", "key", "tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(ids, "id", "left_semi")
    return rows.mapInArrow(sets, "id long, n long, key binary, tokens array<long>")


def _repeated(rows: DataFrame) -> bool:
    return not rows.groupBy("id").count().where("count > 1").isEmpty()


class _Found:
    """Verified links so far, the pairs that were judged, and the components."""

    def __init__(self, sketches: DataFrame, full: DataFrame, p: JaccardParams, scratch: Scratch):
        self.sketches, self.full, self.p, self.scratch = sketches, full, p, scratch
        self.links = no_rows(sketches.sparkSession, "a long, b long")
        self.judged: DataFrame | None = None
        self.comp: DataFrame | None = None

    def judge(self, pairs: DataFrame) -> None:
        """Verify the pairs that were not judged before."""
        scratch = self.scratch
        if self.judged is not None:
            pairs = pairs.join(self.judged, ["a", "b"], "left_anti")
        pairs = scratch.table(pairs, "jaccard-pairs")
        self.judged = pairs if self.judged is None else self.judged.union(pairs)
        likely = scratch.table(_sketched(pairs, self.sketches, self.p), "jaccard-likely")
        self.links = self.links.union(scratch.table(_verified(likely, self.full, self.p), "jaccard-links"))
        self.comp = connected_components(self.links, into=scratch)

    def through(self, lists: DataFrame) -> None:
        """Find all links between rows of the lists that are in different components."""
        p, scratch, n_hubs, columns = self.p, self.scratch, 1, lists.columns
        while True:
            if self.comp is None:
                rows = lists.withColumn("c", F.col("id"))
            else:
                rows = lists.join(small_side(self.comp), "id", "left").select(*columns, F.coalesce("component", "id").alias("c"))
            rows = scratch.table(live_rows(rows, p), "jaccard-rows")
            # of each list its largest component, and how many rows are outside of it
            sizes = rows.groupBy("token", "class", "c").agg(F.count(F.lit(1)).alias("m"))
            sizes = sizes.groupBy("token", "class").agg(F.sum("m").alias("m"), F.max(F.struct("m", "c")).alias("top")).where("top.m < m")
            sizes = scratch.table(sizes.select("token", "class", (F.col("m") - F.col("top.m")).alias("rest"), F.col("top.c").alias("main")), "jaccard-sizes")
            if sizes.isEmpty():
                return
            rows = rows.join(sizes, ["token", "class"])
            fields = ["token", "class", "own", "id", "n", "most", "c"]
            # of a longer list the members with the fewest shingles of their own, one for each share of the list, the main component's last
            best = F.min(F.struct(F.col("c") == F.col("main"), "pos", "id", "own", "n", "most", "c")).alias("h")
            chosen = rows.where(f"rest > {p.pairwise}").groupBy("token", "class", F.expr(f"pmod(xxhash64(id, {n_hubs}), {n_hubs})").alias("share")).agg(best)
            chosen = scratch.table(chosen.select("token", "class", "h.own", "h.id", "h.n", "h.most", "h.c"), "jaccard-hubs")
            hubs = rows.where(f"rest <= {p.pairwise} AND c <> main").select(*fields, "main").union(chosen.select(*fields, F.lit(None).cast("long")))
            self.judge(_candidates(hubs, rows.select(fields), p))
            lists = rows.where(f"rest > {p.pairwise}").join(chosen.select("token", "class", "id"), ["token", "class", "id"], "left_anti").select(columns)
            lists = scratch.table(lists, "jaccard-open")
            if lists.isEmpty():
                return
            n_hubs *= 8
            scratch.drop("jaccard-rows", "jaccard-sizes", "jaccard-hubs", "jaccard-likely")
            scratch.drop("jaccard-open", but_last=True)


def similar_sets(docs: DataFrame, p: JaccardParams = JaccardParams(), id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): rows (id, n, key); classes (key, src, rep); links (a, b) between representatives.

    Links connect every two representatives that a chain of similar sets connects.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    sets = scratch.table(build_sets(docs, p, id_col, text_col), "jaccard-sets", batch_bytes=SMALL_BATCH_BYTES)
    rows = sets.select("id", "n", "key")
    named = rows.where("n > 0 AND id IS NOT NULL")
    classes = named.groupBy("key").agg(F.min("id").alias("src"), F.max("n").alias("n"))
    # an identifier that several different sets share can't stand for one of them
    torn = scratch.table(named.groupBy("id").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("id"), "jaccard-torn")
    mixed = not torn.isEmpty()
    rep = F.when(F.col("torn"), -(1 << 62) - F.expr("pmod(xxhash64(key), 4611686018427387903)")).otherwise(F.col("src")) if mixed else F.col("src")
    if mixed:
        classes = classes.join(torn.select(F.col("id").alias("src"), F.lit(True).alias("torn")), "src", "left").withColumn("torn", F.coalesce("torn", F.lit(False)))
    classes = scratch.table(classes.select("key", "src", rep.alias("rep")), "jaccard-classes")
    if mixed:
        reps = sets.withColumnRenamed("id", "src").join(classes, ["src", "key"]).drop("src").withColumnRenamed("rep", "id").dropDuplicates(["id"])
    else:
        # copies are fewer than sets: they are taken out, and the sets themselves need not move
        copies = scratch.table(named.join(classes, "key").where("id <> rep").select("id"), "jaccard-copies")
        reps = sets.where("n > 0 AND id IS NOT NULL").join(small_side(copies), "id", "left_anti")
        if _repeated(named):
            reps = reps.dropDuplicates(["id"])
    lists = scratch.table(live_rows(prefix_lists(reps, p, scratch).withColumn("c", F.col("id")), p).drop("c"), "jaccard-lists")
    wanted = scratch.table(lists.select(F.col("id").alias("rep")).distinct().join(classes, "rep"), "jaccard-wanted")
    sketches = scratch.table(reps.join(small_side(wanted.select(F.col("rep").alias("id"))), "id", "left_semi").select("id", "n", "sketch"), "jaccard-sketches")
    rows = scratch.table(rows, "jaccard-named")
    scratch.drop("jaccard-sets", "jaccard-shared", "jaccard-mine", "jaccard-copies")
    full = _full_sets(docs, small_side(wanted.select(F.col("src").alias("id")).distinct()), p, id_col, text_col)
    if mixed:
        full = full.join(wanted.select("key", "rep"), "key").withColumn("id", F.col("rep")).drop("rep")
    full = scratch.table(full.dropDuplicates(["id"]).drop("key"), "jaccard-full", batch_bytes=SMALL_BATCH_BYTES)
    found = _Found(sketches, full, p, scratch)
    sizes = scratch.table(lists.groupBy("token", "class").agg(F.count(F.lit(1)).alias("m")).where(f"m > {p.pairwise + 1}").select("token", "class"), "jaccard-long")
    found.through(lists.join(small_side(sizes), ["token", "class"], "left_anti"))
    many = scratch.table(lists.join(small_side(sizes), ["token", "class"], "left_semi").select("id").distinct(), "jaccard-many")
    if not many.isEmpty():
        # members of long lists: all of their shingles are counted, among themselves
        again = full.join(small_side(many), "id", "left_semi")
        again = again.select("id", "n", F.col("n").cast("int").alias("n_low"), F.lit(0).alias("n_counted"), F.transform("tokens", lambda t: t.bitwiseAND(F.lit(-4))).alias("tokens"))
        found.through(scratch.table(prefix_lists(again, p, scratch), "jaccard-again"))
    return rows, classes, found.links


def near_duplicates(docs: DataFrame, p: JaccardParams = JaccardParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id that links reach, itself included)."""
    with Scratch(docs.sparkSession) as scratch:
        rows, classes, links = similar_sets(docs, p, id_col, text_col, scratch)
        comp = connected_components(links, into=scratch)
        named = classes.join(comp, classes.rep == comp.id, "left").select("key", F.coalesce("component", "rep").alias("component"))
        out = rows.join(named, "key", "left").select("id", F.col("n").alias("n_shingles"), "component")
        if not classes.where("rep <> src").isEmpty():
            # rows that share an identifier are linked through it, and components are named by real identifiers
            out = scratch.table(out, "jaccard-found")
            held = out.where("id IS NOT NULL AND component IS NOT NULL")
            tied = held.groupBy("id").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
            joined = connected_components(tied.select("a", "b"), into=scratch).select(F.col("id").alias("component"), F.col("component").alias("c2"))
            out = out.join(joined, "component", "left").select("id", "n_shingles", F.coalesce("c2", "component").alias("component"))
            least = out.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
            out = out.join(least, "component", "left").select("id", "n_shingles", F.col("least").alias("component"))
        return materialize(out.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")), "near-duplicates")
