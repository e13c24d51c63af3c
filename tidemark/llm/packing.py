"""Best-fit packing with swap-based local search, solved on the histogram of piece lengths.

Only lengths matter for packing, and there are at most `capacity` of them, so the driver solves the
problem on their histogram however many documents there are. Bins with the same content are one pattern
with a count. Best fit in falling order of length comes first. A local search then takes any two underfull
bins and moves one document, exchanges one for one or one for two, whenever that raises the sum of squared
fills, and ends at the lower bound of bins, or when no such exchange of any two bins raises it. The
executors place pieces by rank: the k-th piece of a length takes the k-th slot of that length. Ranks come
from per-task counts and their running sums, so no length, however common, meets in one task.

Defined cases: a null text is empty and still has its end id. Null identifiers are packed like others.
Rows that repeat are packed each. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_with, giving_back, materialize, small_side
from .tokens import ByteBpe, default_path, forget, groups_by_size

Pattern = tuple[int, ...]


def best_fit(hist: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Best fit in falling order of length, on counts: pattern (lengths, falling) -> bins."""
    open_: dict[int, dict[Pattern, int]] = defaultdict(dict)  # by room left
    rooms = np.zeros(capacity + 1, bool)

    def put(p: Pattern, room: int, n: int) -> None:
        open_[room][p] = open_[room].get(p, 0) + n
        rooms[room] = True

    for length in sorted(hist, reverse=True):
        left = hist[length]
        while left:
            fit = np.flatnonzero(rooms[length:])
            if not len(fit):
                each = capacity // length
                if left >= each:
                    put((length,) * each, capacity - each * length, left // each)
                if left % each:
                    put((length,) * (left % each), capacity - (left % each) * length, 1)
                break
            room = int(fit[0]) + length
            p, n = next(iter(open_[room].items()))
            # the tightest bin takes as many of this length as it can before the next one does
            each = min(room // length, left)
            bins = min(n, left // each)
            if n == bins:
                del open_[room][p]
                rooms[room] = bool(open_[room])
            else:
                open_[room][p] = n - bins
            put(p + (length,) * each, room - each * length, bins)
            left -= bins * each
    out: dict[Pattern, int] = defaultdict(int)
    for group in open_.values():
        for p, n in group.items():
            out[p] += n
    return dict(out)


def _sums(p: Pattern) -> tuple[int, int]:
    """Bit sets of a pattern's lengths and of the sums of two of them."""
    one = two = 0
    for x in p:
        two |= one << x
        one |= 1 << x
    return one, two


def _raised(bits: int, least: int, most: int) -> int:
    """The bit set of every member plus every number from least to most."""
    n, width = most - least + 1, 1
    if n < 1:
        return 0
    while width < n:
        by = min(width, n - width)
        bits |= bits << by
        width += by
    return bits << least


def _parts(p: Pattern, total: int, most: int) -> tuple[int, ...] | None:
    """At most so many lengths of a pattern with that sum, the fewest first."""
    if not total:
        return ()
    if total in p:
        return (total,)
    if most > 1:
        for i, x in enumerate(p):
            if total - x in p[i + 1 :]:
                return (x, total - x)
    return None


class _Search:
    """Patterns by fill. A pattern is open until no exchange with any other, giving or taking, has a gain."""

    def __init__(self, bins: dict[Pattern, int], capacity: int):
        self.capacity = capacity
        self.bins: dict[Pattern, int] = {}
        self.sums: dict[Pattern, tuple[int, int]] = {}
        self.by_fill: dict[int, set[Pattern]] = {}
        #: Sums of all patterns of a fill, and what these, as takers, can be given for a gain by no fuller one.
        self.merged: dict[int, tuple[int, int, int, int]] = {}
        self.open: list[tuple[int, Pattern]] = []
        self.n = 0
        for p, n in bins.items():
            self.change(p, n)

    def change(self, p: Pattern, n: int) -> None:
        was, fill = self.bins.get(p, 0), sum(p)
        now = self.bins[p] = was + n
        self.n += n
        if not now:
            del self.bins[p]
        if fill == self.capacity:  # a full bin can neither take nor gain by giving
            return
        if not was:
            self.sums[p] = _sums(p)
            self.by_fill.setdefault(fill, set()).add(p)
            self.merged.pop(fill, None)
        elif not now:
            del self.sums[p]
            self.by_fill[fill].remove(p)
            self.merged.pop(fill, None)
            if not self.by_fill[fill]:
                del self.by_fill[fill]
        # beside its like, too, a pattern may exchange
        if not was or was == 1 and now > 1:
            heapq.heappush(self.open, (fill, p))

    def of_fill(self, fill: int, but: Pattern | None = None) -> tuple[int, int, int, int]:
        got = self.merged.get(fill) if but is None else None
        if got is None:
            one = two = 0
            for q in self.by_fill[fill]:
                if q != but:
                    one, two = one | self.sums[q][0], two | self.sums[q][1]
            room = self.capacity - fill
            any_ = bool(one)
            got = (one, two, _raised(any_ | one | two, 1, room) if any_ else 0, _raised(one, 1, room))
            if but is None:
                self.merged[fill] = got
        return got

    def exchange(self, a: Pattern, b: Pattern) -> tuple[Pattern, Pattern] | None:
        """(out, back) of greatest gain from a to b; the gain rises with the length that b gets."""
        fa, fb = sum(a), sum(b)
        (one_a, two_a), (one_b, two_b) = self.sums[a], self.sums[b]
        backs = 1 | one_b | two_b
        for d in range(self.capacity - fb, max(0, fa - fb), -1):
            for had, gets, k in ((one_a, backs, 1), (two_a, one_b, 2)):
                if hit := (gets << d) & had:
                    out = (hit & -hit).bit_length() - 1
                    return _parts(a, out, k), _parts(b, out - d, 3 - k)
        return None

    def step(self, p: Pattern) -> tuple[Pattern, Pattern, Pattern, Pattern] | None:
        """(a, b, out, back) with p as giver to the fullest that it can, else as taker from the least filled."""
        fill = sum(p)
        one, two = self.sums[p]
        room, alone = self.capacity - fill, self.bins[p] < 2
        fills = sorted(self.by_fill, reverse=True)
        for f in fills:
            o, t, given, given_one = self.of_fill(f, p if alone and f == fill else None)
            if not o:
                continue
            if f < fill:
                least, most = fill - f + 1, self.capacity - f
                given, given_one = _raised(1 | o | t, least, most), _raised(o, least, most)
            if one & given or two & given_one:
                for q in sorted(self.by_fill[f], reverse=True):
                    if (q != p or not alone) and (got := self.exchange(p, q)):
                        return p, q, *got
        takes = _raised(1 | one | two, 1, room), _raised(one, 1, room)
        for f in reversed(fills):
            o, t, *_ = self.of_fill(f, p if alone and f == fill else None)
            least = f - fill + 1
            some, single = takes if f <= fill else (_raised(1 | one | two, least, room), _raised(one, least, room))
            if o & some or t & single:
                for q in sorted(self.by_fill[f]):
                    if (q != p or not alone) and (got := self.exchange(q, p)):
                        return q, p, *got
        return None


def local_search(bins: dict[Pattern, int], capacity: int) -> dict[Pattern, int]:
    """Move, one-for-one and two-for-one exchanges between any two underfull bins while the squared fill rises.

    Every step raises the squared fill by a whole number, so the search ends by itself: at the lower bound of
    bins, or where no two bins have an exchange with a gain.
    """
    total = sum(sum(p) * n for p, n in bins.items())
    lower = -(-total // capacity)
    search = _Search(bins, capacity)
    while search.open and search.n > lower:
        fill, p = heapq.heappop(search.open)
        if p not in search.bins:
            continue
        step = search.step(p)
        if not step:
            continue
        heapq.heappush(search.open, (fill, p))
        a, b, out, back = step
        n = min(search.bins[a], search.bins[b]) if a != b else search.bins[a] // 2
        search.change(a, -n)
        search.change(b, -n)
        left, more = list(a), list(b)
        for x in out:
            left.remove(x)
            more.append(x)
        for y in back:
            more.remove(y)
            left.append(y)
        if left:
            search.change(tuple(sorted(left, reverse=True)), n)
        search.change(tuple(sorted(more, reverse=True)), n)
    return search.bins


def solve(hist: dict[int, int], capacity: int) -> dict[Pattern, int]:
    full = hist.get(capacity, 0)
    rest = {n: c for n, c in hist.items() if n != capacity}
    bins = local_search(best_fit(rest, capacity), capacity)
    if full:
        bins[(capacity,)] = bins.get((capacity,), 0) + full
    return bins


def slots(bins: dict[Pattern, int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Length -> (first rank, first sequence, offset) of each run of like slots, by rank."""
    runs = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    base = 0
    for p in sorted(bins, reverse=True):
        at = 0
        for length in p:
            runs[length].append((taken[length], base, at))
            taken[length] += bins[p]
            at += length
        base += bins[p]
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in runs.items()}


def token_pieces(docs: DataFrame, capacity: int, end_id: int, vocab_path: str, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, k[, ids]); k counts like lengths within a task's part."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, k long" + ", ids binary" * with_ids

    @giving_back
    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.shared(vocab_path)
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for ids, texts in batches_with(["doc_id", "text"], it):
            for lo, hi in groups_by_size(texts):
                out = []
                for i, b in zip(ids[lo:hi], bpe.encode(texts[lo:hi])):
                    b += end
                    n = len(b) // 4
                    first = n % capacity or capacity
                    cuts = [0, *range(first, n + 1, capacity)]
                    for j, (s, e) in enumerate(zip(cuts, cuts[1:])):
                        out.append((i, j, s, e - s, zlib.crc32(b[4 * s : 4 * e]), part, seen[e - s], *([b[4 * s : 4 * e]] if with_ids else [])))
                        seen[e - s] += 1
                cols = list(zip(*out))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "k", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names[: len(cols)])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 0, vocab_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids on demand)."""
    spark = docs.sparkSession
    pieces = materialize(token_pieces(docs, capacity, end_id, vocab_path or default_path("byte_bpe_50k.json"), id_col, text_col, with_ids), "pack-pieces")
    counts = materialize(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    # at most `capacity` rows, however large the corpus
    hist = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(solve(hist, capacity)))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = pieces.join(small_side(counts.select("length", "part", before.alias("before"))), ["length", "part"]).withColumn("rank", F.col("before") + F.col("k"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    @giving_back
    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in it:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                first, base, at = table.value[int(length[own[0]])]
                i = np.searchsorted(first, rank[own], side="right") - 1
                seq[own] = base[i] + rank[own] - first[i]
                off[own] = at[i]
            keep = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return ranked.select(*names, "rank").mapInArrow(place, kinds + ", sequence_id long, offset long")
