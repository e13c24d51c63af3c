"""Toxicity: Levenshtein automata over a lexicon trie find misspelled terms; context windows weigh each hit.

The lexicon is learned from labelled rows: whole words and word beginnings that occur in toxic rows far
more often than chance allows beside the clean rows. It is held as a trie; a word is matched by walking
trie and Levenshtein automaton together, so only states within the allowed distance live. Each hit gets
a weight from its window: marks of quotation around it and words of report before it lower it, words
of address near it raise it. A small logistic model turns the weighted hits into a score.

Rows for learning are drawn by a hash of the identifier, at most `max_rows` in expectation (a documented
bound for the classifier alone; scoring reads every row and the whole text). Rows whose
crc32(identifier as text) mod 4 is 2 are held out and never learned from.

Defined cases: null and empty texts have no hit and get the base score. Rows without a label are scored
like others; null labels teach nothing. Null identifiers are scored, never learned from, and count as
not held out. Repeated rows each get a row. Without any label the seed lexicon alone is used. Columns
other than identifier and text are not read for the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_with, materialize

#: General terms of abuse that hold without any label.
SEED_TERMS = ("asshole", "bastard", "bitch", "cretin", "degenerate", "disgusting", "dumbass", "filth", "fuck", "idiot", "imbecile", "loser", "moron", "pathetic", "retard", "scum", "scumbag", "shithead", "stupid", "trash", "vermin", "worthless")
#: Words of report, and words of address.
REPORT = frozenset("said says say called calls wrote writes written quoted quotes quote word words term terms phrase means meaning definition defined spelled example reported alleged".split())
ADDRESS = frozenset("you your youre yours u ur yourself du dich dir ihr tu te vous ton toi eres usted ustedes".split())
#: Signs often put for letters.
SIGNS = str.maketrans("013457@$", "oieastas")
_TOKEN = re.compile(r"[\w@$]+")
_STRETCHED = re.compile(r"(.)\1{2,}")
_QUOTES = re.compile(r"[\"“”„«»]")


@dataclass(frozen=True)
class ToxicParams:
    max_rows: int = 20_000
    window: int = 6
    min_rows: int = 3
    #: Chance, over all candidates together, that a term with no link to the label is taken.
    chance: float = 0.02
    #: Least length at which one edit, and two edits, are allowed.
    one_edit: int = 5
    two_edits: int = 10
    stem_lengths: tuple[int, ...] = (4, 5, 6, 7)
    #: Least length of a stem at which edits are allowed.
    stem_edit: int = 6
    #: Log odds of a form in toxic against clean rows: the least to count at all, and for full weight.
    min_odds: float = 2.0
    full_odds: float = 5.0
    threshold: float = 0.3


@dataclass
class Lexicon:
    """terms: whole words; stems: word beginnings."""

    terms: dict[str, float]
    stems: dict[str, float]
    model: tuple[float, ...] = (-4.0, 2.5, 1.0, 1.5)
    trie: dict = field(default_factory=dict)

    def __post_init__(self):
        for w, (kind, weight) in [*((w, ("", v)) for w, v in self.terms.items()), *((w, ("*", v)) for w, v in self.stems.items())]:
            node = self.trie
            for c in w:
                node = node.setdefault(c, {})
            node["\0" + kind] = (w, weight)


class _Steps:
    """Transitions of the Levenshtein automata of one limit, shared by all words.

    A state is the stretch of the row of distances that can stay within the limit, 2 * limit + 1 places about
    the diagonal, cut off above it. Where it goes depends on that stretch, the one before it (a swap of
    neighbours is one edit) and on which of the word's letters there equal the term's; each is worked out once.
    """

    def __init__(self, limit: int):
        self.limit, self.width = limit, 2 * limit + 1
        self.full = (1 << self.width) - 1
        self.rows: list[tuple[int, ...]] = []
        self.least: list[int] = []
        self.ids: dict[tuple[int, ...], int] = {}
        self.known: dict[tuple[int, int, int, int, int], int] = {}
        self.dead = self.number((limit + 1,) * self.width)

    def number(self, row: tuple[int, ...]) -> int:
        if row not in self.ids:
            self.ids[row] = len(self.rows)
            self.rows.append(row)
            self.least.append(min(row))
        return self.ids[row]

    def go(self, key: tuple[int, int, int, int, int]) -> int:
        """key: state, state before it, letters that equal, letters that a swap makes equal, places inside the word."""
        row, old, same, swapped, inside = self.rows[key[0]], self.rows[key[1]], *key[2:]
        over = self.limit + 1
        out: list[int] = []
        for t in range(self.width):
            d = over
            if inside >> t & 1:
                d = min(row[t] + (not same >> t & 1), row[t + 1] + 1 if t + 1 < self.width else over, out[-1] + 1 if out else over, old[t] + 1 if swapped >> t & 1 else over, over)
            out.append(d)
        got = self.known[key] = self.number(tuple(out))
        return got


_STEPS: dict[int, _Steps] = {}


class Automaton:
    """The Levenshtein automaton of one word; states are numbers of its limit's table."""

    def __init__(self, word: str, limit: int):
        if limit not in _STEPS:
            _STEPS[limit] = _Steps(limit)
        self.steps, self.n, self.limit = _STEPS[limit], len(word), limit
        self.at: dict[str, int] = {}
        for i, c in enumerate(word):
            self.at[c] = self.at.get(c, 0) | 1 << (i + limit)
        self.inside = ((1 << (self.n + 1)) - 1) << limit

    def start(self) -> int:
        k = self.limit
        return self.steps.number(tuple(t - k if 0 <= t - k <= self.n else k + 1 for t in range(self.steps.width)))

    def step(self, state: int, depth: int, c: str, before: int | None = None, last: str = "") -> int:
        """From the state after `depth` characters of a term to the one after its next, c; before and last: one character ago."""
        s = self.steps
        own = self.at.get(c, 0)
        swapped = (self.at.get(last, 0) >> depth) & (own >> (depth - 1)) & s.full if before is not None else 0
        key = (state, s.dead if before is None else before, (own >> depth) & s.full, swapped, (self.inside >> (depth + 1)) & s.full)
        got = s.known.get(key)
        return s.go(key) if got is None else got

    def distance(self, state: int, depth: int) -> int:
        """Of the whole word from a term of that length; above the limit it is the limit plus one."""
        t = self.n - depth + self.limit
        return self.steps.rows[state][t] if 0 <= t < self.steps.width else self.limit + 1

    def nearest(self, state: int) -> int:
        """Of the word's nearest beginning."""
        return self.steps.least[state]


def match(lex: Lexicon, word: str, p: ToxicParams) -> tuple[float, int] | None:
    """(weight, edits) of the best term within the distance that the word's length allows, else None.

    The first character of a term must match: edits there make other words more often than misspellings.
    """
    limit = 2 if len(word) >= p.two_edits else 1 if len(word) >= p.one_edit else 0
    node = lex.trie.get(word[:1])
    if node is None:
        return None
    auto = Automaton(word, limit)
    best: tuple[float, int] | None = None
    first = auto.start()
    stack = [(node, auto.step(first, 0, word[0]), first, word[0], 1)]
    while stack:
        node, state, before, last, depth = stack.pop()
        for key, sub in node.items():
            if key[0] == "\0":
                term, weight = sub
                if key == "\0*":
                    # the nearest beginning of the word; short stems must stand exactly, as edits would reach other words
                    d = 0 if word.startswith(term) else auto.nearest(state) if len(term) >= p.stem_edit else limit + 1
                else:
                    d = auto.distance(state, depth)
                if d <= limit and d <= len(term) // 4 and (best is None or (weight * 0.9**d) > best[0] * 0.9 ** best[1]):
                    best = (weight, d)
            else:
                nxt = auto.step(state, depth, key, before, last)
                if auto.nearest(nxt) <= limit:
                    stack.append((sub, nxt, state, key, depth + 1))
    return best


def _deletions(word: str, n: int) -> set[str]:
    """The word with up to n characters taken out, the first never."""
    out = last = {word}
    for _ in range(n):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(1, len(w))}
        out = out | last
    return out


class _Bit(dict):
    def __missing__(self, c: str) -> int:
        self[c] = bit = 1 << (ord(c) & 63)
        return bit


_BIT = _Bit()


def _letters(word: str) -> int:
    """The set of a word's letters as bits; letters that share a bit make it a smaller set, never another one."""
    out = 0
    for c in word:
        out |= _BIT[c]
    return out


class Scorer:
    """Hits and score of a text; remembers the words it has matched."""

    def __init__(self, lex: Lexicon, p: ToxicParams):
        self.lex, self.p = lex, p
        self.seen: dict[str, tuple[float, int] | None] = {}
        # words within k edits (swaps too) of a term with the same first letter share a form with up to k taken out of each
        self.keys: set[str] = set()
        # first letter and length of a word -> the letters of each term that it may be, and the edits that this allows it
        self.near: dict[tuple[str, int], list[tuple[int, int]]] = {}
        for w in lex.terms:
            k = min(2, len(w) // 4)
            self.keys |= _deletions(w, k)
            for n in range(max(1, len(w) - k), len(w) + k + 1):
                own = min(k, self.limit(n))
                if abs(n - len(w)) <= own:
                    self.near.setdefault((w[0], n), []).append((_letters(w), own))
        self.stem_lengths = sorted({len(w) for w in lex.stems})
        # first letter -> of each stem that may be misspelled its letters, its length and the edits that it allows
        self.begins: dict[str, list[tuple[int, int, int]]] = {}
        for w in lex.stems:
            if len(w) >= p.stem_edit:
                k = min(2, len(w) // 4)
                self.keys |= _deletions(w, k)
                self.begins.setdefault(w[0], []).append((_letters(w), len(w), k))

    def limit(self, n: int) -> int:
        return 2 if n >= self.p.two_edits else 1 if n >= self.p.one_edit else 0

    def maybe(self, word: str) -> bool:
        """False only where match() finds nothing."""
        if any(word[:n] in self.lex.stems for n in self.stem_lengths):
            return True
        # an edit takes one letter from the set of a word's letters and adds one at most; few words come through
        has = _letters(word)
        k = max((k for m, k in self.near.get((word[:1], len(word)), ()) if (m & ~has).bit_count() <= k and (has & ~m).bit_count() <= k), default=None)
        if k is not None and not self.keys.isdisjoint(_deletions(word, k)):
            return True
        limit = self.limit(len(word))
        for m, n, k in self.begins.get(word[:1], ()) if limit else ():
            if (m & ~has).bit_count() <= k and any(not self.keys.isdisjoint(_deletions(word[:i], min(k, limit))) for i in range(n - k, min(n + k, len(word)) + 1)):
                return True
        return False

    def matched(self, word: str) -> tuple[float, int] | None:
        return match(self.lex, word, self.p) if self.maybe(word) else None

    def lookup(self, word: str) -> tuple[float, int] | None:
        if word not in self.seen:
            if len(self.seen) > 400_000:
                self.seen.clear()
            plain = word.translate(SIGNS) if not word.isalpha() else word
            got = self.matched(word) or (self.matched(plain) if plain != word else None)
            if got is None and len(word) > 3:
                squeezed = _STRETCHED.sub(r"\1", plain)
                got = self.matched(squeezed) if squeezed != plain else None
            self.seen[word] = got
        return self.seen[word]

    def features(self, text: str | None) -> tuple[float, float, float]:
        """(log of weighted hits, their density, the heaviest hit)."""
        low = (text or "").lower()
        words = _TOKEN.findall(low)
        some = {w for w in set(words) if self.lookup(w)}
        if not some:
            return 0.0, 0.0, 0.0
        p = self.p
        spans = [(m.start(), m.end()) for m in _TOKEN.finditer(low)]
        marks = [m.start() for m in _QUOTES.finditer(low)]
        total = top = 0.0
        for i, w in enumerate(words):
            if w not in some:
                continue
            weight, edits = self.lookup(w)
            near = words[max(0, i - p.window) : i] + words[i + 1 : i + 1 + p.window]
            lo, hi = spans[max(0, i - p.window)][0], spans[min(len(spans) - 1, i + p.window)][1]
            quoted = any(lo <= q < spans[i][0] for q in marks) and any(spans[i][1] <= q < hi for q in marks)
            reported = any(x in REPORT for x in words[max(0, i - p.window) : i])
            v = weight * 0.9**edits * (0.25 if quoted and reported else 0.5 if quoted else 0.8 if reported else 1.0)
            v *= 1.25 if any(x in ADDRESS for x in near) else 1.0
            total += v
            top = max(top, v)
        return math.log1p(total), total / len(words) * 10, top

    def score(self, text: str | None) -> float:
        b, *ws = self.lex.model
        f = self.features(text)
        z = b + sum(w * x for w, x in zip(ws, f))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _forms(text: str, p: ToxicParams) -> set[str]:
    words = {w for w in _TOKEN.findall(text.lower()) if 3 <= len(w) <= 30}
    return words | {w[:n] + "*" for w in words for n in p.stem_lengths if len(w) > n}


def training_rows(docs: DataFrame, labels: DataFrame, p: ToxicParams, id_col: str, text_col: str) -> DataFrame:
    """(id, toxic, text): labelled rows that are not held out, thinned by hash to max_rows in expectation."""
    own = labels.where("toxic IS NOT NULL").where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    own = own.where(F.expr("crc32(cast(cast(id AS string) AS binary)) % 4 <> 2")).groupBy("id").agg(F.max("toxic").alias("toxic"))
    n = own.count()
    if n > p.max_rows:
        own = own.where(F.expr(f"pmod(xxhash64(id), 1000000) < {int(1_000_000 * p.max_rows / n)}"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # the sample is bounded by max_rows, so it may be broadcast
    return materialize(texts.join(F.broadcast(own), "id"), "toxic-training")


def learn(docs: DataFrame, labels: DataFrame, p: ToxicParams = ToxicParams(), id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    rows = training_rows(docs, labels, p, id_col, text_col)

    def forms(it: Iterator[pa.RecordBatch], among: frozenset | None) -> Iterator[pa.RecordBatch]:
        got: Counter = Counter()
        n = 0
        for (texts,) in batches_with(["text"], it):
            for t in texts:
                n += 1
                f = _forms(t or "", p)
                got.update(f if among is None else f & among)
        got["\0"] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(got)), pa.array(list(got.values()), pa.int64())], ["form", "n"])

    def counts(label: int, among: frozenset | None, least: int) -> dict[str, int]:
        own = rows.where(F.col("toxic") == label).select("text").mapInArrow(lambda it: forms(it, among), "form string, n long")
        return {r.form: r.n for r in own.groupBy("form").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("form") == "\0")).collect()}

    toxic = counts(1, None, p.min_rows)
    n1 = toxic.pop("\0", 0)
    clean = counts(0, frozenset(toxic), 1) if n1 else {"\0": 0}
    n0 = clean.pop("\0", 0)
    terms, stems = dict.fromkeys(SEED_TERMS, 1.0), {}
    if n1 and n0:
        # Chernoff's bound on the chance that a form with no link to the label stands in so many toxic rows of its rows
        rate, least = n1 / (n1 + n0), math.log(max(1, len(toxic)) / p.chance)
        taken = {}
        for form, k in toxic.items():
            c = clean.get(form, 0)
            share = k / (k + c)
            odds = math.log((k + 0.5) / (n1 + 1)) - math.log((c + 0.5) / (n0 + 1))
            bound = k * math.log(share / rate) + (c * math.log((1 - share) / (1 - rate)) if c else 0.0)
            if share > rate and bound >= least and odds > p.min_odds:
                taken[form] = min(1.0, odds / p.full_odds)
        # a longer form speaks for itself only where it says clearly more than its beginnings
        more = lambda f, w: all(w > v + 0.12 for s, v in stems.items() if f.startswith(s))
        for form in sorted((f for f in taken if f[-1] == "*"), key=lambda f: (len(f), f)):
            if more(form[:-1], taken[form]):
                stems[form[:-1]] = taken[form]
        whole = {f: w for f, w in taken.items() if f[-1] != "*"}
        # a beginning that only one whole word fills is that word
        for s in [s for s in stems if any(w.startswith(s) and toxic[w] >= 0.9 * toxic[s + "*"] for w in whole)]:
            del stems[s]
        # a stem stands for its whole words too, but only as terms are these found misspelled
        terms |= whole
    lex = Lexicon(terms, stems)
    if n1 and n0:
        lex.model = _fit(rows, lex, p)
    return lex


def _fit(rows: DataFrame, lex: Lexicon, p: ToxicParams) -> tuple[float, ...]:
    """Logistic regression on the three features of the bounded sample, by Newton steps with a ridge."""

    def features(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(lex, p)
        for texts, ys in batches_with(["text", "toxic"], it):
            f = [s.features(t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in zip(*f)] + [pa.array(ys, pa.int32())] if f else [pa.array([], pa.float64())] * 3 + [pa.array([], pa.int32())], ["a", "b", "c", "y"])

    got = rows.select("text", "toxic").mapInArrow(features, "a double, b double, c double, y int").toArrow()
    x = np.column_stack([np.ones(got.num_rows), *(got.column(c).to_numpy() for c in "abc")])
    y = got.column("y").to_numpy().astype(float)
    w = np.zeros(4)
    ridge = np.diag([0.05, 0.05, 0.05, 0.05])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + ridge, x.T @ (y - q) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    # a hit never lowers a score
    return (float(min(w[0], -1.0)), *(float(max(0.0, v)) for v in w[1:]))


def score_documents(docs: DataFrame, lex: Lexicon, p: ToxicParams = ToxicParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, n_hits."""
    held = docs.sparkSession.sparkContext.broadcast(lex)

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(held.value, p)
        for ids, texts in batches_with(["doc_id", "text"], it):
            v = [s.score(t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(v, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(score, "doc_id long, score double")
    out = F.coalesce(F.expr("crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2"), F.lit(False))
    return rows.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= p.threshold).cast("int").alias("predicted"))
