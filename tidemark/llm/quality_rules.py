"""Quality rules: base counts, then divergence of a document's histograms from its language's reference.

References are histograms summed over all documents of a language: character classes, and the
most common short words (the word list itself is a fixed-size report, the counts cover every
document). A document is rejected if the Jensen-Shannon distance (base 2, 0 to 1) of either histogram
to its language's reference exceeds its limit, unless the document is too short for the comparison.

Defined cases: null text has no words and fails the base rules; a null language is a language of its
own; a language with too few words in all is compared with the reference of all languages together.
Repeated rows each get their row; null identifiers are passed through; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SMALL_BATCH_BYTES, Scratch, WordHashes, batches_with, giving_back, window_hashes, words_of
from .tokens import forget

_SYMBOL = re.compile(r"[#*$%&|<>]")
#: Character classes: lower case, upper case, other letters, digits, sentence marks, other marks, symbols, line ends.
N_CLASSES = 8


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: Words of at most so many code points compete for the common-word list.
    short_word: int = 5
    common_words: int = 48
    #: Language references with fewer words in all give way to the one of all languages.
    min_reference_words: int = 20_000
    #: Minimum-length guards of the two comparisons.
    min_chars_classes: int = 200
    min_words_common: int = 100
    max_class_distance: float = 0.29
    max_word_distance: float = 0.5


_ASCII = np.full(128, 5, np.int8)
_ASCII[ord("a") : ord("z") + 1] = 0
_ASCII[ord("A") : ord("Z") + 1] = 1
_ASCII[ord("0") : ord("9") + 1] = 3
for _c in ".,;:!?'\"()-":
    _ASCII[ord(_c)] = 4
for _c in "#*$%&|<>@^~+=_\\/{}[]`":
    _ASCII[ord(_c)] = 6
_ASCII[[9, 11, 12, 13, 32]] = -1
_ASCII[10] = 7
_WIDE: dict[int, int] = {}


def _wide_class(cp: int) -> int:
    got = _WIDE.get(cp)
    if got is None:
        c = chr(cp)
        got = 0 if c.islower() else 1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else -1 if c.isspace() else 5
        _WIDE[cp] = got
    return got


def class_counts(text: str) -> np.ndarray:
    """Code points of each character class; blanks are left out."""
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = np.bincount(cps[cps < 128], minlength=128)
    out = np.zeros(N_CLASSES, np.int64)
    np.add.at(out, _ASCII[_ASCII >= 0], plain[_ASCII >= 0])
    wide, n = np.unique(cps[cps >= 128], return_counts=True)
    for cp, k in zip(wide.tolist(), n.tolist()):
        c = _wide_class(cp)
        if c >= 0:
            out[c] += k
    return out


def repeat_words(h: np.ndarray, k: int = 3) -> int:
    """Words inside k-word windows that occur at least twice in the text, first occurrence included."""
    w = window_hashes(h, k)
    if len(w) < 2:
        return 0
    _, inv, n = np.unique(w, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(n[inv] > 1)
    if not len(hit):
        return 0
    edge = np.zeros(len(h) + 1, np.int32)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + k, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if words_of(x)]
    return len(lines) - len(set(lines))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence, base 2; 0 if either histogram is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    kl = lambda a: float(np.sum(a[a > 0] * np.log2(a[a > 0] / m[a > 0])))
    return float(np.sqrt(max(0.0, (kl(p) + kl(q)) / 2)))


def references(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang") -> dict:
    """Language -> (class counts, common words, their counts, all words), from every document.

    Each task sums what it reads; the sums shuffle by (language, item). What reaches the driver is, for
    each language that is large enough, one histogram of classes and the list of common words.
    """
    short = rules.short_word

    @giving_back
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        classes: dict = {}
        words: dict = {}
        for texts, langs in batches_with([text_col, lang_col], it):
            for t, lang in zip(texts, langs):
                if not t:
                    continue
                c = classes.setdefault(lang, np.zeros(N_CLASSES + 1, np.int64))
                ws = words_of(t.lower())
                c[:N_CLASSES] += class_counts(t)
                c[N_CLASSES] += len(ws)
                words.setdefault(lang, Counter()).update([w for w in ws if len(w) <= short])
        for lang, c in classes.items():
            got = words[lang]
            items = [f"#{i}" for i in range(N_CLASSES + 1)] + ["w" + w for w in got]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(items), pa.string()), pa.array(items, pa.string()), pa.array(c.tolist() + list(got.values()), pa.int64())], ["lang", "item", "n"])

    with Scratch(docs.sparkSession) as scratch:
        sums = scratch.table(docs.select(text_col, F.col(lang_col).cast("string").alias(lang_col)).mapInArrow(count, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n")), "quality-sums", batch_bytes=SMALL_BATCH_BYTES)
        total = sums.groupBy("item").agg(F.sum("n").alias("n")).select(F.lit(True).alias("all"), F.lit(None).cast("string").alias("lang"), "item", "n")
        big = sums.where((F.col("item") == f"#{N_CLASSES}") & (F.col("n") >= rules.min_reference_words)).select(F.col("lang").alias("_l"))
        own = sums.join(F.broadcast(big), sums.lang.eqNullSafe(big["_l"]), "left_semi").select(F.lit(False).alias("all"), "lang", "item", "n")
        both = own.union(total)
        # the first of each share of a language's words, then the first of these: no task ranks all words of a language
        rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "item"))
        some = both.where("item LIKE 'w%'").withColumn("share", F.expr("pmod(xxhash64(item), 32)"))
        some = some.withColumn("r", rank("all", "lang", "share")).where(F.col("r") <= rules.common_words)
        ranked = some.withColumn("r", rank("all", "lang"))
        refs: dict = {}
        for r in both.where("item LIKE '#%'").collect():
            refs.setdefault((r["all"], r.lang), [np.zeros(N_CLASSES + 1), []])[0][int(r.item[1:])] = r.n
        for r in ranked.where(F.col("r") <= rules.common_words).orderBy("r").collect():
            refs[(r["all"], r.lang)][1].append((r.item[1:], r.n))
    out = {}
    for key, (c, ws) in refs.items():
        n = c[N_CLASSES]
        counts = np.array([k for _, k in ws] + [max(0.0, n - sum(k for _, k in ws))])
        out[key] = (c[:N_CLASSES], {w: i for i, (w, _) in enumerate(ws)}, counts)
    return out


_SCHEMA = "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double, base_failed boolean, kept boolean"


def quality_rules(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row with the counts, both distances, base_failed and kept."""
    refs = references(docs, rules, text_col, lang_col)

    @giving_back
    def judge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        names = [f.split()[0] for f in _SCHEMA.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.float64()] * 2 + [pa.bool_()] * 2
        for ids, texts, langs in batches_with(["id", text_col, lang_col], it):
            rows = []
            for i, t, lang in zip(ids, texts, langs):
                t = t or ""
                ws = words_of(t)
                n = len(ws)
                rep = repeat_words(hashes.array(ws)) if n else 0
                base = n < rules.min_words or 100 * rep > rules.max_repeat_percent * n
                cd = wd = 0.0
                ref = refs.get((False, lang)) or refs.get((True, None))
                if ref is not None:
                    if len(t) >= rules.min_chars_classes:
                        cd = js_distance(class_counts(t), ref[0])
                    if n >= rules.min_words_common:
                        index, k = ref[1], len(ref[1])
                        got = np.bincount([index.get(w, k) for w in words_of(t.lower())], minlength=k + 1)
                        wd = js_distance(got, ref[2])
                ok = not base and cd <= rules.max_class_distance and wd <= rules.max_word_distance
                rows.append((i, n, sum(map(len, ws)), len(_SYMBOL.findall(t)), dup_lines(t), rep, cd, wd, base, ok))
            cols = list(zip(*rows)) if rows else [[]] * 10
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col, F.col(lang_col).cast("string").alias(lang_col)).mapInArrow(judge, _SCHEMA)
