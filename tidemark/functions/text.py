"""Text normalisation and fingerprints as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import patterns as P


def redact_secrets(c: Column) -> Column:
    for p in P.SECRETS:
        c = F.regexp_replace(c, p, P.SECRET_MARK)
    return c


def mask_volatile(c: Column) -> Column:
    for p, mark in P.VOLATILE:
        c = F.regexp_replace(c, p, mark)
    return c


def mask_counter_lines(lines: Column) -> Column:
    """Array of lines with those that are only a suffixed counter replaced."""
    return F.transform(lines, lambda x: F.when(x.rlike(P.COUNTER_LINE), F.lit("<count>")).otherwise(x))


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def nfkc(c: Column) -> Column:
    """NFKC; ASCII is its own normal form, so only other texts go to Python."""
    return F.coalesce(_nfkc(F.when(c.rlike("[^\\x00-\\x7F]"), c)), c)


def tidy_lines(c: Column) -> Column:
    """Trimmed, blank-collapsed, non-empty lines."""
    lines = F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(F.regexp_replace(x, "[ \\t\\u00A0\\u2007\\u202F]+", " "), "(?U)^\\s+|\\s+$", ""))
    return F.filter(lines, lambda x: x != "")


def normalize_text(c: Column, unicode: bool = True) -> Column:
    """Redact, mask, tidy: always ends in a line feed, so an empty page is one line feed."""
    t = nfkc(F.coalesce(c, F.lit(""))) if unicode else F.coalesce(c, F.lit(""))
    t = mask_volatile(redact_secrets(F.regexp_replace(t, "[\\u200B\\uFEFF]", "")))
    return F.concat(F.array_join(mask_counter_lines(tidy_lines(t)), "\n"), F.lit("\n"))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def text_bytes(c: Column) -> Column:
    return F.octet_length(c)


def is_thin(c: Column, least: int = 500) -> Column:
    return text_bytes(c) < least


def currency_hints(c: Column) -> Column:
    """Sorted distinct currencies that a text names, whatever its prices."""
    found = F.concat(F.regexp_extract_all(c, F.lit(P.CURRENCY_CODES), F.lit(1)), F.regexp_extract_all(c, F.lit(P.CURRENCY_PREFIXES), F.lit(1)))
    return F.array_sort(F.array_distinct(found))


def escape_markup(c: Column) -> Column:
    """Text for HTML or XML, quotes included; null is empty."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def shorten(c: Column, most: int = 260) -> Column:
    """At most `most` characters, cut at a word, with an ellipsis when cut."""
    c = F.coalesce(c, F.lit(""))
    head = F.regexp_replace(F.substring(c, 1, most), "\\s+\\S*\\z", "")
    return F.when(F.char_length(c) <= most, c).otherwise(F.concat(head, F.lit(" …")))


def undouble(c: Column) -> Column:
    """"Beam Beam" -> "Beam": exact halves with one blank between."""
    return F.regexp_replace(c, "^(.+) \\1$", "$1")


def commit_metric(c: Column, pattern: str) -> Column:
    """An optional number in a message; null where it is missing."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).cast("int")


def blank_to(c: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def strip_markup(c: Column) -> Column:
    """Text of HTML by patterns alone, for pages whose tree is not needed: one line per text run."""
    c = F.coalesce(c, F.lit(""))
    for tag in ("script", "style", "nav", "footer"):
        c = F.regexp_replace(c, f"(?is)<{tag}[^>]*>.*?</{tag}>", "\n")
    c = F.regexp_replace(F.regexp_replace(c, "(?s)<!--.*?-->", "\n"), "<[^>]*>", "\n")
    return F.regexp_replace(F.regexp_replace(c, "[ \\t\\n\\r]*\\n[ \\t\\n\\r]*", "\n"), "^\\n+|\\n+$", "")


def line_diff(before: Column, after: Column, most: int = 60) -> Column:
    """struct(lines_added, lines_removed, sample_added, sample_removed) of two texts' lines, in order.

    Marked lines that begin with `++` or `--` are lost as in a unified diff; matching follows difflib.
    """
    return _line_diff(F.coalesce(before, F.lit("")), F.coalesce(after, F.lit("")), F.lit(most))


@F.pandas_udf(T.StructType([T.StructField("lines_added", T.IntegerType()), T.StructField("lines_removed", T.IntegerType()), T.StructField("sample_added", T.ArrayType(T.StringType())), T.StructField("sample_removed", T.ArrayType(T.StringType()))]))
def _line_diff(before: pd.Series, after: pd.Series, most: pd.Series) -> pd.DataFrame:
    import difflib

    out = []
    for a, b, k in zip(before, after, most):
        a, b = a.splitlines(), b.splitlines()
        plus, minus = [], []
        for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, a, b).get_opcodes():
            if tag != "equal":
                minus += [x for x in a[i1:i2] if not x.startswith("--")]
                plus += [x for x in b[j1:j2] if not x.startswith("++")]
        out.append((len(plus), len(minus), plus[:k], minus[:k]))
    return pd.DataFrame(out, columns=["lines_added", "lines_removed", "sample_added", "sample_removed"])
