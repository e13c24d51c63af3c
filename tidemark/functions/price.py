"""Prices, units, names and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

_ANY_CASE = "(?i)"


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def currency_of(sign: Column) -> Column:
    """Canonical currency: the exact sign first, then its upper case; unknown signs are null."""
    return F.coalesce(_lookup(P.CURRENCY_OF, sign), _lookup(P.CURRENCY_OF, F.upper(sign)))


def parse_price(c: Column) -> Column:
    """struct(amount, currency, raw) of the first price in a text; nulls and '' if there is none."""
    at = lambda g: F.regexp_extract(c, _ANY_CASE + P.PRICE, g)
    number = F.nullif(F.replace(at(2), F.lit(","), F.lit("")), F.lit("")).cast("double")
    suffix = F.lower(F.trim(at(3)))
    scale = F.when(suffix == "k", 1e3).when(suffix == "m", 1e6).otherwise(1.0)
    return F.struct((number * scale).alias("amount"), currency_of(F.nullif(at(1), F.lit(""))).alias("currency"), F.coalesce(F.trim(at(0)), F.lit("")).alias("raw"))


def slot_prices(c: Column) -> Column:
    """Distinct numbers of the prices that stand with the first one: no letter or digit, and few signs, between them."""
    gap = r"[^\p{L}\p{N}]{0," + str(P.SLOT_GAP) + "}?"
    one = P.PRICE.replace("(US", "(?:US", 1).replace("(\\d", "(?:\\d", 1).replace("(\\s?[kK", "(?:\\s?[kK", 1)
    run = F.regexp_extract(c, f"{_ANY_CASE}{one}(?:{gap}{one})*", 0)
    numbers = F.transform(F.regexp_extract_all(run, F.lit(_ANY_CASE + P.PRICE), F.lit(2)), lambda x: F.replace(x, F.lit(","), F.lit("")).cast("double"))
    return F.slice(F.array_distinct(numbers), 1, P.SLOT_PRICES)


def parse_period(c: Column) -> Column:
    """Canonical billing unit: a time-like unit anywhere wins over other units; null if none."""
    word = lambda p: F.nullif(F.regexp_extract(c, _ANY_CASE + p, 1), F.lit(""))
    return canonical_unit(F.coalesce(word(P.TIME_UNIT), word(P.OTHER_UNIT)))


def canonical_unit(word: Column) -> Column:
    low = F.lower(word)
    return F.coalesce(_lookup(P.UNIT_OF, F.regexp_replace(F.rtrim(low), "[\\s.-]+", "")), low)


def clean_name(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "(?U)\\s+", " "), "^[ \\t\\-–—:·|]+|[ \\t\\-–—:·|]+$", "")


def name_key(c: Column) -> Column:
    return F.lower(F.trim(c))


def norm_label(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "(?U)\\s+", " ")), "^:+|:+$", ""))


def plausible_name(c: Column) -> Column:
    """A name that a plan could have: a conjunction of cheap tests on the cleaned name."""
    n = clean_name(c)
    low = F.lower(n)
    return F.coalesce(
        F.char_length(n).between(2, 48)
        & ~low.isin(*P.FRAGMENT_WORDS)
        & ~n.rlike("[:?]$")
        & ~n.rlike(_ANY_CASE + P.PRICE)
        & ~n.rlike(_ANY_CASE + P.NOT_A_NAME)
        & n.rlike("\\p{L}")
        & (F.size(F.split(n, " ")) <= 5)
        & ~n.rlike(_ANY_CASE + P.GENERIC_HEADING)
        & ~n.rlike(_ANY_CASE + P.HEADING_TAIL),
        F.lit(False),
    )


def plausible_model(c: Column) -> Column:
    n = F.trim(F.coalesce(c, F.lit("")))
    return F.char_length(n).between(2, 80) & n.rlike("[A-Za-z0-9]") & ~norm_label(n).isin(*P.NOT_MODELS) & ~n.rlike(_ANY_CASE + P.HEADING_TAIL)


def is_model_column(label: Column) -> Column:
    return F.coalesce((label != "") & (F.char_length(label) <= 40) & ~label.rlike(_ANY_CASE + P.NOT_MODEL_COLUMN) & (label.rlike(_ANY_CASE + P.MODEL_COLUMN) | label.rlike(_ANY_CASE + P.MODEL_COLUMN_LOOSE)), F.lit(False))


def free_at_top(c: Column) -> Column:
    return F.substring(F.coalesce(c, F.lit("")), 1, 100).rlike(_ANY_CASE + P.FREE_AT_TOP)


def free_contradiction(name: Column, amount: Column) -> Column:
    return F.coalesce(name.rlike(_ANY_CASE + P.FREE_NAME) & (amount > 0), F.lit(False))


def table_unit(caption: Column, labels: Column) -> Column:
    """The first unit that a caption, then a label, names; '' if none."""
    hits = F.transform(F.concat(F.array(caption), labels), lambda x: F.lower(F.trim(F.regexp_replace(F.regexp_extract(F.coalesce(x, F.lit("")), _ANY_CASE + P.TABLE_UNIT, 0), "(?U)\\s+", " "))))
    return F.coalesce(F.get(F.filter(hits, lambda x: x != ""), F.lit(0)), F.lit(""))


def percent(a: Column, b: Column) -> Column:
    """Percent with two digits, whatever the first number; infinite from zero.

    The hundredfold is rounded, half cases away from zero, and a small fall keeps its sign (-0.0), as SQL's round does.
    """
    p = F.when(a != 0, (b - a) / a * 100).otherwise(F.signum(b - a) * F.lit(float("inf")))
    return F.signum(p) * F.round(F.abs(p) * 100) / 100


def pct_change(a: Column, b: Column) -> Column:
    """Percent with two digits; null unless both are known and the first is positive."""
    return F.when(a > 0, percent(a, b))


def direction(a: Column, b: Column) -> Column:
    return F.when(b > a, "up").when(b <= a, "down")


def money(raw: Column, currency: Column) -> Column:
    """A price as shown: a bare number gets its currency's symbol, an unknown currency its code."""
    t = F.trim(F.coalesce(raw, F.lit("")))
    bare = ~t.rlike("[$€£¥]") & ~F.contains(t, currency)
    symbol = _lookup(P.DISPLAY_SYMBOL, currency)
    shown = F.when(symbol.isNotNull(), F.concat(symbol, t)).otherwise(F.concat(t, F.lit(" "), currency))
    return F.when((t == "") | currency.isNull() | (currency == "") | ~bare, t).otherwise(shown)


def pct_label(pct: Column) -> Column:
    """'+12.5%', '-3%'; empty if unknown."""
    text = F.regexp_replace(F.regexp_replace(F.format_string("%.2f", pct), "0+$", ""), "\\.$", "")
    return F.when(pct.isNull(), "").otherwise(F.concat(F.when(pct > 0, "+").otherwise(""), text, F.lit("%")))


def period_label(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", "not stated").otherwise(F.coalesce(_lookup(P.UNIT_LABEL, c), c))


def column_label(c: Column) -> Column:
    """Position labels ('kolom 2') read 'column 2' when shown."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), "^kolom (\\d+)$", "column $1")


def model_item(model: Column, field: Column) -> Column:
    return F.concat(model, F.lit(" · "), column_label(field))


def price_summary(prices: Column, most: int = 4) -> Column:
    """map<label, struct<raw, amount>> as 'label: raw · …'; position labels are left out."""
    entry = lambda e: F.when(e["key"].rlike("^kolom \\d+$"), F.trim(e["value"]["raw"])).otherwise(F.concat(e["key"], F.lit(": "), F.trim(F.coalesce(e["value"]["raw"], F.lit("")))))
    return F.array_join(F.transform(F.slice(F.map_entries(prices), 1, most), entry), " · ")


def month_label(c: Column) -> Column:
    """'2026-10' -> 'October 2026'; anything else as it is."""
    return F.coalesce(F.date_format(F.try_to_timestamp(F.concat(c, F.lit("-01")), F.lit("yyyy-MM-dd")), "MMMM yyyy"), c)


def rfc822_day(d: Column) -> Column:
    return F.concat(F.date_format(d, "EEE, dd MMM yyyy"), F.lit(" 00:00:00 +0000"))


def settle_ms(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(0)) == 0, 2500).otherwise(F.greatest(F.lit(2500), F.least(F.lit(20000), c)))


def readable_size(c: Column) -> Column:
    kib, mib = F.bround(c / 1024.0, 1), F.bround(c / 1048576.0, 1)
    return F.when(c < 1024, F.concat(c.cast("string"), F.lit(" B"))).when(c < 1048576, F.concat(F.format_string("%.1f", kib), F.lit(" KiB"))).otherwise(F.concat(F.format_string("%.1f", mib), F.lit(" MiB")))


def category_label(c: Column, labels: dict[str, str]) -> Column:
    return F.coalesce(_lookup(labels, c), c)
