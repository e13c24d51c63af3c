"""Snapshot comparison: keyed matches, an ordered cascade of guards, change kinds.

A difference of two numbers is a price move only once the two are proven comparable: one currency, one
unit, one unambiguous name, one slot, one extractor, one locale. Each guard that fails gives the event
another type instead. Events are flat rows, one per event, ordered by nothing; compare them as bags.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import price as fp
from ..functions.text import line_diff

PLAN_FIELDS = ("name", "price_raw", "amount", "currency", "period", "features", "slot_prices")
EVENT = "type string, plan string, price string, amount double, period string, from_amount double, to_amount double, from_raw string, to_raw string, from_currency string, to_currency string, from_value string, to_value string, pct_change double, direction string, slot_before array<double>, slot_after array<double>, added array<string>, removed array<string>"


def first_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with one key, the first by `order`; a grouped minimum, so a hot key combines map-side."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_w")).select(*keys, "_w.*")


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_w")).select(*keys, "_w.*")


def _disagree(amount: Column) -> Column:
    """Aggregate: more than one distinct amount; an unknown amount counts as one."""
    return (F.min(amount) != F.max(amount)) | ((F.count(amount) > 0) & F.max(amount.isNull()))


def ambiguous_names(rows: DataFrame, keys: list[str], amount: str = "amount") -> DataFrame:
    """Keys that carry more than one distinct amount; an unknown amount counts as one."""
    return rows.groupBy(*keys).agg(F.coalesce(_disagree(F.col(amount)), F.lit(False)).alias("_a")).where("_a").select(*keys)


def adjacent_days(rows: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """(old, new): rows dated by the day of the comparison, old ones one day late; days without their neighbour drop out."""
    days = rows.select(day).distinct()
    new = rows.join(days.select(F.date_add(day, 1).alias(day)), day, "left_semi")
    old = rows.withColumn(day, F.date_add(day, 1)).join(days, day, "left_semi")
    return old, new


def slot_swap(old_amount: Column, new_amount: Column, old_slots: Column, new_slots: Column) -> Column:
    """A slot that shows several prices, one of which is the other side's: a display change, not a move."""
    many = (F.coalesce(F.size(old_slots), F.lit(0)) >= 2) | (F.coalesce(F.size(new_slots), F.lit(0)) >= 2)
    shown = F.coalesce(F.array_contains(old_slots, new_amount), F.lit(False)) | F.coalesce(F.array_contains(new_slots, old_amount), F.lit(False))
    return many & old_amount.isNotNull() & new_amount.isNotNull() & shown


def _paired(old: DataFrame, new: DataFrame, keys: list[str], best: Callable[[str], list[Column]]) -> DataFrame:
    """Full outer match of two sides on keys in one grouped pass: best(side) gives a side's aggregates, null where it has no row."""
    both = old.withColumn("_side", F.lit("o")).unionByName(new.withColumn("_side", F.lit("n")))
    return both.groupBy(*keys).agg(*best("o"), *best("n"))


def value_status(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, status): added, removed, changed or same, for every key of either side; one row per key and side."""
    best = lambda side: [F.max(F.when(F.col("_side") == side, F.col(value))).alias(side), F.max(F.col("_side") == side).alias(f"has_{side}")]
    pairs = _paired(old.select(*keys, value), new.select(*keys, value), keys, best)
    status = F.when(~F.col("has_o"), "added").when(~F.col("has_n"), "removed").when(~F.col("o").eqNullSafe(F.col("n")), "changed").otherwise("same")
    return pairs.select(*keys, status.alias("status"))


def plan_pairs(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer match of plausible, first-wins plans on (keys, name key), with an ambiguity flag."""
    good = lambda rows: rows.where(fp.plausible_name(F.col("name"))).select(*keys, "pos", *PLAN_FIELDS, fp.name_key(F.col("name")).alias("plan_key"))

    def best(side: str) -> list[Column]:
        own = F.col("_side") == side
        amount = F.when(own, F.col("amount"))
        unknown = F.max(own & F.col("amount").isNull())
        return [F.min_by(F.struct(*PLAN_FIELDS), F.when(own, F.col("pos"))).alias(side), F.coalesce((F.min(amount) != F.max(amount)) | ((F.count(amount) > 0) & unknown), F.lit(False)).alias(f"{side}_ambiguous")]

    pairs = _paired(good(old), good(new), [*keys, "plan_key"], best)
    return pairs.withColumn("ambiguous", F.col("o_ambiguous") | F.col("n_ambiguous")).drop("o_ambiguous", "n_ambiguous")


#: Texts shown of added and of removed features.
SHOWN_FEATURES = 15


def only_in(a: Column, b: Column, most: int | None = None) -> Column:
    """Distinct elements of a that b lacks, sorted; the first `most` where given. Null arrays are empty."""
    empty = F.expr("cast(array() as array<string>)")
    out = F.array_sort(F.array_except(F.coalesce(a, empty), F.coalesce(b, empty)))
    return out if most is None else F.slice(out, 1, most)


def same_numbers(a: Column, b: Column) -> Column:
    """Two arrays hold the same known numbers equally often, in whatever order."""
    known = lambda x: F.array_sort(F.filter(x, lambda v: v.isNotNull()))
    return known(a) == known(b)


def plan_event_type(ambiguous: Column) -> Column:
    """The first guard that speaks, for a pair of plan structs o and n; null if nothing moved."""
    o, n = F.col("o"), F.col("n")
    moved = ~o["amount"].eqNullSafe(n["amount"])
    return (
        F.when(o.isNull(), "plan_added")
        .when(n.isNull(), "plan_removed")
        .when(o["currency"] != n["currency"], "currency_changed")
        .when(o["period"] != n["period"], "period_changed")
        .when(moved & ambiguous, "plan_name_ambiguous")
        .when(moved & slot_swap(o["amount"], n["amount"], o["slot_prices"], n["slot_prices"]), "price_display_changed")
        .when(moved, "price_changed")
        .when(~o["period"].eqNullSafe(n["period"]), "period_changed")
    )


def plan_events(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """One row per event of a pair: the cascade's verdict, and independently a change of features."""
    o, n = F.col("o"), F.col("n")
    kind = F.col("type")
    typed = pairs.withColumn("type", plan_event_type(F.col("ambiguous")))
    both = o.isNotNull() & n.isNotNull()
    priced = kind.isin("price_changed", "currency_changed", "plan_name_ambiguous", "price_display_changed") | (kind.eqNullSafe("period_changed") & (o["period"] != n["period"]))
    only = lambda cond, c: F.when(cond, c)
    single = F.coalesce(n, o)
    alone = ~both
    cascade = typed.where(kind.isNotNull()).select(
        *keys,
        "type",
        F.coalesce(n["name"], o["name"]).alias("plan"),
        only(alone, single["price_raw"]).alias("price"),
        only(alone, single["amount"]).alias("amount"),
        only(alone, single["period"]).alias("period"),
        only(priced, o["amount"]).alias("from_amount"),
        only(priced, n["amount"]).alias("to_amount"),
        only(priced, o["price_raw"]).alias("from_raw"),
        only(priced, n["price_raw"]).alias("to_raw"),
        only(priced, o["currency"]).alias("from_currency"),
        only(priced, n["currency"]).alias("to_currency"),
        F.when(kind == "currency_changed", o["currency"]).when((kind == "period_changed"), o["period"]).alias("from_value"),
        F.when(kind == "currency_changed", n["currency"]).when((kind == "period_changed"), n["period"]).alias("to_value"),
        only(kind == "price_changed", fp.pct_change(o["amount"], n["amount"])).alias("pct_change"),
        only(kind == "price_changed", fp.direction(o["amount"], n["amount"])).alias("direction"),
        only(kind == "price_display_changed", o["slot_prices"]).alias("slot_before"),
        only(kind == "price_display_changed", n["slot_prices"]).alias("slot_after"),
        F.lit(None).cast("array<string>").alias("added"),
        F.lit(None).cast("array<string>").alias("removed"),
    )
    added, removed = (only_in(x["features"], y["features"], SHOWN_FEATURES) for x, y in ((n, o), (o, n)))
    features = pairs.where(both).select(*keys, F.lit("features_changed").alias("type"), n["name"].alias("plan"), added.alias("added"), removed.alias("removed")).where("size(added) + size(removed) > 0")
    return cascade.unionByName(features, allowMissingColumns=True)


def relabel(events: DataFrame, extractor_differs: str, locale_shifts: str) -> DataFrame:
    """Price moves under another extractor, then under another locale, are not moves."""
    t = F.col("type")
    moved = t == "price_changed"
    return events.withColumn("type", F.when(moved & F.col(extractor_differs), "extractor_changed").when(moved & F.col(locale_shifts), "locale_changed").otherwise(t))


def locale_shift(old_hints: Column, new_hints: Column) -> Column:
    """The sides name different foreign currencies; off only if neither side names any."""
    empty = F.expr("cast(array() as array<string>)")
    a, b = F.coalesce(old_hints, empty), F.coalesce(new_hints, empty)
    differ = F.array_union(F.array_except(a, b), F.array_except(b, a))
    foreign = F.array(*[F.lit(x) for x in P.FOREIGN])
    return ((F.size(a) > 0) | (F.size(b) > 0)) & F.arrays_overlap(differ, foreign)


def model_events(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Model rows (keys, pos, key, model, prices map, unit) matched on key; later rows of a key win.

    Only labels that both sides have are compared; if the multiset of a row's numbers is the same, the
    columns were renamed and nothing moved.
    """
    fields = ["model", "prices", "unit"]
    best = lambda side: [F.max_by(F.struct(*fields), F.when(F.col("_side") == side, F.col("pos"))).alias(side)]
    pairs = _paired(*(rows.select(*keys, "key", "pos", *fields) for rows in (old, new)), [*keys, "key"], best)
    o, n = F.col("o"), F.col("n")
    numbers = lambda m: F.transform(F.map_values(m), lambda v: v["amount"])
    labels = F.array_sort(F.array_intersect(F.map_keys(o["prices"]), F.map_keys(n["prices"])))
    # try_element_at, not lambda capture: labels are known to be on both sides
    changes = F.transform(
        labels,
        lambda k: F.struct(
            k.alias("field"),
            F.try_element_at(o["prices"], k).alias("from"),
            F.try_element_at(n["prices"], k).alias("to"),
            fp.pct_change(F.try_element_at(o["prices"], k)["amount"], F.try_element_at(n["prices"], k)["amount"]).alias("pct_change"),
            fp.direction(F.try_element_at(o["prices"], k)["amount"], F.try_element_at(n["prices"], k)["amount"]).alias("direction"),
        ),
    )
    changes = F.filter(changes, lambda c: ~c["from"]["amount"].eqNullSafe(c["to"]["amount"]))
    typed = pairs.withColumn("changes", F.when(o.isNotNull() & n.isNotNull(), changes))
    kind = F.when(o.isNull(), "model_added").when(n.isNull(), "model_removed").when(F.size("changes") > 0, F.when(same_numbers(numbers(o["prices"]), numbers(n["prices"])), "model_price_relabeled").otherwise("model_price_changed"))
    return typed.withColumn("type", kind).where("type IS NOT NULL").select(*keys, "type", F.coalesce(n["model"], o["model"]).alias("model"), n["unit"].alias("unit"), F.when(F.col("changes").isNull(), F.coalesce(n["prices"], o["prices"])).alias("prices"), "changes")


def fingerprint(plans: Column, models: Column) -> Column:
    """Order-insensitive digest of (name, amount, currency, period) rows and model rows; null sorts stay stable."""
    p = F.coalesce(F.array_sort(F.transform(plans, lambda x: F.struct(x["name"].alias("name"), x["amount"].alias("amount"), x["currency"].alias("currency"), x["period"].alias("period")))), F.expr("cast(array() as array<struct<name: string, amount: double, currency: string, period: string>>)"))
    m = F.coalesce(F.array_sort(F.transform(models, lambda x: F.to_json(F.struct(x["key"].alias("key"), F.array_sort(F.transform(F.map_entries(x["prices"]), lambda e: F.to_json(e))).alias("prices"))))), F.expr("cast(array() as array<string>)"))
    return F.sha2(F.to_json(F.struct(p.alias("plans"), m.alias("models"))), 256)


def change_kind(old_missing: Column, same_content: Column, parser_differs: Column, n_moves: Column, n_catalog: Column, n_plan: Column) -> Column:
    """Kind of a page's change from the counts of its events; null if nothing changed."""
    return (
        F.when(old_missing, "first_seen")
        .when(same_content, F.lit(None))
        .when(parser_differs, "parser_upgrade")
        .when(n_moves > 0, "price_change")
        .when(n_catalog > 0, "catalog_change")
        .when(n_plan > 0, "plan_detail_change")
        .otherwise("page_change")
    )


def with_previous(rows: DataFrame, keys: list[str], order: str, cols: list[str]) -> DataFrame:
    """Each observation beside the previous one of its key; prev_* are null at the first."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.select("*", *[F.lag(c).over(w).alias(f"prev_{c}") for c in cols])


def asof_previous(left: DataFrame, right: DataFrame, keys: list[str], time: str, cols: list[str]) -> DataFrame:
    """Each left row with the right row of its key that is the latest strictly before it.

    Both sides are laid along one timeline per key and the last right row is carried forward, so nothing
    is paired off: one shuffle and one sort, whatever the number of rows of a key.
    """
    carried = F.struct(*cols)
    both = left.select("*", F.lit(1).alias("_left"), F.lit(None).cast(right.select(carried.alias("s")).schema["s"].dataType).alias("_r"))
    other = right.select(*keys, time, F.lit(0).alias("_left"), carried.alias("_r"))
    line = both.unionByName(other, allowMissingColumns=True)
    # a row at the same time is not before: left rows sort first, and ties among right rows keep the last
    w = Window.partitionBy(*keys).orderBy(F.col(time), F.col("_left").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = line.withColumn("_p", F.last("_r", ignorenulls=True).over(w)).where("_left = 1")
    return found.select(*left.columns, *[F.col("_p")[c].alias(f"prev_{c}") for c in cols])


def compare_snapshots(old: DataFrame, new: DataFrame) -> DataFrame:
    """Nested snapshots of two dates -> one change row per page that changed.

    Columns: slug, kind, plan_events, model_events, text_diff counts, hashes, parser versions. Only pages
    whose content differs reach the joins of plans and models.
    """
    keep = ["slug", "content_hash", "parser_version", "extractor", "currency_hints", "plans", "models", "text"]
    a = old.select(*[F.col(c).alias(f"o_{c}") if c != "slug" else F.col(c) for c in keep])
    b = new.select(*[F.col(c).alias(f"n_{c}") if c != "slug" else F.col(c) for c in keep])
    page = b.join(a.withColumn("had", F.lit(True)), "slug", "left")
    same = F.col("o_content_hash").eqNullSafe(F.col("n_content_hash")) & (fingerprint(F.col("o_plans"), F.col("o_models")) == fingerprint(F.col("n_plans"), F.col("n_models")))
    page = page.select("*", F.col("had").isNull().alias("old_missing"), (F.col("had").isNotNull() & same).alias("same_content")).where(~F.col("same_content"))
    page = page.withColumn("parser_differs", ~F.coalesce("o_parser_version", "n_parser_version").eqNullSafe(F.col("n_parser_version")))
    page = page.withColumn("extractor_differs", F.coalesce(F.col("o_extractor") != F.col("n_extractor"), F.lit(False))).withColumn("locale_shifts", locale_shift(F.col("o_currency_hints"), F.col("n_currency_hints")))
    seen = page.where(~F.col("old_missing"))
    rows = lambda c: seen.select("slug", F.posexplode(c).alias("pos", "x")).select("slug", "pos", "x.*")
    ev = plan_events(plan_pairs(rows("o_plans"), rows("n_plans"), ["slug"]), ["slug"])
    ev = relabel(ev.join(seen.select("slug", "extractor_differs", "locale_shifts"), "slug"), "extractor_differs", "locale_shifts").drop("extractor_differs", "locale_shifts")
    based = seen.where("o_models IS NOT NULL")
    rows_b = lambda c: based.select("slug", F.posexplode(c).alias("pos", "x")).select("slug", "pos", "x.*")
    mev = model_events(rows_b("o_models"), rows_b("n_models"), ["slug"])
    pl = ev.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct(*[c for c in ev.columns if c != "slug"]))).alias("plan_events"), F.count_if(F.col("type") == "price_changed").alias("p_moves"), F.count_if(F.col("type").isin("plan_added", "plan_removed")).alias("p_cat"), F.count(F.lit(1)).alias("p_all"))
    ml = mev.groupBy("slug").agg(F.collect_list(F.struct("type", "model", "unit", "prices", "changes")).alias("model_events"), F.count_if(F.col("type") == "model_price_changed").alias("m_moves"), F.count_if(F.col("type").isin("model_added", "model_removed")).alias("m_cat"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = page.join(pl, "slug", "left").join(ml, "slug", "left")
    kind = change_kind(F.col("old_missing"), F.lit(False), F.col("parser_differs"), z("p_moves") + z("m_moves"), z("p_cat") + z("m_cat"), z("p_all"))
    old_text = F.when(F.col("old_missing"), "").otherwise(F.col("o_text"))
    diff = line_diff(old_text, F.when(F.col("old_missing"), "").otherwise(F.col("n_text")))
    return out.select("slug", kind.alias("kind"), "plan_events", "model_events", F.when(~F.col("old_missing"), diff).alias("text_diff"), F.col("o_content_hash").alias("content_hash_before"), F.col("n_content_hash").alias("content_hash_after"), F.col("n_extractor").alias("extractor"), F.col("o_parser_version").alias("parser_version_from"), F.col("n_parser_version").alias("parser_version_to"))
