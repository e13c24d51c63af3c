"""Reports over the change log: which moves count, rollups, top-k, windows, feeds.

Inputs: changes (date, slug, name, vendor, category, kind, plan_events, model_events, seq) and flat moves
(date, slug, item, ..., seq). seq is the row's place in the log and breaks every tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import price as fp


# --- which changes count -------------------------------------------------------------------------------
def correction_keys(corrections: DataFrame) -> DataFrame:
    return corrections.select("date", "slug", F.coalesce("kind", F.lit("price_change")).alias("kind")).where("date IS NOT NULL AND slug IS NOT NULL").distinct()


def counted(changes: DataFrame, corrections: DataFrame) -> DataFrame:
    """Changes that are no reparse and are not retracted: an anti-join on the retraction log at read time."""
    gone = correction_keys(corrections).where("kind = 'price_change'").select("date", "slug")
    return changes.where(~F.col("kind").eqNullSafe("parser_upgrade")).join(gone, ["date", "slug"], "left_anti")


def retracted(changes: DataFrame, corrections: DataFrame) -> DataFrame:
    gone = correction_keys(corrections).where("kind = 'price_change'").select("date", "slug")
    return changes.join(gone, ["date", "slug"], "left_semi")


def moved_numbers(plan_events: Column, model_events: Column) -> Column:
    """How many numbers an entry moved: its price changes, and every changed column of its model rows."""
    plans = F.coalesce(F.size(F.filter(plan_events, lambda e: e["type"] == "price_changed")), F.lit(0))
    models = F.aggregate(F.filter(model_events, lambda e: e["type"] == "model_price_changed"), F.lit(0), lambda n, e: n + F.size(e["changes"]))
    return F.greatest(plans, F.lit(0)) + F.coalesce(models, F.lit(0))


def moves(changes: DataFrame) -> DataFrame:
    """One row per moved number: plan moves as shown money, model moves with their column in the item."""
    base = ["date", "slug", "name", "vendor", "category", "seq"]
    plans = changes.select(*base, F.explode("plan_events").alias("e")).where("e.type = 'price_changed'")
    plans = plans.select(*base, F.col("e.plan").alias("item"), fp.money(F.col("e.from_raw"), F.col("e.from_currency")).alias("from"), fp.money(F.col("e.to_raw"), F.col("e.to_currency")).alias("to"), F.col("e.pct_change").alias("pct"))
    models = changes.select(*base, F.explode("model_events").alias("e")).where("e.type = 'model_price_changed'").select(*base, F.col("e.model").alias("model"), F.posexplode("e.changes").alias("n", "c"))
    models = models.select(*base, fp.model_item(F.col("model"), F.col("c.field")).alias("item"), F.col("c.from.raw").alias("from"), F.col("c.to.raw").alias("to"), F.col("c.pct_change").alias("pct"))
    return plans.unionByName(models)


def last_moves(rows: DataFrame, keys: list[str], date: str = "date", seq: str = "seq") -> DataFrame:
    """The latest move of each key; a grouped maximum, so no key's rows are sorted in one task."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(date, seq)).alias("_m")).select(*keys, "_m.*")


def drop_twins(rows: DataFrame, keys: list[str], item: str = "item", seq: str = "seq") -> DataFrame:
    """Of rows equal but for a labelled item, the labelled one, at the first one's place."""
    labelled = F.contains(F.col(item), F.lit(" · "))
    rest = [c for c in rows.columns if c not in [*keys, seq]]
    best = F.min_by(F.struct(*rest), F.struct((~labelled).cast("int"), F.col(seq)))
    return rows.groupBy(*keys).agg(best.alias("_b"), F.min(seq).alias(seq)).select(*keys, "_b.*", seq)


# --- gates ---------------------------------------------------------------------------------------------
def gate_layers(entries: DataFrame, special: str) -> DataFrame:
    """Page-days and numbers of three layers that are never added: plans, per-row prices, and the special class.

    entries: is_<special> boolean, plan_moves int, model_moves int, one row per page and day.
    """
    soft, s = ~F.col(special), F.col(special)
    n = F.col("plan_moves") + F.col("model_moves")
    return entries.agg(
        F.count_if(soft & (F.col("plan_moves") > 0)).alias("plan_page_days"),
        F.count_if(soft & (F.col("model_moves") > 0)).alias("row_page_days"),
        F.count_if(s & (n > 0)).alias("special_page_days"),
        F.coalesce(F.sum(F.when(soft, F.col("plan_moves"))), F.lit(0)).alias("plan_numbers"),
        F.coalesce(F.sum(F.when(soft, F.col("model_moves"))), F.lit(0)).alias("row_numbers"),
        F.coalesce(F.sum(F.when(s, n)), F.lit(0)).alias("special_numbers"),
    )


def day_span(rows: DataFrame, date: str = "date") -> DataFrame:
    return rows.agg(F.min(date).alias("first_day"), F.max(date).alias("last_day"), (F.datediff(F.max(date), F.min(date)) + 1).alias("days"))


def projection(total: Column, days: Column, horizon: int = 90) -> Column:
    """Total carried on to a horizon, half to even."""
    return F.bround(total / days * horizon, 0)


def top_k(rows: DataFrame, by: list[str], k: int, order: list[Column]) -> DataFrame:
    """The k groups with most rows; ties by the given order."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *order).limit(k)


def truncate_with_rest(rows: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group and how many more it has.

    The rank stops at k (a limit per group before the sort's output), the count is a grouped sum.
    """
    total = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_all"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(total, by).withColumn("rest", F.greatest(F.col("n_all") - k, F.lit(0))).drop("n_all")


# --- calendars -----------------------------------------------------------------------------------------
def recent(rows: DataFrame, until: Column, days: int = 30, date: str = "date") -> DataFrame:
    """Rows of the last days, both ends included."""
    return rows.where((F.col(date) >= F.date_sub(until, days)) & (F.col(date) <= until))


def month_of(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def month_rollup(rows: DataFrame, date: str = "date", pct: str = "pct") -> DataFrame:
    return rows.groupBy(month_of(F.col(date)).alias("month")).agg(F.count(F.lit(1)).alias("n_moves"), F.count_distinct(F.to_date(date)).alias("n_days"), F.count_if(F.col(pct) > 0).alias("n_up"), F.count_if(F.col(pct) < 0).alias("n_down"))


def month_nav(months: DataFrame) -> DataFrame:
    """Previous and next month of each; months are few by nature, one row each."""
    w = Window.orderBy("month")
    return months.select("month", F.lag("month").over(w).alias("prev_month"), F.lead("month").over(w).alias("next_month"))


def feed(rows: DataFrame, k: int = 50) -> DataFrame:
    """Moves gathered by (date, slug) in log order, newest first."""
    item = F.struct("seq", "item", "from", "to", "pct")
    got = rows.groupBy("date", "slug").agg(F.array_sort(F.collect_list(item)).alias("g"))
    return got.select("date", "slug", F.transform("g", lambda x: F.struct(x["item"].alias("item"), x["from"].alias("from"), x["to"].alias("to"), x["pct"].alias("pct"))).alias("moves")).orderBy(F.desc("date"), F.desc("slug")).limit(k)


def overlay(rows: DataFrame, keys: list[str], seq: str, fields: list[str]) -> DataFrame:
    """Later lines of a key overwrite earlier ones field by field; a missing field leaves what was there."""
    return rows.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in fields])


def history(rows: DataFrame) -> DataFrame:
    return rows.orderBy("slug", F.desc("date"), F.desc("item"), "seq")


# --- current rates -------------------------------------------------------------------------------------
def plan_rates(targets: DataFrame, current: DataFrame, last: DataFrame, category: Column) -> DataFrame:
    """Priced plans of enabled targets of a category, each with its last move."""
    t = targets.where("enabled").where(category).select("slug", F.col("name").alias("vendor"), "url")
    rows = current.join(t, "slug").select("slug", "vendor", "url", F.explode("plans").alias("p")).where("p.amount IS NOT NULL").where(fp.plausible_name(F.col("p.name")))
    rows = rows.select("slug", "vendor", "url", F.col("p.name").alias("item"), fp.money(F.col("p.price_raw"), F.col("p.currency")).alias("price"), F.col("p.amount").alias("amount"), F.col("p.period").alias("period"), fp.period_label(F.col("p.period")).alias("unit"), F.lower(F.col("p.name")).alias("item_key"))
    return rows.join(last, ["slug", "item_key"], "left").orderBy("vendor", F.coalesce("amount", F.lit(0)).desc())


def model_rates(targets: DataFrame, current: DataFrame, last: DataFrame, category: Column) -> DataFrame:
    t = targets.where("enabled").where(category).select("slug", F.col("name").alias("vendor"), "url")
    rows = current.join(t, "slug").select("slug", "vendor", "url", F.explode("models").alias("m"))
    rows = rows.select("slug", "vendor", "url", F.col("m.model").alias("item"), fp.price_summary(F.col("m.prices")).alias("price"), F.col("m.unit").alias("unit"), F.lower(F.col("m.model")).alias("item_key"))
    return rows.join(last, ["slug", "item_key"], "left").orderBy("vendor", "item")


def latest_prices(current: DataFrame) -> DataFrame:
    """What each page lists now: plausible plans with a price, and model rows with prices."""
    plans = current.select("slug", F.explode("plans").alias("p")).where("trim(p.price_raw) <> ''").where(fp.plausible_name(F.col("p.name"))).select("slug", F.col("p.name").alias("item"), fp.money(F.col("p.price_raw"), F.col("p.currency")).alias("price"), fp.period_label(F.col("p.period")).alias("unit"))
    models = current.select("slug", F.explode("models").alias("m")).where("size(m.prices) > 0").select("slug", F.col("m.model").alias("item"), fp.price_summary(F.col("m.prices")).alias("price"), F.col("m.unit").alias("unit"))
    return plans.unionByName(models)


def tools_by_category(targets: DataFrame) -> DataFrame:
    return targets.groupBy("category").agg(F.count(F.lit(1)).alias("n_tools"), F.array_sort(F.collect_list("name")).alias("tools"))


# --- orders and attachments ----------------------------------------------------------------------------
def in_report_order(rows: DataFrame) -> DataFrame:
    """Recent and monthly rows: newest first, then by vendor downwards; ties as the log has them."""
    return rows.orderBy(F.desc("date"), F.desc("vendor"), "seq")


def corrections_in_order(corrections: DataFrame) -> DataFrame:
    return corrections.orderBy("date", "slug")


def with_history(targets: DataFrame, rows: DataFrame) -> DataFrame:
    """Each target with its moves, newest first; an empty array where it has none. A page's history is bounded by its days."""
    item = F.struct("date", "item", "seq", *[c for c in rows.columns if c not in ("date", "item", "seq", "slug")])
    got = rows.groupBy("slug").agg(F.sort_array(F.collect_list(item), asc=False).alias("history"))
    out = targets.join(got, "slug", "left")
    return out.withColumn("history", F.when(F.col("history").isNull(), F.array().cast(got.schema["history"].dataType)).otherwise(F.col("history")))


def month_pages(rows: DataFrame, corrections: DataFrame, date: str = "date") -> DataFrame:
    """Moves of each month beside the corrections of that month."""
    moved = rows.groupBy(month_of(F.col(date)).alias("month")).agg(F.count(F.lit(1)).alias("n_moves"))
    taken = corrections.groupBy(month_of(F.col("date")).alias("month")).agg(F.count(F.lit(1)).alias("n_corrections"))
    return moved.join(taken, "month", "left").withColumn("n_corrections", F.coalesce("n_corrections", F.lit(0)))


def is_hourly(period: Column) -> Column:
    """Hourly rates stand apart; an unknown period is not hourly."""
    return F.coalesce(period, F.lit("")) == "hour"


# --- totals and gates ----------------------------------------------------------------------------------
def total_moves(changes: DataFrame, corrections: DataFrame) -> DataFrame:
    """All numbers moved by the changes that count."""
    n = moved_numbers(F.col("plan_events"), F.col("model_events"))
    return counted(changes, corrections).agg(F.coalesce(F.sum(n), F.lit(0)).alias("total_moves"))


def dropped_counts(changes: DataFrame, corrections: DataFrame) -> DataFrame:
    """How many changes count, were retracted, or are reparses; a retracted reparse is a reparse."""
    gone = correction_keys(corrections).where("kind = 'price_change'").select("date", "slug", F.lit(True).alias("gone"))
    marked = changes.join(gone, ["date", "slug"], "left")
    reparsed = F.coalesce(F.col("kind") == "parser_upgrade", F.lit(False))
    out = F.coalesce("gone", F.lit(False))
    return marked.agg(F.count_if(~reparsed & ~out).alias("counted"), F.count_if(~reparsed & out).alias("retracted"), F.count_if(reparsed).alias("reparsed"))


def gate_verdict(total: Column, days: Column, threshold: int, horizon: int = 90) -> Column:
    """Whether a total, carried on to the horizon, reaches the threshold; unknown without days."""
    reach = projection(total, days, horizon)
    return F.when(days > 0, F.when(reach >= threshold, "met").otherwise("not met")).otherwise("unknown")
