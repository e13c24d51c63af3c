"""Run control: which targets a run fetches, what it logged, and whether coverage holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import fetch_key, host


def with_defaults(items: DataFrame, defaults: dict) -> DataFrame:
    """Fill missing fields of a target list."""
    return items.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in items.columns])


def repeated_slugs(targets: DataFrame) -> DataFrame:
    return targets.groupBy("slug").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def only_slugs(targets: DataFrame, slugs: list[str]) -> DataFrame:
    """The targets named; a name that no target has is an error."""
    wanted = targets.sparkSession.createDataFrame([(s,) for s in slugs], "slug string")
    unknown = wanted.join(targets, "slug", "left_anti").limit(20).collect()
    if unknown:
        raise ValueError("unknown targets: " + ", ".join(sorted(r.slug for r in unknown)))
    return targets.where(F.col("slug").isin(slugs))


def first_by_url(targets: DataFrame, seq: str = "seq", url: str = "url") -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): one request per page; dropped rows carry the slug that is fetched instead."""
    keyed = targets.withColumn("fetch_key", fetch_key(F.col(url)))
    first = keyed.groupBy("fetch_key").agg(F.min(seq).alias("_first"), F.min_by("slug", seq).alias("kept_slug"))
    both = keyed.join(first, "fetch_key")
    return both.where(F.col(seq) == F.col("_first")).drop("_first", "kept_slug"), both.where(F.col(seq) > F.col("_first")).select("slug", "kept_slug", "fetch_key")


def duplicate_pages(targets: DataFrame) -> DataFrame:
    return targets.groupBy(fetch_key(F.col("url")).alias("fetch_key")).agg(F.array_sort(F.collect_list("slug")).alias("slugs")).where("size(slugs) > 1")


def refused(status: Column, http_status: Column) -> Column:
    """A client error is final for the day; network and server errors may be tried again."""
    return (status == "http_error") & http_status.between(400, 499)


def not_done(targets: DataFrame, today: DataFrame, force: bool = False) -> DataFrame:
    """Targets without a final entry for the day: once a day, dry runs aside."""
    if force:
        return targets
    done = today.where(~F.coalesce("dry_run", F.lit(False))).where((F.col("status") == "ok") | refused(F.col("status"), F.col("http_status")))
    return targets.join(done.select("slug").distinct(), "slug", "left_anti")


def limit_targets(targets: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    return targets.orderBy(seq).limit(n)


def merge_run_log(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old entries and new ones; a key's new entry wins as a whole."""
    o, n = old.withColumn("_new", F.lit(0)), new.withColumn("_new", F.lit(1))
    rest = [c for c in old.columns if c not in keys]
    return o.unionByName(n).groupBy(*keys).agg(F.max_by(F.struct(*rest), "_new").alias("_e")).select(*keys, "_e.*")


def run_summary(entries: DataFrame, by: list[str]) -> DataFrame:
    """Totals and a sorted map of statuses for each run."""
    counts = entries.groupBy(*by, "status").agg(F.count(F.lit(1)).alias("n"), F.count_if("changed").alias("c"))
    return counts.groupBy(*by).agg(F.sum("n").alias("total"), F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("n"))), F.lit(0)).alias("ok"), F.sum("c").alias("changed"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("by_status"))


def trailing_windows(days: DataFrame, n: int, date: str = "date") -> DataFrame:
    """Each run day's window: 1 for the last n run days, 2 for the n before; run days, not calendar days."""
    w = Window.orderBy(F.desc(date))
    return days.select(date).distinct().select(date, F.ceil(F.row_number().over(w) / n).cast("int").alias("win")).where("win <= 2")


def coverage_audit(runs: DataFrame, keys: list[str], rows: Column, n: int, date: str = "date") -> DataFrame:
    """Peak rows of each key in two trailing windows, and what became of it."""
    wins = F.broadcast(trailing_windows(runs.select(date), n, date))  # 2n rows at most
    peak = lambda w: F.coalesce(F.max(F.when(F.col("win") == w, rows)), F.lit(0))
    got = runs.join(wins, date, "left").groupBy(*keys).agg(peak(2).alias("before"), peak(1).alias("after"))
    return got.withColumn("verdict", coverage_verdict(F.col("before"), F.col("after")))


def coverage_verdict(before: Column, after: Column) -> Column:
    return (
        F.when((before == 0) & (after == 0), "zero")
        .when((before > 0) & (after == 0), "vanished")
        .when(2 * after < before, "shrunk")
        .when(after > F.greatest(2 * before, F.lit(1)), "grew")
        .otherwise("stable")
    )


def diagnosis(thin: Column, rendered: Column, n_plans: Column, n_tables: Column) -> Column:
    """Why a page yields little; empty if it does not."""
    return (
        F.when(thin & ~rendered, "thin: try rendering")
        .when(thin, "thin even when rendered")
        .when((n_plans == 0) & (n_tables == 0), "no plans, no tables")
        .when(n_plans == 0, "no plans")
        .when(n_plans == 1, "one plan")
        .otherwise("")
    )


def validator_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(F.col("diagnosis") == "").alias("ok"), F.count_if(F.col("diagnosis") != "").alias("bad"), F.count_if("thin").alias("thin"))


def by_host(targets: DataFrame, url: str = "url") -> DataFrame:
    """Targets dealt out so that a host's pages meet in one task, where they are fetched one after another."""
    return targets.withColumn("host", host(F.col(url))).repartition("host")
def run_lists(entries: DataFrame) -> DataFrame:
    """Entries that need a look, each with every reason that holds: failed, weak (low or no confidence), thin, reparsed."""
    rules = {
        "failed": F.col("status") != "ok",
        "weak": (F.col("status") == "ok") & F.col("confidence").isin("low", "none"),
        "thin": F.coalesce("thin", F.lit(False)),
        "reparsed": F.col("change_kind") == "parser_upgrade",
    }
    reason = F.explode(F.filter(F.array(*[F.when(F.coalesce(test, F.lit(False)), name) for name, test in rules.items()]), lambda x: x.isNotNull()))
    return entries.select("date", "slug", reason.alias("reason"))
