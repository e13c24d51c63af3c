"""Jobs over the engine: the daily run, the report build, the gate and the target check, as functions and as a command line.

    python -m tidemark.jobs daily TARGETS ROOT [--date D] [--only SLUG ...] [--limit N] [--force] [--dry-run] [--no-raw]
    python -m tidemark.jobs reports TARGETS ROOT SITE
    python -m tidemark.jobs gate TARGETS ROOT [--threshold N]
    python -m tidemark.jobs check TARGETS ROOT

ROOT holds the tables snapshots, changes, runs, raw and (JSON lines) corrections. The day is an argument: no
operator reads a clock.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as ft
from .operators import changes as ch
from .operators import document, reports, runs
from .sources import archive, sinks
from .streaming.snapshots import read_or_none

PARSER_VERSION = 1
AGENT = "tidemark"


@dataclass(frozen=True)
class Switches:
    only: tuple[str, ...] = ()
    limit: int | None = None
    #: Fetch what the day has already.
    force: bool = False
    #: Compare and log, but write neither snapshots nor changes.
    dry_run: bool = False
    #: Keep no raw pages.
    no_raw: bool = False


def today_utc() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")


def _or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    got = read_or_none(spark, path)
    return spark.createDataFrame([], schema) if got is None else got


def due_targets(targets: DataFrame, entries: DataFrame, day: str, switches: Switches) -> DataFrame:
    """Enabled targets, one for each page, that the day has no final entry of."""
    due = targets.where("enabled")
    if switches.only:
        due = runs.only_slugs(due, list(switches.only))
    due, _ = runs.first_by_url(due)
    due = runs.not_done(due, entries.where(F.col("date") == F.lit(day).cast("date")), switches.force)
    return due if switches.limit is None else runs.limit_targets(due, switches.limit)


def daily(spark: SparkSession, targets: DataFrame, root: str, day: str, get=None, robots: DataFrame | None = None, switches: Switches = Switches(), interval_s: float = 6.0) -> DataFrame:
    """Fetch, extract, compare, write; returns the day's run entries. Pages are written before anything is derived from them."""
    entries = _or_empty(spark, f"{root}/runs", archive.RUNS)
    due = due_targets(targets, entries, day, switches)
    if robots is not None:
        judged = archive.allowed_by_robots(due, robots, AGENT)
        due, refused = judged.where("allowed"), judged.where("NOT allowed")
    landed = f"{root}/landed/date={day}"
    archive.fetch_pages(due, get or archive.http_get(AGENT), interval_s).write.mode("overwrite").parquet(landed)
    pages = spark.read.parquet(landed)
    snaps = document.extract_pages(pages.where("status = 'ok'"), ["slug"], "html", "slug").join(pages.select("slug", ft.content_hash(F.col("html")).alias("raw_hash")), "slug")
    snaps = document.snapshot_rows(snaps.withColumn("final_url", F.lit(None).cast("string")), targets, F.lit(day), PARSER_VERSION)
    before = archive.current_of(_or_empty(spark, f"{root}/snapshots", archive.SNAPSHOT).where(F.col("obs_date") <= F.lit(day).cast("date")))
    archive.check_contract(before)
    # written first: the state that it is compared with is about to change
    staged = f"{root}/staged/date={day}"
    about = snaps.select("slug", "name", "vendor", "category", "url", "confidence")
    found = ch.compare_snapshots(before, snaps).join(about, "slug").withColumn("date", F.lit(day).cast("date")).withColumn("observed_at", F.lit(day).cast("timestamp"))
    found.write.mode("overwrite").parquet(staged)
    found = spark.read.parquet(staged)
    kinds = found.select("slug", F.col("kind").alias("change_kind"))
    counted = snaps.select("slug", "content_hash", "extractor", "confidence", F.size("plans").alias("plans_count"), F.size("models").alias("models_count"), F.size("tables").alias("tables_count"), (F.col("text_bytes") < 500).alias("thin"), "extract_errors")
    log = pages.select("slug", "status", "http_status", "elapsed_ms").join(counted, "slug", "left").join(kinds, "slug", "left").join(targets.select("slug", "name", "url"), "slug")
    log = log.withColumns({"date": F.lit(day).cast("date"), "changed": F.col("change_kind").isNotNull(), "dry_run": F.lit(switches.dry_run), "robots_note": F.lit(None).cast("string"), "reason": F.lit(None).cast("string")})
    if robots is not None:
        barred = refused.select("slug", F.lit("skipped_robots").alias("status"), "name", "url", F.lit(day).cast("date").alias("date"), F.lit(False).alias("changed"), F.lit(switches.dry_run).alias("dry_run"), F.lit("disallowed").alias("robots_note"))
        log = log.unionByName(barred, allowMissingColumns=True)
    kept = [c.split()[0] for c in archive.RUNS.split(", ")]
    log = log.select(*kept)
    if not switches.dry_run:
        if not switches.no_raw:
            html = document.extract_pages(pages.where("status = 'ok'"), ["slug"], "html", "slug").select("slug", "archive_html")
            sinks.raw_snapshots(html, found.where("kind IS NOT NULL"), ["slug"]).withColumn("date", F.lit(day).cast("date")).write.mode("append").partitionBy("date").parquet(f"{root}/raw")
        sinks.append_by_date(found, f"{root}/changes")
        day_rows = _or_empty(spark, f"{root}/snapshots", archive.SNAPSHOT).where(F.col("obs_date") == F.lit(day).cast("date"))
        kept_rows = day_rows.join(snaps.select("slug"), "slug", "left_anti").select(snaps.columns)
        merged = f"{root}/staged/snapshots-{day}"
        kept_rows.unionByName(snaps).write.mode("overwrite").parquet(merged)
        sinks.upsert_day(spark.read.parquet(merged), f"{root}/snapshots", "obs_date")
    merged = f"{root}/staged/runs-{day}"
    runs.merge_run_log(entries.where(F.col("date") == F.lit(day).cast("date")).select(kept), log, ["date", "slug"]).write.mode("overwrite").parquet(merged)
    sinks.upsert_day(spark.read.parquet(merged), f"{root}/runs")
    return spark.read.parquet(f"{root}/runs").where(F.col("date") == F.lit(day).cast("date")).orderBy("slug")


def summary_lines(entries: DataFrame) -> DataFrame:
    """key=value lines of a day's run, and a Markdown row for each entry that needs a look."""
    total = runs.run_summary(entries, ["date"]).select("date", "total", "ok", "changed", F.to_json("by_status").alias("by_status"))
    look = runs.run_lists(entries).select(sinks.markdown_row([F.col("slug"), F.col("reason")]).alias("line"))
    return sinks.key_values(total).union(look)


def _changes(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    log = _or_empty(spark, f"{root}/changes", archive.CHANGES).withColumn("seq", F.xxhash64("date", "slug", "observed_at"))
    try:
        fixes = archive.read_corrections(spark, f"{root}/corrections.jsonl")
        fixes.schema  # noqa: B018  # a missing file shows here
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        fixes = spark.createDataFrame([], archive.CORRECTIONS)
    return log, fixes


def gate(spark: SparkSession, targets: DataFrame, root: str, special: str = "gpu-rental", threshold: int = 500) -> DataFrame:
    """One row: the layers' counts, what corrections took, the days, and whether each layer reaches the threshold."""
    log, fixes = _changes(spark, root)
    good = reports.counted(log, fixes)
    n = lambda plans, models: reports.moved_numbers(plans, models)
    no_plans, no_models = (F.expr(f"cast(null AS {dict(log.dtypes)[c]})") for c in ("plan_events", "model_events"))
    rows = good.select((F.col("category") == special).alias("special"), n(F.col("plan_events"), no_models).alias("plan_moves"), n(no_plans, F.col("model_events")).alias("model_moves"))
    one = reports.gate_layers(rows, "special").crossJoin(reports.dropped_counts(log, fixes)).crossJoin(reports.day_span(log))  # one row each
    return one.withColumns({f"{c}_verdict": reports.gate_verdict(F.col(f"{c}_numbers"), F.col("days"), threshold) for c in ("plan", "row", "special")})


def check_targets(spark: SparkSession, targets: DataFrame, root: str) -> DataFrame:
    """(slug, diagnosis) of the latest record of each enabled target that has one; empty text if nothing is wrong."""
    now = archive.current_of(_or_empty(spark, f"{root}/snapshots", archive.SNAPSHOT))
    rows = targets.where("enabled").select("slug", "render").join(now, "slug")
    return rows.select("slug", (F.col("text_bytes") < 500).alias("thin"), runs.diagnosis(F.col("text_bytes") < 500, F.col("render") == "js", F.size("plans"), F.size("tables")).alias("diagnosis"))


def build_reports(spark: SparkSession, targets: DataFrame, root: str, site: str, base_url: str = "https://example.org") -> DataFrame:
    """Write the site's files under site; returns the stale ones. Derived from the log and the state alone."""
    log, fixes = _changes(spark, root)
    moves = reports.moves(reports.counted(log, fixes))
    who = targets.select("slug", "name")
    files = sinks.tool_pages(reports.with_history(who, moves.select("slug", "date", "item", "seq", "from", "to", "pct")))
    files = files.union(sinks.month_page_files(moves)).union(sinks.index_page(targets, moves, "Price moves"))
    feed = sinks.rss(reports.feed(moves), "Price moves", "Moves of watched prices", base_url).select(F.lit("feed.xml").alias("path"), F.col("xml").alias("html"))
    pages = moves.groupBy(F.concat(F.lit("t/"), "slug", F.lit(".html")).alias("path")).agg(F.max("date").alias("lastmod"))
    return sinks.write_files(files.union(feed).union(sinks.sitemap_files(pages, base_url)), site)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark.jobs")
    p.add_argument("job", choices=["daily", "reports", "gate", "check"])
    p.add_argument("targets")
    p.add_argument("root")
    p.add_argument("site", nargs="?")
    p.add_argument("--date", default=None)
    p.add_argument("--only", nargs="*", default=[])
    p.add_argument("--limit", type=int)
    p.add_argument("--threshold", type=int, default=500)
    for flag in ("--force", "--dry-run", "--no-raw"):
        p.add_argument(flag, action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"tidemark-{a.job}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    targets = archive.read_targets(spark, a.targets)
    if a.job == "daily":
        log = daily(spark, targets, a.root, a.date or today_utc(), switches=Switches(tuple(a.only), a.limit, a.force, a.dry_run, a.no_raw))
        out = summary_lines(log)
    elif a.job == "reports":
        out = build_reports(spark, targets, a.root, a.site)
    elif a.job == "gate":
        out = sinks.key_values(gate(spark, targets, a.root, threshold=a.threshold))
    else:
        out = check_targets(spark, targets, a.root).where("diagnosis <> ''").select(sinks.markdown_row([F.col("slug"), F.col("diagnosis")]).alias("line"))
    for row in out.toLocalIterator():
        print(row[0])
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
