"""Sources: target lists, JSON snapshots, JSON-lines logs, landed pages, robots rules, run logs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.document import MODEL, PLAN, TABLE

TARGETS = "slug string, name string, url string, vendor string, category string, render string, currency string, enabled boolean, settle_ms int, notes string, extra map<string, string>, seq int"
SNAPSHOT = f"slug string, name string, vendor string, category string, url string, final_url string, obs_date date, parser_version int, content_hash string, raw_hash string, text_bytes int, text string, currency_hints array<string>, extractor string, confidence string, plans array<{PLAN}>, models array<{MODEL}>, tables array<{TABLE}>, extract_errors array<string>"
PRICE_STRUCT = "struct<raw: string, amount: double>"
PLAN_EVENT = "struct<type: string, plan: string, price: string, amount: double, period: string, from_amount: double, to_amount: double, from_raw: string, to_raw: string, from_currency: string, to_currency: string, from_value: string, to_value: string, pct_change: double, direction: string, slot_before: array<double>, slot_after: array<double>, added: array<string>, removed: array<string>>"
MODEL_EVENT = f"struct<type: string, model: string, unit: string, prices: map<string, {PRICE_STRUCT}>, changes: array<struct<field: string, from: {PRICE_STRUCT}, to: {PRICE_STRUCT}, pct_change: double, direction: string>>>"
CHANGES = f"date date, observed_at timestamp, slug string, name string, vendor string, category string, url string, kind string, content_hash_before string, content_hash_after string, extractor string, confidence string, plan_events array<{PLAN_EVENT}>, model_events array<{MODEL_EVENT}>, text_diff struct<lines_added: int, lines_removed: int, sample_added: array<string>, sample_removed: array<string>>, parser_version_from int, parser_version_to int"
CORRECTIONS = "date string, slug string, kind string, events_excluded int, reason string, reason_en string"
RUNS = "date date, slug string, name string, url string, status string, http_status int, elapsed_ms int, robots_note string, reason string, content_hash string, extractor string, confidence string, plans_count int, models_count int, tables_count int, thin boolean, changed boolean, change_kind string, dry_run boolean, extract_errors array<string>"
#: Fields of a snapshot that comparison reads; a stored record must have them all.
COMPARED_FIELDS = ("content_hash", "parser_version", "text_bytes", "plans", "models", "currency_hints")


def check_contract(df: DataFrame, fields: tuple[str, ...] = COMPARED_FIELDS) -> None:
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"snapshot lacks {missing}")


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """A YAML target list: defaults under `defaults`, items under `targets`; unknown keys go to `extra`.

    The list is a small dimension, so it is read on the driver, through Spark's file reader.
    """
    import yaml

    doc = yaml.safe_load("".join(r.value + "\n" for r in spark.read.text(path, wholetext=True).collect())) or {}
    items = doc.get("targets", doc) if isinstance(doc, dict) else doc
    defaults = doc.get("defaults") or {} if isinstance(doc, dict) else {}
    known = ["slug", "name", "url", "vendor", "category", "render", "currency", "enabled", "settle_ms", "notes"]
    rows, seen = [], set()
    for seq, item in enumerate(items):
        full = {"enabled": True, "render": "static"} | defaults | item
        slug = full.get("slug")
        if not slug:
            raise ValueError(f"target {seq} has no slug")
        if slug in seen:
            raise ValueError(f"slug {slug} stands twice")
        seen.add(slug)
        extra = {k: str(v) for k, v in full.items() if k not in known}
        rows.append((*[full.get(k) for k in known], extra, seq))
    return spark.createDataFrame(rows, TARGETS)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines, broken ones and lines that are no object are left out."""
    rows = spark.read.schema(schema + ", _broken string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(path)
    named = [c for c in rows.columns if c != "_broken"]
    return rows.where("_broken IS NULL").where(" OR ".join(f"`{c}` IS NOT NULL" for c in named)).drop("_broken")


def read_changes(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """The change log; one date prunes to its partition where the log is partitioned."""
    rows = read_json_lines(spark, path, CHANGES)
    return rows.where(F.col("date") == F.lit(date).cast("date")) if date else rows


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """Retractions with date and slug; kind defaults to a price change; seq is the line's order, file after file by name.

    The log is edited by hand, so one task may number it.
    """
    rows = read_json_lines(spark, path, CORRECTIONS).withColumns({"_file": F.input_file_name(), "_at": F.monotonically_increasing_id()})
    rows = rows.withColumn("seq", F.row_number().over(Window.orderBy("_file", "_at")).cast("long")).drop("_file", "_at")
    return rows.where("date IS NOT NULL AND slug IS NOT NULL").withColumn("kind", F.coalesce("kind", F.lit("price_change")))


def read_commit_log(spark: SparkSession, path: str, subject: str = "") -> DataFrame:
    """(hash, committed_at, subject) of an exported commit log: a line each, fields parted by NUL; lines of another shape are left out.

    subject: a pattern that subjects must match; the latest row by committed_at is the last snapshot.
    """
    parts = F.split("value", "\u0000")
    rows = spark.read.text(path).where(F.size(parts) == 3).select(parts[0].alias("hash"), F.try_to_timestamp(parts[1]).alias("committed_at"), parts[2].alias("subject"))
    return rows.where(F.col("subject").rlike(subject)) if subject else rows


def read_current(spark: SparkSession, json_path: str, text_path: str | None = None) -> DataFrame:
    """Latest records, one multi-line JSON file each, named by slug; their texts beside them."""
    slug = F.regexp_extract(F.input_file_name(), "([^/]+)\\.[a-z]+$", 1)
    rec = spark.read.schema(SNAPSHOT.replace("text string, ", "", 1)).option("multiLine", True).json(json_path).withColumn("slug", slug)
    if not text_path:
        return rec.withColumn("text", F.lit(None).cast("string"))
    texts = spark.read.text(text_path, wholetext=True).select(slug.alias("slug"), F.col("value").alias("text"))
    return rec.join(texts, "slug", "left")


def current_of(snapshots: DataFrame, until: str | None = None, order: tuple[str, ...] = ("obs_date",)) -> DataFrame:
    """The latest snapshot of each slug: state as a view over the dated table."""
    rows = snapshots.where(F.col("obs_date") <= F.lit(until).cast("date")) if until else snapshots
    rest = [c for c in rows.columns if c != "slug"]
    return rows.groupBy("slug").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_s")).select("slug", "_s.*")


def previous_of(snapshots: DataFrame, date: str) -> DataFrame:
    return current_of(snapshots.where(F.col("obs_date") < F.lit(date).cast("date")))


def latest_run(runs: DataFrame) -> DataFrame:
    last = runs.agg(F.max("date").alias("d"))
    return runs.join(F.broadcast(last), runs.date == last.d, "left_semi")  # one row


def last_recorded_day(runs: DataFrame, changes: DataFrame) -> DataFrame:
    """The last run's date, else the last change's."""
    return runs.agg(F.max("date").alias("r")).crossJoin(changes.agg(F.max("date").alias("c"))).select(F.coalesce("r", "c").alias("last_day"))  # one row each


def json_ld_blocks(pages: DataFrame, id_cols: list[str], html_col: str = "html") -> DataFrame:
    """One row per JSON-LD block that parses, as a variant value."""
    block = F.regexp_extract_all(html_col, F.lit("(?is)<script[^>]+type=[\"']application/ld\\+json[\"'][^>]*>(.*?)</script>"), F.lit(1))
    rows = pages.select(*id_cols, F.posexplode(block).alias("block", "json"))
    return rows.withColumn("value", F.try_parse_json(F.trim("json"))).where("value IS NOT NULL").drop("json")


def allowed_by_robots(urls: DataFrame, robots: DataFrame, agent: str, url_col: str = "url") -> DataFrame:
    """Join each URL with its host's robots answer (host, http_status, body): allowed, and the crawl delay.

    A server error or an unreadable answer denies; a client error allows. Both the agent and `*` must be allowed.
    """
    from ..functions.urls import host

    kinds, named = dict(urls.dtypes), list(urls.columns)
    joined = urls.withColumn("host", host(F.col(url_col))).join(robots.select("host", "http_status", "body"), "host", "left")
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in urls.columns) + ", allowed boolean, crawl_delay double"

    def judge(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.robotparser import RobotFileParser

        cache: dict = {}
        for pdf in it:
            allowed, delay = [], []
            for h, s, body, url in zip(pdf["host"], pdf["http_status"], pdf["body"], pdf[url_col]):
                if h not in cache:
                    rules = RobotFileParser()
                    if s is None or pd.isna(s) or s >= 500 or (s < 400 and body is None):
                        rules.disallow_all = True
                    elif s >= 400:
                        rules.allow_all = True
                    else:
                        rules.parse(body.splitlines())
                    cache[h] = rules
                rules = cache[h]
                rules.modified()
                allowed.append(bool(rules.can_fetch(agent, url) and rules.can_fetch("*", url)))
                d = rules.crawl_delay(agent)
                delay.append(float(d) if d is not None else None)
            out = pdf[named].copy()
            out["allowed"], out["crawl_delay"] = allowed, delay
            yield out

    return joined.select(*urls.columns, *[c for c in ("host", "http_status", "body") if c not in urls.columns]).mapInPandas(judge, schema)


def _retry_after(value: str | None, otherwise: float) -> float:
    """Seconds that a Retry-After header names, as a number or as a date."""
    from datetime import datetime, timezone
    from email.utils import parsedate_to_datetime

    try:
        return max(0.0, float(value))
    except (TypeError, ValueError):
        pass
    try:
        return max(0.0, (parsedate_to_datetime(value) - datetime.now(timezone.utc)).total_seconds())
    except (TypeError, ValueError):
        return otherwise


def http_get(agent: str, timeout_s: float = 30.0, max_bytes: int = 6 * 1024 * 1024):
    """get for fetch_pages: follows redirects, reads one byte more than max_bytes at most, decodes by the declared charset."""

    def get(url: str) -> tuple[int, dict, str]:
        from urllib.error import HTTPError
        from urllib.request import Request, urlopen

        try:
            got = urlopen(Request(url, headers={"User-Agent": agent}), timeout=timeout_s)
        except HTTPError as e:
            got = e
        with got:
            body = got.read(max_bytes + 1)
            return got.status, dict(got.headers), body.decode(got.headers.get_content_charset() or "utf-8", "replace")

    return get


def fetch_pages(targets: DataFrame, get, min_interval_s: float = 6.0, max_attempts: int = 3, max_bytes: int = 6 * 1024 * 1024) -> DataFrame:
    """Fetch targets politely: a host's pages meet in one task and are fetched one after another.

    get(url) -> (http_status, headers, body) is injected (http_get makes one), so the network stays outside the
    engine. A column crawl_delay (allowed_by_robots gives it) lengthens a host's pauses. Network errors and 500,
    502, 503 and 504 are tried again with growing pauses; other errors are final. Targets whose `render` is
    `js` need a browser, which this engine has none of: their status is skipped_render.
    """
    from ..operators.runs import by_host

    schema = "slug string, url string, status string, http_status int, elapsed_ms int, html string"

    def fetch(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        last: dict[str, float] = {}
        for pdf in it:
            rows = []
            for slug, url, h, render, delay in zip(pdf["slug"], pdf["url"], pdf["host"], pdf["render"], pdf["crawl_delay"].fillna(0.0)):
                began = time.monotonic()
                status, code, body = "network_error", None, None
                if render == "js":
                    rows.append((slug, url, "skipped_render", None, 0, None))
                    continue
                for attempt in range(1, max_attempts + 1):
                    wait = last.get(h, -1e9) + max(min_interval_s, delay) - time.monotonic()
                    if wait > 0:
                        time.sleep(wait)
                    last[h] = time.monotonic()
                    pause = min_interval_s * attempt
                    try:
                        code, headers, body = get(url)
                    except OSError:
                        status = "network_error"
                    else:
                        status = "ok" if code < 400 else "http_error"
                        if code not in (500, 502, 503, 504):
                            break
                        pause = min(120.0, _retry_after((headers or {}).get("Retry-After"), pause))
                    if attempt < max_attempts:
                        time.sleep(pause)
                if status == "ok" and body is not None and len(body.encode("utf-8", "ignore")) > max_bytes:
                    status, body = "too_large", None
                rows.append((slug, url, status, code, int((time.monotonic() - began) * 1000), body if status == "ok" else None))
            yield pd.DataFrame(rows, columns=["slug", "url", "status", "http_status", "elapsed_ms", "html"]).astype({"http_status": "Int64"})

    missing = {"crawl_delay": F.lit(None).cast("double"), "render": F.lit("static")}
    targets = targets.withColumns({c: x for c, x in missing.items() if c not in targets.columns})
    return by_host(targets).select("slug", "url", "host", "render", "crawl_delay").mapInPandas(fetch, schema)
