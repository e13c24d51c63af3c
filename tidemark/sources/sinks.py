"""Sinks: snapshots, change log, run log, raw pages, feed, sitemap, status document, Markdown tables."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.price import month_label, pct_label, rfc822_day
from ..functions.text import escape_markup
from ..operators.runs import merge_run_log


def append_by_date(rows: DataFrame, path: str, date: str = "date") -> None:
    """Append-only log, one partition a day."""
    rows.write.mode("append").partitionBy(date).parquet(path)


def upsert_day(rows: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions of the dates (or of whatever is named) in rows, leave the others: a day can be run again."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*(by or ("date",))).parquet(path)


def save_run_log(old: DataFrame, new: DataFrame, path: str) -> None:
    """Old and new entries of the dates in new, merged by slug, new ones winning."""
    days = new.select("date").distinct()
    upsert_day(merge_run_log(old.join(days, "date", "left_semi"), new, ["date", "slug"]), path)


def raw_snapshots(pages: DataFrame, changed: DataFrame, id_cols: list[str], html_col: str = "archive_html") -> DataFrame:
    """Pages that changed, as deterministic gzip bytes (no time stamp)."""
    kinds = dict(pages.dtypes)
    rows = pages.join(changed.select(*id_cols), id_cols, "left_semi").select(*id_cols, html_col)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in id_cols) + ", gz binary"

    def pack(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = pdf[id_cols].copy()
            out["gz"] = [gzip.compress((h or "").encode("utf-8"), 9, mtime=0) for h in pdf[html_col]]
            yield out

    return rows.mapInPandas(pack, schema)


def stale(existing: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """What is there and no longer wanted."""
    return existing.join(wanted.select(key), key, "left_anti")


def rss_items(feed: DataFrame, base_url: str) -> DataFrame:
    """One RSS item per feed row (date, slug, moves), as text; the day comes from the archive, not the clock."""
    line = lambda m: F.concat(m["item"], F.lit(": "), F.coalesce(m["from"], F.lit("")), F.lit(" → "), F.coalesce(m["to"], F.lit("")))
    body = F.array_join(F.transform("moves", line), "; ")
    link = F.concat(F.lit(base_url.rstrip("/") + "/t/"), F.col("slug"), F.lit(".html"))
    guid = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("-"), F.col("slug"))
    item = F.concat(F.lit("<item><title>"), escape_markup(F.col("slug")), F.lit("</title><link>"), escape_markup(link), F.lit('</link><guid isPermaLink="false">'), escape_markup(guid), F.lit("</guid><pubDate>"), rfc822_day(F.col("date")), F.lit("</pubDate><description>"), escape_markup(body), F.lit("</description></item>"))
    return feed.select("date", "slug", item.alias("item"))


def rss(feed: DataFrame, title: str, about: str, base_url: str) -> DataFrame:
    """The whole feed as one value; a feed is a top-k, so its rows are few by definition."""
    rows = rss_items(feed, base_url).agg(F.array_sort(F.collect_list(F.struct(F.datediff(F.lit("1970-01-01").cast("date"), "date").alias("d"), F.col("slug"), "item"))).alias("r"))
    head = f'<?xml version="1.0" encoding="utf-8"?><rss version="2.0"><channel><title>{title}</title><link>{base_url}</link><description>{about}</description>'
    return rows.select(F.concat(F.lit(head), F.array_join(F.transform("r", lambda x: x["item"]), ""), F.lit("</channel></rss>")).alias("xml"))


def sitemap(pages: DataFrame, base_url: str) -> DataFrame:
    """pages (path, lastmod date) -> one sitemap value."""
    url = F.concat(F.lit("<url><loc>"), escape_markup(F.concat(F.lit(base_url.rstrip("/") + "/"), F.col("path"))), F.lit("</loc><lastmod>"), F.date_format("lastmod", "yyyy-MM-dd"), F.lit("</lastmod></url>"))
    all_ = F.array_join(F.array_sort(F.collect_list(url)), "")
    return pages.agg(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), all_, F.lit("</urlset>")).alias("xml"))


def sitemap_files(pages: DataFrame, base_url: str, most: int = 50_000) -> DataFrame:
    """(path, html): sitemaps of some `most` URLs at most each, and an index of them; for sites of any size."""
    shards = max(1, -(-pages.count() * 5 // (4 * most)))  # dealt by hash, so a fifth is left free
    files = pages.withColumn("shard", F.expr(f"pmod(xxhash64(path), {shards})"))
    url = F.concat(F.lit("<url><loc>"), escape_markup(F.concat(F.lit(base_url.rstrip("/") + "/"), F.col("path"))), F.lit("</loc><lastmod>"), F.date_format("lastmod", "yyyy-MM-dd"), F.lit("</lastmod></url>"))
    space = "http://www.sitemaps.org/schemas/sitemap/0.9"
    body = files.groupBy("shard").agg(F.array_join(F.array_sort(F.collect_list(url)), "").alias("urls"), F.max("lastmod").alias("lastmod"))
    name = F.concat(F.lit("sitemap-"), F.col("shard").cast("string"), F.lit(".xml"))
    maps = body.select(name.alias("path"), F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="{space}">'), F.col("urls"), F.lit("</urlset>")).alias("html"))
    entry = F.concat(F.lit(f"<sitemap><loc>{base_url.rstrip('/')}/"), name, F.lit("</loc></sitemap>"))
    index = body.agg(F.array_join(F.array_sort(F.collect_list(entry)), "").alias("e")).select(F.lit("sitemap.xml").alias("path"), F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?><sitemapindex xmlns="{space}">'), F.col("e"), F.lit("</sitemapindex>")).alias("html"))
    return maps.union(index)


def status_document(row: DataFrame) -> DataFrame:
    """One JSON document per row; unknown values stay as nulls."""
    return row.select(F.to_json(F.struct(*row.columns), {"ignoreNullFields": "false"}).alias("json"))


def key_values(row: DataFrame) -> DataFrame:
    return row.select(F.explode(F.array(*[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in row.columns])).alias("line"))


def markdown_row(cols: list[Column]) -> Column:
    cell = lambda c: F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in cols]), F.lit(" |"))


def html_row(cols: list[tuple[str, Column]]) -> Column:
    """A table row whose cells carry their column's label."""
    cells = [F.concat(F.lit(f'<td data-label="{name}">'), escape_markup(c), F.lit("</td>")) for name, c in cols]
    return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))


def html_table(rows: Column, headers: list[str], empty: str) -> Column:
    """A table from an array of arrays of cell texts: a header, cells that carry their column's label, or a message if there are none."""
    head = "".join(f"<th>{h}</th>" for h in headers)
    cell = lambda r, i: F.concat(F.lit(f'<td data-label="{headers[i]}">'), escape_markup(F.get(r, F.lit(i))), F.lit("</td>"))
    lines = F.transform(rows, lambda r: F.concat(F.lit("<tr>"), *[cell(r, i) for i in range(len(headers))], F.lit("</tr>")))
    table = F.concat(F.lit(f"<table><thead><tr>{head}</tr></thead><tbody>"), F.array_join(lines, ""), F.lit("</tbody></table>"))
    return F.when(F.coalesce(F.size(rows), F.lit(0)) > 0, table).otherwise(F.lit(f'<p class="empty">{empty}</p>'))


def html_page(title: Column, body: Column) -> Column:
    return F.concat(F.lit('<!doctype html><html><head><meta charset="utf-8"><title>'), escape_markup(title), F.lit("</title></head><body><h1>"), escape_markup(title), F.lit("</h1>"), body, F.lit("</body></html>"))


_MOVE_HEADS = ["Date", "Item", "From", "To", "Change"]


def _move_cells(m: Column) -> Column:
    return F.array(F.date_format(m["date"], "yyyy-MM-dd"), m["item"], F.coalesce(m["from"], F.lit("")), F.coalesce(m["to"], F.lit("")), pct_label(m["pct"]))


def tool_pages(history: DataFrame, most: int = 60) -> DataFrame:
    """(path, html) of one page per target from reports.with_history rows (slug, name, history); what is cut is counted."""
    shown = F.transform(F.slice("history", 1, most), _move_cells)
    rest = F.size("history") - most
    body = F.concat(html_table(shown, _MOVE_HEADS, "No moves yet."), F.when(rest > 0, F.concat(F.lit("<p>"), rest.cast("string"), F.lit(" more</p>"))).otherwise(""))
    return history.select(F.concat(F.lit("t/"), F.col("slug"), F.lit(".html")).alias("path"), html_page(F.coalesce("name", "slug"), body).alias("html"))


def month_page_files(moves: DataFrame) -> DataFrame:
    """(path, html) of one page per month and vendor of moves; a vendor's month is bounded by its pages and days."""
    month = F.date_format("date", "yyyy-MM")
    item = F.struct("date", "item", "seq", "from", "to", "pct")
    got = moves.groupBy(month.alias("month"), "vendor").agg(F.sort_array(F.collect_list(item), asc=False).alias("rows"))
    title = F.concat(F.col("vendor"), F.lit(" in "), month_label(F.col("month")))
    return got.select(F.concat(F.lit("m/"), "month", F.lit("/"), "vendor", F.lit(".html")).alias("path"), html_page(title, html_table(F.transform("rows", _move_cells), _MOVE_HEADS, "No moves.")).alias("html"))


def index_page(targets: DataFrame, recent: DataFrame, title: str, most: int = 20) -> DataFrame:
    """(path, html) of the index: the newest moves (a top-k) and how many targets each category has."""
    top = recent.orderBy(F.desc("date"), F.desc("vendor"), "seq").limit(most)
    rows = top.agg(F.sort_array(F.collect_list(F.struct("date", "vendor", (-F.col("seq")).alias("back"), "item", "from", "to", "pct")), asc=False).alias("r"))
    groups = targets.groupBy("category").agg(F.count(F.lit(1)).alias("n")).agg(F.array_sort(F.collect_list(F.array("category", F.col("n").cast("string")))).alias("g"))
    body = F.concat(html_table(F.transform("r", _move_cells), _MOVE_HEADS, "No moves yet."), html_table(F.col("g"), ["Category", "Targets"], "No targets."))
    return rows.crossJoin(groups).select(F.lit("index.html").alias("path"), html_page(F.lit(title), body).alias("html"))  # one row each


def write_files(files: DataFrame, root: str, path: str = "path", content: str = "html") -> DataFrame:
    """Write each row's content to its path under root, through a name of its own, and name what was there and is no longer wanted.

    root is a folder that every task reaches by name (a mounted folder); returns (path) of stale files.
    """
    import os
    import uuid

    def put(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for at, text in zip(pdf[path], pdf[content]):
                full = os.path.join(root, at)
                os.makedirs(os.path.dirname(full), exist_ok=True)
                with open(tmp := f"{full}.{uuid.uuid4().hex}", "w", encoding="utf-8") as f:
                    f.write(text)
                os.replace(tmp, full)
            yield pdf[[path]]

    wanted = files.select(path, content).mapInPandas(put, f"{path} string")
    names = [r[0] for r in wanted.collect()]  # pages of a site are few: targets and months
    spark = files.sparkSession
    there = [os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if f.endswith((".html", ".xml"))]
    existing, now = (spark.createDataFrame([(n,) for n in x], f"{path} string") for x in (there, names))
    return stale(existing, now, path)
