import datetime as dt
import time
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import price as fp
from tidemark.functions import text as ft
from tidemark.functions import urls as fu
from tidemark.operators import reports as rp
from tidemark.operators import runs as rn
from tidemark.sources import archive as A
from tidemark.sources import sinks as K
from tidemark.streaming import snapshots as T


def one(spark, column, *values):
    rows = spark.createDataFrame([(v,) for v in values], "x string")
    return [r.y for r in rows.select(column(F.col("x")).alias("y")).collect()]


def test_targets(spark, tmp_path):
    p = tmp_path / "targets.yaml"
    p.write_text("defaults: {category: misc}\ntargets:\n- {slug: a, name: A, url: 'https://a/x#f', odd: 1}\n- {slug: b, name: B, url: 'https://A/x/', enabled: false, category: gpu-rental}\n")
    t = A.read_targets(spark, str(p))
    got = {r.slug: r for r in t.collect()}
    assert got["a"].category == "misc" and got["a"].extra == {"odd": "1"} and got["b"].enabled is False
    kept, dropped = rn.first_by_url(t)
    assert [r.slug for r in kept.collect()] == ["a"] and dropped.first()[:2] == ("b", "a")
    assert rn.only_slugs(t, ["a"]).count() == 1
    with pytest.raises(ValueError, match="unknown targets: zz"):
        rn.only_slugs(t, ["a", "zz"])
    p.write_text("targets:\n- {slug: a}\n- {slug: a}\n")
    with pytest.raises(ValueError, match="twice"):
        A.read_targets(spark, str(p))


def test_corrections_skip_broken_lines(spark, tmp_path):
    p = tmp_path / "c.jsonl"
    p.write_text('{"date":"2026-01-01","slug":"a"}\n\n[1, 2]\n"x"\nnot json\n{"date":"2026-01-02","slug":"b","kind":"catalog_change"}\n{"slug":"c"}\n')
    got = sorted((r.date, r.slug, r.kind) for r in A.read_corrections(spark, str(p)).collect())
    assert got == [("2026-01-01", "a", "price_change"), ("2026-01-02", "b", "catalog_change")]


def test_corrections_and_reparses_do_not_count(spark):
    ch = spark.createDataFrame([("2026-01-01", "a", "price_change"), ("2026-01-02", "a", "price_change"), ("2026-01-03", "a", "parser_upgrade")], "date string, slug string, kind string")
    co = spark.createDataFrame([("2026-01-01", "a", None)], "date string, slug string, kind string")
    assert [r.date for r in rp.counted(ch, co).collect()] == ["2026-01-02"]
    assert [r.date for r in rp.retracted(ch, co).collect()] == ["2026-01-01"]


def test_moves(spark):
    line = {"date": "2026-01-01", "slug": "a", "name": "A", "kind": "price_change", "plan_events": [{"type": "price_changed", "plan": "Pro", "from_raw": "40", "from_currency": "USD", "to_raw": "$50", "to_currency": "USD", "pct_change": 25.0}, {"type": "plan_added", "plan": "X"}], "model_events": [{"type": "model_price_changed", "model": "m", "changes": [{"field": "kolom 2", "from": {"raw": "$1"}, "to": {"raw": "$2"}, "pct_change": 100.0}, {"field": "in", "from": {"raw": "$3"}, "to": {"raw": "$2"}}]}]}
    df = spark.read.schema(A.CHANGES).json(spark.sparkContext.parallelize([json.dumps(line)])).withColumn("seq", F.lit(0))
    got = sorted((r.item, r["from"], r.to) for r in rp.moves(df).collect())
    assert got == [("Pro", "$40", "$50"), ("m · column 2", "$1", "$2"), ("m · in", "$3", "$2")]
    assert df.select(rp.moved_numbers(F.col("plan_events"), F.col("model_events")).alias("n")).first().n == 3
    feed = rp.feed(rp.moves(df))
    assert len(feed.first().moves) == 3
    xml = K.rss(feed, "t", "d", "https://e.org").first().xml
    assert "Thu, 01 Jan 2026 00:00:00 +0000" in xml and xml.count("<item>") == 1


def test_once_a_day(spark):
    t = spark.createDataFrame([(s,) for s in "abcdef"], "slug string")
    today = spark.createDataFrame([("a", "ok", 200, None), ("b", "http_error", 429, False), ("c", "http_error", 503, False), ("d", "network_error", None, False), ("e", "ok", 200, True)], "slug string, status string, http_status int, dry_run boolean")
    assert sorted(r.slug for r in rn.not_done(t, today).collect()) == ["c", "d", "e", "f"]
    assert rn.not_done(t, today, force=True).count() == 6


def test_coverage(spark):
    rows = [(s, f"2026-01-0{d}", n) for s, ns in {"shrunk": (9, 9, 2, 2), "vanished": (5, 0, 0, 0), "grew": (1, 1, 9, 9), "stable": (4, 4, 4, 4), "zero": (0, 0, 0, 0)}.items() for d, n in enumerate(ns, 1)]
    got = rn.coverage_audit(spark.createDataFrame(rows, "slug string, date string, n int"), ["slug"], F.col("n"), 2).collect()
    assert all(r.verdict == r.slug for r in got) and len(got) == 5


def test_overlay(spark):
    rows = spark.createDataFrame([("a", 0, "x", 1), ("a", 1, None, 2), ("b", 2, None, None)], "k string, seq int, reason string, n int")
    got = {r.k: (r.reason, r.n) for r in rp.overlay(rows, ["k"], "seq", ["reason", "n"]).collect()}
    assert got == {"a": ("x", 2), "b": (None, None)}


def test_scalars(spark):
    assert one(spark, fu.fetch_key, "HTTPS://A.com/x/#y", "https://a.com", "https://a.com/?q=1", "https://a.com/B/?q") == ["https://a.com/x", "https://a.com/", "https://a.com/?q=1", "https://a.com/B?q"]
    assert one(spark, fu.host, "https://A.com:80/x") == ["a.com:80"]
    assert one(spark, ft.undouble, "Beam Beam", "NVIDIA HGX B300", "a a a") == ["Beam", "NVIDIA HGX B300", "a a a"]
    assert one(spark, ft.normalize_text, "", None, "  a  b \n\n173.1K\n", "ﬁ") == ["\n", "\n", "a b\n<count>\n", "fi\n"]
    assert one(spark, ft.shorten, "short", "word " * 60)[0] == "short"
    assert one(spark, fp.parse_period, "per vCPU-hour*", "gpu hour", "/ hr") == ["vcpu-hour", None, "hour"]
    assert one(spark, lambda c: fp.readable_size(c.cast("long")), "5", "2048", "3145728") == ["5 B", "2.0 KiB", "3.0 MiB"]
    assert one(spark, lambda c: ft.line_diff(F.lit("a\nb\n"), c)["lines_added"], "a\nc\nd\n", "a\nb\n") == [2, 0]
    assert one(spark, lambda c: ft.commit_metric(c, r"(\d+) moved"), "x 12 moved", "none") == [12, None]


def test_robots(spark):
    urls = spark.createDataFrame([("https://a/x",), ("https://a/no",), ("https://b/",), ("https://c/",), ("https://d/",)], "url string")
    robots = spark.createDataFrame([("a", 200, "User-agent: *\nDisallow: /no\nCrawl-delay: 3"), ("b", 503, None), ("c", 404, None)], "host string, http_status int, body string")
    got = {r.url: (r.allowed, r.crawl_delay) for r in A.allowed_by_robots(urls, robots, "bot").collect()}
    assert got == {"https://a/x": (True, 3.0), "https://a/no": (False, 3.0), "https://b/": (False, None), "https://c/": (True, None), "https://d/": (False, None)}


def test_fetch(spark):
    t = spark.createDataFrame([("ok", "https://a/1", "static"), ("gone", "https://a/404", None), ("down", "https://b/503", "static"), ("drawn", "https://c/1", "js")], "slug string, url string, render string")

    def get(url):
        code = int(url.rsplit("/", 1)[1])
        return (200 if code == 1 else code), {}, "page"

    got = {r.slug: (r.status, r.http_status) for r in A.fetch_pages(t, get, min_interval_s=0).collect()}
    assert got == {"ok": ("ok", 200), "gone": ("http_error", 404), "down": ("http_error", 503), "drawn": ("skipped_render", None)}
    later = time.strftime("%a, %d %b %Y %H:%M:%S GMT", time.gmtime(time.time() + 90))
    assert A._retry_after("7", 1.0) == 7.0 and A._retry_after(None, 1.0) == A._retry_after("soon", 1.0) == 1.0 and 80 < A._retry_after(later, 1.0) <= 90


def test_http_get():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(404 if self.path == "/gone" else 200)
            self.send_header("Content-Type", "text/html; charset=latin-1")
            self.end_headers()
            self.wfile.write("caf\xe9".encode("latin-1") * (5 if self.path == "/long" else 1))

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        get, root = A.http_get("agent", 5.0, max_bytes=8), f"http://127.0.0.1:{server.server_port}"
        assert get(root)[::2] == (200, "caf\xe9") and get(root + "/gone")[0] == 404
        assert len(get(root + "/long")[2]) == 9  # one byte more than allowed, which tells that it is too long
    finally:
        server.shutdown()


def test_commit_log_and_correction_order(spark, tmp_path):
    (tmp_path / "log").write_text("a1\0002026-01-02T03:04:05Z\000snapshot: moved=3\nbroken line\nb2\0002026-01-03T03:04:05Z\000other\n")
    rows = A.read_commit_log(spark, str(tmp_path / "log"), "^snapshot").collect()
    assert [(r.hash, str(r.committed_at), r.subject) for r in rows] == [("a1", "2026-01-02 03:04:05", "snapshot: moved=3")]
    (tmp_path / "c").mkdir()
    for name, slugs in (("b.jsonl", "zy"), ("a.jsonl", "xw")):
        (tmp_path / "c" / name).write_text("".join(json.dumps({"date": "2026-01-01", "slug": s}) + "\n" for s in slugs))
    assert [r.slug for r in A.read_corrections(spark, str(tmp_path / "c")).orderBy("seq").collect()] == ["x", "w", "z", "y"]


def test_json_ld_blocks(spark):
    df = spark.createDataFrame([(1, '<script type="application/ld+json">{"a":1}</script><script type="application/ld+json">{x</script>')], "id int, html string")
    assert A.json_ld_blocks(df, ["id"]).count() == 1


SNAPS = "slug string, obs_date date, observed_at timestamp, content_hash string, parser_version int, extractor string, currency_hints array<string>, plans array<struct<name: string, price_raw: string, amount: double, currency: string, period: string, features: array<string>, slot_prices: array<double>>>, models array<struct<key: string, model: string, prices: map<string, struct<raw: string, amount: double>>, currency: string, unit: string>>, text string"


def test_daily_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()

    def day(d, amount, hour=0):
        return ("s", dt.date(2026, 1, d), dt.datetime(2026, 1, d, hour), f"h{amount}", 1, "dom", [], [("Pro", str(amount), amount, "USD", "month", [], [])], [], "t")

    def go(rows, name):
        spark.createDataFrame(rows, SNAPS).coalesce(1).write.mode("append").parquet(str(src / name))
        stream = spark.readStream.schema(SNAPS).option("recursiveFileLookup", True).parquet(str(src))
        T.run_stream(stream, str(tmp_path / "snaps"), str(tmp_path / "changes"), str(tmp_path / "cp")).awaitTermination()
        return sorted((str(r.date), r.kind) for r in spark.read.parquet(str(tmp_path / "changes")).collect())

    assert go([day(1, 10.0), day(2, 10.0)], "a") == [("2026-01-01", "first_seen")]
    assert go([day(3, 12.0, 1), day(3, 11.0, 0)], "b") == [("2026-01-01", "first_seen"), ("2026-01-03", "price_change")]
    snaps = spark.read.parquet(str(tmp_path / "snaps"))
    assert A.current_of(snaps).first().content_hash == "h12.0" and A.previous_of(snaps, "2026-01-03").first().content_hash == "h10.0"
    # a later batch of a day adds to it: another slug, and a second observation that differs from the first
    other = ("z", *day(3, 5.0)[1:])
    assert go([other, day(3, 15.0, 7)], "c") == [("2026-01-01", "first_seen"), ("2026-01-03", "first_seen"), ("2026-01-03", "price_change"), ("2026-01-03", "price_change")]
    state = {r.slug: r.content_hash for r in A.current_of(T.state_of(spark.read.parquet(str(tmp_path / "snaps")))).collect()}
    assert state == {"s": "h15.0", "z": "h5.0"}
    moves = spark.read.parquet(str(tmp_path / "changes")).where("kind = 'price_change'").selectExpr("inline(plan_events)").select("from_amount", "to_amount").collect()
    assert sorted(map(tuple, moves)) == [(10.0, 12.0), (12.0, 15.0)]


def test_keyed_state_stream(spark, tmp_path):
    rows = [("a", dt.datetime(2026, 1, 1, h), float(v)) for h, v in ((1, 1), (2, 1), (3, 2))]
    spark.createDataFrame(rows, "k string, t timestamp, v double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t timestamp, v double").parquet(str(tmp_path / "in"))
    q = T.last_value_moves(stream, "k", "t", "v").writeStream.outputMode("append").format("memory").queryName("moves").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.previous, r.v) for r in spark.table("moves").collect()} == {(None, 1.0), (1.0, 2.0)}


def test_run_log_and_sinks(spark, tmp_path):
    kinds = "date date, slug string, status string"
    old = spark.createDataFrame([(dt.date(2026, 1, 1), "a", "ok"), (dt.date(2026, 1, 1), "b", "ok")], kinds)
    K.upsert_day(old, str(tmp_path / "runs"))
    K.save_run_log(spark.read.parquet(str(tmp_path / "runs")), spark.createDataFrame([(dt.date(2026, 1, 1), "b", "crash"), (dt.date(2026, 1, 2), "a", "ok")], kinds), str(tmp_path / "runs2"))
    got = sorted((str(r.date), r.slug, r.status) for r in spark.read.parquet(str(tmp_path / "runs2")).collect())
    assert got == [("2026-01-01", "a", "ok"), ("2026-01-01", "b", "crash"), ("2026-01-02", "a", "ok")]
    pages = spark.createDataFrame([(1, "<p>x</p>"), (2, "y")], "id int, archive_html string")
    gz = K.raw_snapshots(pages, pages.where("id = 1"), ["id"]).collect()
    import gzip

    assert len(gz) == 1 and gzip.decompress(gz[0].gz) == b"<p>x</p>"
    assert [r.id for r in K.stale(pages, pages.where("id = 1"), "id").collect()] == [2]
