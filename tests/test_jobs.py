"""The daily job over two days, its switches, and the reports, gate and check that follow."""

from pathlib import Path

import pytest

from tidemark import jobs as J
from tidemark.sources import archive as A

PAGE = "<html><body><div><h3>{n}</h3><p>${a} /month</p><ul><li>one thing</li></ul></div><p>{pad}</p></body></html>"


def page(name, amount):
    return PAGE.format(n=name, a=amount, pad="plain words of a page " * 40)


@pytest.fixture(scope="module")
def targets(spark):
    rows = [(s, s.upper(), f"https://{s}.example/p", "v", "ai-api", r, "USD", e, 0, None, {}, i) for i, (s, r, e) in enumerate([("one", "static", True), ("two", "static", True), ("drawn", "js", True), ("off", "static", False), ("gone", "static", True)])]
    return spark.createDataFrame(rows, A.TARGETS)


def test_two_days(spark, targets, tmp_path):
    root = str(tmp_path / "root")

    def web(prices):
        def get(url):
            slug = url.split("//")[1].split(".")[0]
            return (404, {}, "") if slug == "gone" else (200, {}, page(slug.title(), prices[slug]))

        return get

    def day(d, prices, **switches):
        log = J.daily(spark, targets, root, d, web(prices), switches=J.Switches(**switches), interval_s=0)
        return {r.slug: (r.status, r.change_kind) for r in log.collect()}

    first = {"one": 10, "two": 20}
    assert day("2026-01-01", first) == {"one": ("ok", "first_seen"), "two": ("ok", "first_seen"), "drawn": ("skipped_render", None), "gone": ("http_error", None)}
    # once a day: a final answer stays, what may be tried again is, and a dry run leaves no trace in the tables
    before = J.due_targets(targets, spark.read.parquet(f"{root}/runs"), "2026-01-01", J.Switches())
    assert [r.slug for r in before.collect()] == ["drawn"]
    assert day("2026-01-02", {"one": 15, "two": 20}, dry_run=True)["one"] == ("ok", "price_change")
    assert spark.read.parquet(f"{root}/changes").count() == 2
    assert day("2026-01-02", {"one": 15, "two": 20})["one"] == ("ok", "price_change")
    assert spark.read.parquet(f"{root}/changes").where("kind = 'price_change'").count() == 1
    assert sorted(r.slug for r in spark.read.parquet(f"{root}/raw").select("slug").collect()) == ["one", "one", "two"]
    assert {r.line for r in J.summary_lines(spark.read.parquet(f"{root}/runs").where("date = DATE '2026-01-02'")).collect()} >= {"total=4", "ok=2", "changed=1", "| gone | failed |"}

    g = J.gate(spark, targets, root, threshold=40).first()
    assert (g.plan_page_days, g.plan_numbers, g.counted, g.retracted, g.days, g.plan_verdict) == (1, 1, 3, 0, 2, "met")
    Path(root, "corrections.jsonl").write_text('{"date": "2026-01-02", "slug": "one"}\n')
    assert J.gate(spark, targets, root).first().plan_numbers == 0
    Path(root, "corrections.jsonl").unlink()
    assert {r.slug: r.diagnosis for r in J.check_targets(spark, targets, root).collect()} == {"one": "one plan", "two": "one plan"}

    site = tmp_path / "site"
    (site / "t").mkdir(parents=True)
    (site / "t" / "old.html").write_text("x")
    assert [r.path for r in J.build_reports(spark, targets, root, str(site)).collect()] == ["t/old.html"]
    assert "$15" in (site / "t" / "one.html").read_text() and "No moves yet." in (site / "t" / "two.html").read_text()
    assert "+50%" in (site / "index.html").read_text() and (site / "m" / "2026-01" / "v.html").exists()
    assert "<item>" in (site / "feed.xml").read_text() and "t/one.html" in (site / "sitemap-0.xml").read_text() and "sitemap-0.xml" in (site / "sitemap.xml").read_text()


def test_unknown_slug_is_an_error(spark, targets):
    with pytest.raises(ValueError, match="nobody"):
        J.due_targets(targets, spark.createDataFrame([], A.RUNS), "2026-01-01", J.Switches(only=("nobody",)))
