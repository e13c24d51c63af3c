from pyspark.sql import functions as F

from tidemark.operators import changes as C

PLAN = "side string, slug string, pos int, name string, price_raw string, amount double, currency string, period string, features array<string>, slot_prices array<double>"


def events(spark, cases):
    """Events of each (old, new) case; all cases go through one comparison, a slug each."""

    def rows(side, slug, plans):
        return [(side, slug, i, p.get("name", "Pro"), str(p.get("amount")), p.get("amount"), p.get("currency", "USD"), p.get("period", "month"), p.get("features", []), p.get("slots")) for i, p in enumerate(plans)]

    df = spark.createDataFrame([r for n, (old, new, *_) in enumerate(cases) for r in rows("old", str(n), old) + rows("new", str(n), new)], PLAN)
    pairs = C.plan_pairs(df.where("side = 'old'").drop("side"), df.where("side = 'new'").drop("side"), ["slug"])
    got = [[] for _ in cases]
    for r in C.plan_events(pairs, ["slug"]).collect():
        got[int(r.slug)].append((r.type, r.plan, r.pct_change, r.direction))
    return [sorted(g, key=str) for g in got]


A = {"amount": 20.0}
CASES = [
    ([A], [{"amount": 25.0}], [("price_changed", "Pro", 25.0, "up")]),
    ([A], [A], []),
    ([A], [{"amount": 25.0, "currency": None}], [("price_changed", "Pro", 25.0, "up")]),
    ([A], [{"amount": 20.0, "currency": None}], []),
    ([A], [{"amount": 20.0, "currency": "AUD"}], [("currency_changed", "Pro", None, None)]),
    ([A], [{"amount": 25.0, "period": "user"}], [("period_changed", "Pro", None, None)]),
    ([{"amount": 20.0, "period": None}], [{"amount": 25.0}], [("price_changed", "Pro", 25.0, "up")]),
    ([{"amount": 20.0, "period": None}], [A], [("period_changed", "Pro", None, None)]),
    ([A, {"amount": 30.0}], [{"amount": 25.0}], [("plan_name_ambiguous", "Pro", None, None)]),
    ([A, A], [{"amount": 25.0}], [("price_changed", "Pro", 25.0, "up")]),
    ([{"amount": 68.0, "slots": [68.0, 34.0]}], [{"amount": 34.0, "slots": [34.0]}], [("price_display_changed", "Pro", None, None)]),
    ([{"amount": 68.0}], [{"amount": 34.0}], [("price_changed", "Pro", -50.0, "down")]),
    ([A], [{"amount": None}], [("price_changed", "Pro", None, None)]),
    ([{"amount": 0.0}], [A], [("price_changed", "Pro", None, "up")]),
    ([A], [{"name": "Team", "amount": 9.0}], [("plan_added", "Team", None, None), ("plan_removed", "Pro", None, None)]),
    ([{"name": "Pricing", "amount": 1.0}], [], []),
    ([{"name": " pro", "amount": 20.0}], [A], []),
    ([{"amount": 20.0, "features": ["a"]}], [{"amount": 20.0, "features": ["b"]}], [("features_changed", "Pro", None, None)]),
]


def test_plan_cascade(spark):
    for case, got in zip(CASES, events(spark, CASES)):
        assert got == case[2], case


def test_features_and_lines_are_counted_in_full_and_shown_in_part(spark):
    many = [f"f{i:02d}" for i in range(40)]
    rows = spark.createDataFrame([("old", "s", 0, "Pro", "1", 1.0, "USD", "month", [], []), ("new", "s", 0, "Pro", "1", 1.0, "USD", "month", many, [])], PLAN)
    pairs = C.plan_pairs(rows.where("side = 'old'").drop("side"), rows.where("side = 'new'").drop("side"), ["slug"])
    assert C.plan_events(pairs, ["slug"]).first().added == many[:15]
    old = spark.createDataFrame([snap(text="a\nb\n")], SNAP)
    for text, want in (("a\nb\nb\n", (1, 0)), ("b\na\n", (1, 1)), ("a\nb\n", (0, 0)), ("".join(f"x{i}\n" for i in range(70)), (70, 2))):
        d = C.compare_snapshots(old, spark.createDataFrame([snap("h2", text=text)], SNAP)).first().text_diff
        assert (d.lines_added, d.lines_removed) == want and len(d.sample_added) == min(60, want[0])


def test_invariants(spark):
    old = [{"name": n, "amount": a} for n, a in (("Pro", 1.0), ("Team", 2.0), ("Max", None))]
    new = [{"name": n, "amount": a} for n, a in (("Pro", 1.5), ("Solo", 2.0))]
    same, there, back = events(spark, [(old, old), (old, new), (new, old)])
    kinds = lambda ev, t: {p for k, p, *_ in ev if k == t}
    assert same == []
    assert kinds(there, "plan_added") == kinds(back, "plan_removed") and kinds(there, "plan_removed") == kinds(back, "plan_added")


SNAP = "slug string, content_hash string, parser_version int, extractor string, currency_hints array<string>, plans array<struct<name: string, price_raw: string, amount: double, currency: string, period: string, features: array<string>, slot_prices: array<double>>>, models array<struct<key: string, model: string, prices: map<string, struct<raw: string, amount: double>>, currency: string, unit: string>>, text string"


def snap(h="h1", version=2, extractor="dom", hints=(), amount=20.0, models=(), text="a\nb\n", name="Pro"):
    plans = [] if amount is None else [(name, str(amount), amount, "USD", "month", [], [])]
    return ("s", h, version, extractor, list(hints), plans, None if models is None else list(models), text)


def model(key, **prices):
    return (key, key, {k: (str(v), v) for k, v in prices.items()}, "USD", "")


def types(r):
    return sorted(e.type for e in (r.plan_events or [])) + sorted(e.type for e in (r.model_events or []))


def test_compare(spark):
    cases = [
        (None, snap(), "first_seen", []),
        (snap(), snap(), None, None),
        (snap(), snap(amount=21.0), "price_change", ["price_changed"]),
        (snap(), snap("h2"), "page_change", []),
        (snap(), snap("h2", 3, amount=21.0), "parser_upgrade", ["price_changed"]),
        (snap(), snap("h2", extractor="jsonld", amount=21.0), "plan_detail_change", ["extractor_changed"]),
        (snap(), snap("h2", hints=["CAD"], amount=21.0), "plan_detail_change", ["locale_changed"]),
        (snap(hints=["USD"]), snap("h2", amount=21.0), "price_change", ["price_changed"]),
        (snap(), snap("h2", amount=None), "catalog_change", ["plan_removed"]),
        (snap(models=None), snap("h2", models=[model("m", i=1.0)]), "page_change", []),
        (snap(), snap("h2", models=[model("m", i=1.0)]), "catalog_change", ["model_added"]),
        (snap(models=[model("m", i=1.0)]), snap("h2", models=[model("m", i=1.5)]), "price_change", ["model_price_changed"]),
        (snap(models=[model("m", i=1.0, o=2.0)]), snap("h2", models=[model("m", i=2.0, o=1.0)]), "page_change", ["model_price_relabeled"]),
        (snap(models=[model("m", i=1.0)]), snap("h2", models=[model("m", j=1.5)]), "page_change", []),
    ]
    named = lambda n, row: (str(n), *row[1:])
    old = spark.createDataFrame([named(n, c[0]) for n, c in enumerate(cases) if c[0]], SNAP)
    new = spark.createDataFrame([named(n, c[1]) for n, c in enumerate(cases)], SNAP)
    got = {int(r.slug): r for r in C.compare_snapshots(old, new).collect()}
    for n, (_, _, kind, want) in enumerate(cases):
        r = got.get(n)
        assert (r and r.kind) == kind, cases[n]
        if want is not None:
            assert types(r) == want, cases[n]


def test_fingerprint_ignores_order(spark):
    p = [("A", 1.0, None, None), ("A", None, "USD", None), ("B", 2.0, None, "month")]
    kind = "p array<struct<name: string, amount: double, currency: string, period: string>>"
    df = spark.createDataFrame([(p,), (p[::-1],), (p[:2],)], kind).select(C.fingerprint(F.col("p"), F.expr("cast(null AS array<struct<key: string, prices: map<string, string>>>)")).alias("f"))
    a, b, c = [r.f for r in df.collect()]
    assert a == b != c


def test_asof_previous_is_strict(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9)], "k string, t int")
    right = spark.createDataFrame([("a", 1, "x"), ("a", 4, "y"), ("a", 5, "z")], "k string, t int, v string")
    got = {(r.k, r.t): r.prev_v for r in C.asof_previous(left, right, ["k"], "t", ["v"]).collect()}
    assert got == {("a", 5): "y", ("a", 1): None, ("b", 9): None}
