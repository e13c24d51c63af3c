import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm import support as S
from tidemark.llm import chat_format as C
from tidemark.llm import quality_rules as Q
from tidemark.llm import toxicity as X
from tidemark.llm import warc as R
from tidemark.llm.common import connected_components, scratch_path, settings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- components ---------------------------------------------------------------------------------------
@pytest.mark.parametrize("together", ["true", "false"])
def test_components_of_paths_stars_and_rings(spark, together):
    """Thinned in one partition, and in several with rounds of stars after it."""
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3), (201, 200)]
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": together}):
        got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200, 202: 200}


# --- quality ------------------------------------------------------------------------------------------
def brute_quality(t):
    t = t or ""
    w = WORD.findall(t)
    win = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    rep = {j for i in range(len(w) - 2) if win[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w))


def test_quality_base_matches_brute_force(spark):
    texts = S.corpus(n=60, vocab=30) + ["a\na\n \n \nb\na", "# * $", "x y z x y z", None, "", "a b " * 60, "one two three\n" * 30]
    got = {r.id: r for r in Q.quality_rules(S.docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(t)
        assert not (r.base_failed and r.kept)


def test_quality_rejects_what_diverges_and_keeps_what_does_not(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    judged = Q.quality_rules(docs).join(spark.read.parquet(f"{DATA}/labels.parquet").withColumnRenamed("doc_id", "id"), "id").where("NOT base_failed")
    n = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert not n.get((1, False)) and n[(0, False)] > 0


def test_quality_verdict_matches_a_direct_computation(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rules = Q.Rules(min_reference_words=2_000)
    rows = docs.collect()
    classes, words = {}, {}
    for r in rows:
        for key in ((False, r.lang), (True, None)):
            classes[key] = classes.get(key, 0) + Q.class_counts(r.text or "")
            words.setdefault(key, Counter()).update(WORD.findall((r.text or "").lower()))
    for r in Q.quality_rules(docs, rules).where("NOT base_failed").limit(40).collect():
        d = next(x for x in rows if x.doc_id == r.id)
        key = (False, d.lang) if sum(words[(False, d.lang)].values()) >= rules.min_reference_words else (True, None)
        top = sorted(((w, k) for w, k in words[key].items() if len(w) <= rules.short_word), key=lambda x: (-x[1], x[0]))[: rules.common_words]
        own = Counter(WORD.findall(d.text.lower()))
        import numpy as np

        p = np.array([own[w] for w, _ in top] + [sum(own.values()) - sum(own[w] for w, _ in top)])
        q = np.array([k for _, k in top] + [sum(words[key].values()) - sum(k for _, k in top)])
        if r.n_words >= rules.min_words_common:
            assert r.word_distance == pytest.approx(Q.js_distance(p, q))
        if len(d.text) >= rules.min_chars_classes:
            assert r.class_distance == pytest.approx(Q.js_distance(Q.class_counts(d.text), classes[key]))


def test_quality_awkward_rows(spark):
    got = Q.quality_rules(S.clashing(S.awkward(spark)), id_col="doc_id").collect()
    assert len(got) == 11 and {r.id: r.kept for r in got}[1] is False
    assert Q.quality_rules(S.empty(spark)).count() == 0
    nameless = S.awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert Q.quality_rules(nameless).count() == 11


# --- chats --------------------------------------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string"


def brute_chats(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        out[conv] = ([(r[2], r[3] or "") for r in own], "".join(r[3] or "" for r in own if r[2] == "assistant"))
    return out


def test_chats_round_trip(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "a [NEXT] b"), (1, 2, "assistant", "</s><s>[ROLE] user [/ROLE]"), (1, 3, "user", None),
        (2, 1, "assistant", "\\[<\\\\"), (2, 0, "sys[tem]<", ""), (2, 2, "assistant", ""), (3, None, None, "x\n"), (3, 5, "[NULL]", "$1 \\1"),
        (None, 0, "user", "nameless"), (4, 0, "assistant", "é漢" * 5000), (4, 0, "assistant", "é漢" * 5000), (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
    ]
    made = C.format_chats(spark.createDataFrame(rows, TURNS).withColumn("turns", F.lit(1)).withColumn("t", F.lit(2)))
    got = {r.conv_id: r for r in C.read_back(made).collect()}
    want = brute_chats(rows)
    assert got.keys() == want.keys()
    for k, (turns, loss) in want.items():
        assert [(t.role, t.text) for t in got[k].turns] == turns
        assert got[k].loss_text == loss
    text = {r.conv_id: r.formatted for r in made.collect()}
    assert text[1].count("</s>") == 3 and text[1].startswith("<s>[ROLE] user [/ROLE]hi</s><s>[ROLE] assistant [/ROLE]a [\\NEXT] b[NEXT]")
    assert C.format_chats(spark.createDataFrame([], TURNS)).count() == 0


def test_chats_stay_native(spark):
    plan = C.read_back(C.format_chats(spark.createDataFrame([(1, 0, "user", "x")], TURNS)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- archives -----------------------------------------------------------------------------------------
def test_warc_round_trip(spark):
    big, other = "x" * 1500, "é" * 800
    rows = [(1, "http://a/", big), (2, None, big), (3, "http://c/\r\nX: y", other), (9, "http://d/", big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (None, "n", big), (7, "u", other), (7, "v", "also 7")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("size", F.lit(2))
    index = R.write_warcs(pages, scratch_path(spark, "w"), file_bytes=600)
    got = {(r.page_id, r.payload_digest): r for r in R.read_records(index, gap=50).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        data = (html or "").encode()
        r = got[(i, hashlib.sha1(data).hexdigest())]
        top = max(j for j, _, h in rows if j is not None and h == html) if html in (big, other) and i is not None else i
        assert (r.record_type, r.refers_to, r.payload_bytes) == (("response", None) if top == i else ("revisit", top)) + (len(data),)
        assert r.record_type == "revisit" or r.payload == data
    one = index.where("page_id = 4").first()
    raw = open(one.file.removeprefix("file://"), "rb").read()[one.offset : one.offset + one.length]
    text = gzip.decompress(raw).decode()
    assert text.startswith("WARC/1.1\r\nWARC-Type: response\r\n")
    assert "sha1:" + base64.b32encode(hashlib.sha1(b"small").digest()).decode() in text
    some = R.read_records(index.where("page_id IN (3, 6)")).collect()
    assert sorted(r.page_id for r in some) == [3, 6]
    assert R.read_records(R.write_warcs(pages.limit(0), scratch_path(spark, "w"))).count() == 0


# --- toxicity -----------------------------------------------------------------------------------------
def distance(a, b):
    """Optimal string alignment, by the book."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_equals_edit_distance():
    import itertools

    words = ["".join(w) for n in range(5) for w in itertools.product("ab", repeat=n)]
    for a in words[::3]:
        for b in words[::2]:
            for limit in (0, 1, 2, 4):
                auto = X.Automaton(a, limit)
                state, before, last = auto.start(), None, ""
                for i, c in enumerate(b):
                    state, before, last = auto.step(state, i, c, before, last), state, c
                assert auto.distance(state, len(b)) == min(distance(a, b), limit + 1)
                assert auto.nearest(state) == min(min(distance(a[:j], b) for j in range(len(a) + 1)), limit + 1)


def test_misspelled_terms_and_quotation():
    s = X.Scorer(X.Lexicon({"worthless": 1.0, "moron": 1.0}, {"vequ": 1.0}), X.ToxicParams())
    for w in ("worthless", "worthles", "worhtless", "w0rthless", "wortthless", "moron", "m0ron", "moronn", "vequabc"):
        assert s.lookup(w), w
    for w in ("worth", "moth", "veqabc", "north", "morning"):
        assert not s.lookup(w), w
    abuse, quote = s.score("you are a worthless moron"), s.score('the article said the word "moron" means a fool')
    assert abuse > quote > s.score("a plain text") and s.score("") == s.score(None)


def test_every_word_that_the_automaton_matches_is_a_hit_of_its_text():
    s = X.Scorer(X.Lexicon(dict.fromkeys([*X.SEED_TERMS, "clown"], 1.0), {"vequ": 1.0}), X.ToxicParams())
    swapped = ["mroon", "iidot", "tarsh", "lsoer", "colwn"]
    for w in [*swapped, "dsigustnig", "mooronnn", "fuuuckkk", "m0r0n", "vequx"]:
        assert s.features(f"so {w} it is") != (0.0, 0.0, 0.0), w


def test_filter_before_the_automaton_loses_nothing():
    import random

    r = random.Random(11)
    lex = X.Lexicon({t: 0.5 + i / 100 for i, t in enumerate(X.SEED_TERMS)}, {"vequ": 1.0, "achlich": 0.8})
    s = X.Scorer(lex, X.ToxicParams())
    for _ in range(20_000):
        w = list(r.choice([*lex.terms, *lex.stems]))
        for _ in range(r.randint(0, 3)):
            i, c = r.randrange(len(w)), r.choice("abeimnorst0$")
            w[i : i + r.choice((0, 1, 1, 2))] = r.choice(([c], [], [c, c], w[i : i + 2][::-1]))
            w = w or ["x"]
        word = "".join(w)
        assert s.matched(word) == X.match(lex, word, s.p), word
        assert s.matched(word + "en") == X.match(lex, word + "en", s.p), word


def test_misspelled_beginnings_and_whole_words_under_a_stem(spark):
    s = X.Scorer(X.Lexicon({}, {"réeuxa": 1.0, "achlich": 1.0, "vequ": 1.0}), X.ToxicParams())
    for w in ("réuexadu", "réexadu", "réeuxxadu", "achlcihen", "aclichen", "achlicen", "achlich"):
        assert s.features(f"so {w} it is")[2] > 0, w
    for w in ("veqabc", "reuadu", "xchlichen", "acch"):
        assert s.features(f"so {w} it is")[2] == 0, w
    # stem and whole words say the same of the label
    texts = [f"plain words here {'klumpor' if i % 12 else 'klumpix'}" if i % 6 == 0 else "plain words here alone" for i in range(600)]
    docs, marks = S.docs(spark, texts), spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(600)], "doc_id long, toxic int")
    assert {"klumpor", "klumpix"} <= set(X.learn(docs, marks).terms)


def test_toxicity_learns_without_held_out_rows(spark):
    import random

    r = random.Random(3)
    voc = [f"word{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(500):
        w = [r.choice(voc) for _ in range(30)]
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["grobix", "zentor", "klumpa" + r.choice("abcdef") * 2]))
        texts.append(" ".join(w))
        labels.append((i, int(bad)))
    docs, marks = S.docs(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int")
    lex = X.learn(docs, marks)
    assert {"grobix", "zentor"} <= set(lex.terms) and any("klumpaa".startswith(s) for s in lex.stems)
    rows = X.score_documents(S.clashing(docs), lex).collect()
    held = [x for x in rows if x.held_out]
    assert len(rows) == 500 and {x.doc_id for x in held} == {i for i in range(500) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(x.predicted == labels[x.doc_id][1] for x in held) and all(0 <= x.score <= 1 for x in rows)
    flipped = marks.withColumn("toxic", F.when(F.expr("crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = X.learn(docs, flipped)
    assert (again.terms, again.stems, again.model) == (lex.terms, lex.stems, lex.model)


def test_toxicity_awkward_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    lex = X.learn(S.awkward(spark), none)
    got = X.score_documents(S.clashing(S.awkward(spark)), lex).collect()
    assert len(got) == 11 and not any(r.predicted for r in got)
    assert X.score_documents(S.empty(spark), lex).count() == 0


def test_the_filter_before_the_automaton_loses_no_match():
    """Every word that the automaton matches is looked at: up to three random edits of terms and stems."""
    r = random.Random(11)
    terms = {w: 1.0 for w in ("moron", "idiot", "disgusting", "degenerate", "clown", "trash", "loser", "worthless")}
    stems = {w: 1.0 for w in ("stupid", "imbecil", "abcdefgh", "nast")}
    lex = X.Lexicon(terms, stems)
    scorer = X.Scorer(lex, X.ToxicParams())
    matched = 0
    for _ in range(30_000):
        w = r.choice([*terms, *stems]) + r.choice(["", "", "ity", "xq"])
        for _ in range(r.randint(0, 3)):
            i = r.randrange(len(w))
            w = r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("abcdeimnorstuy") + w[i:], w[:i] + r.choice("aeinost") + w[i + 1 :], w[: i - 1] + w[i : i + 1] + w[i - 1 : i] + w[i + 1 :] if i else w]) or "x"
        if X.match(lex, w, scorer.p):
            matched += 1
            assert scorer.maybe(w), w
    assert matched > 3000
