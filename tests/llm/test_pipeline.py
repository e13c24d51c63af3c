import itertools
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
from pyspark.core.rdd import PipelinedRDD
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.conftest import DATA
from tests.llm import support as S
from tests.llm.test_dedup import WORD, brute_components, brute_exact
from tests.llm.test_text import brute_quality
from tidemark.llm import quality_rules as Q
from tidemark.llm import tokens
from tidemark.llm.tokens import default_path

KEEP = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_one_another(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = docs.count()
    for k, (_, stage) in enumerate(P.STAGES):
        path = f"{P.materialize(docs, 'stage').inputFiles()[0].rsplit('/', 1)[0]}"
        out = stage(spark, spark.read.parquet(path), DATA)
        if k < len(P.STAGES) - 1:
            assert out.columns == KEEP
            n = out.count()
            assert 0 < n <= before
            before = n
        docs = out
    packed = docs.collect()
    assert len({r.doc_id for r in packed}) == before


def test_stages_stand_awkward_tables(spark):
    for df in (S.empty(spark), S.awkward(spark)):
        for _, stage in P.STAGES[:-1]:
            assert stage(spark, df, DATA).select(KEEP).count() <= df.count()
        P.STAGES[-1][1](spark, df, DATA).count()


def test_decisions_take_effect(spark):
    clean = [" ".join(f"{a}{i}" for i in range(j, j + 80)) for j, a in enumerate("abc")]
    texts = [clean[0], clean[0] + " ", clean[1], clean[1] + " tail", clean[2], "too short"]
    df = S.docs(spark, texts)
    left = lambda stage: sorted(r.doc_id for r in stage(spark, df, DATA).collect())
    assert left(P.quality) == [0, 1, 2, 3, 4]
    assert left(P.exact) == [1, 2, 3, 4, 5]
    assert left(P.near) == [0, 2, 4, 5]


def brute_quality_verdicts(rows):
    """doc_id -> kept, from the definitions: base counts, then distances from the references of all documents."""
    rules = Q.Rules()
    classes, words, n_words = defaultdict(Counter), defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for key in (lang, None):
            classes[key].update(map(char_class, text))
            low = WORD.findall(text.lower())
            n_words[key] += len(low)
            words[key].update(w for w in low if len(w) <= rules.short_word)

    def distance(a, b):
        sa, sb = sum(a.values()), sum(b.values())
        if not sa or not sb:
            return 0.0
        keys = set(a) | set(b)
        p, q = [a[k] / sa for k in keys], [b[k] / sb for k in keys]
        kl = lambda x, y: sum(u * math.log2(u / ((u + v) / 2)) for u, v in zip(x, y) if u)
        return math.sqrt(max(0.0, (kl(p, q) + kl(q, p)) / 2))

    out = {}
    for i, text, lang in rows:
        base = brute_quality(text)
        ref = lang if n_words[lang] >= rules.min_reference_words else None
        common = [w for w, _ in sorted(words[ref].items(), key=lambda x: (-x[1], x[0]))[: rules.common_words]]
        cd = wd = 0.0
        if len(text) >= rules.min_chars_classes:
            own, all_ = Counter(map(char_class, text)), Counter(classes[ref])
            cd = distance(Counter({k: v for k, v in own.items() if k >= 0}), Counter({k: v for k, v in all_.items() if k >= 0}))
        low = WORD.findall(text.lower())
        if len(low) >= rules.min_words_common:
            hist = lambda c, n: Counter({w: c[w] for w in common}) + Counter({"": n - sum(c[w] for w in common)})
            wd = distance(hist(Counter(low), len(low)), hist(words[ref], n_words[ref]))
        out[i] = not base[-1] and cd <= rules.max_class_distance and wd <= rules.max_word_distance
    return out


def char_class(c):
    if c in " \t\v\f\r":
        return -1
    if c == "\n":
        return 7
    if ord(c) < 128:
        return 0 if c.islower() else 1 if c.isupper() else 3 if c.isdigit() else 4 if c in ".,;:!?'\"()-" else 6 if c in "#*$%&|<>@^~+=_\\/{}[]`" else 5
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else -1 if c.isspace() else 5


def test_the_whole_pipeline_matches_brute_force(spark, tmp_path):
    texts = S.corpus(seed=5, n=150, vocab=300, words=(55, 200)) + ["##### " * 80, "too short", "same word " * 70, "éà ü" * 100]
    texts += [texts[3] + " ", texts[4].replace(" ", "  ")]
    ids = [(i * 37) % 997 for i in range(len(texts))]
    S.docs(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    got = P.run(spark, str(tmp_path)).collect()

    good = brute_quality_verdicts([(i, t, "en") for i, t in zip(ids, texts)])
    rows = sorted((i, t) for i, t in zip(ids, texts) if good[i])
    assert 0 < len(rows) < len(texts)
    best, norm = brute_exact(rows)
    rows = [(i, t) for i, t in rows if best[norm(t)][0] == i]
    comp, _ = brute_components([t for _, t in rows], 5, 4, 5)
    rows = [r for k, r in enumerate(rows) if comp[k] == k]
    first = {}
    for i, t in rows:
        w = WORD.findall(t)
        for a in range(len(w) - 49):
            first.setdefault(tuple(w[a : a + 50]), i)
    want = {}
    for i, t in rows:
        w = WORD.findall(t)
        gone = {a + j for a in range(len(w) - 49) if first[tuple(w[a : a + 50])] < i for j in range(50)}
        if len(gone) < len(w):
            want[i] = " ".join(x for j, x in enumerate(w) if j not in gone) if gone else t
    assert any(t != dict(rows)[i] for i, t in want.items())
    lib = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    pieces = []
    for i, t in want.items():
        own = [*lib.encode(t, add_special_tokens=False).ids, 0]
        pieces.append((i, 0, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got) == sorted(pieces)
    for own in (g for _, g in itertools.groupby(sorted(got, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id)):
        end = 0
        for r in own:
            assert r.offset == end
            end += r.length
        assert end <= 2048


def test_a_run_leaves_the_tables_of_others(spark, tmp_path):
    """A query built before the pipeline ran still reads its tables after it."""
    from tidemark.llm import queries

    late = queries.op6_warc(spark, DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() > 0
    assert late.count() == spark.read.parquet(f"{DATA}/pages.parquet").count()


def private_mb():
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) // 1024


def test_a_worker_that_turns_to_other_work_gives_its_memory_back():
    """Token caches are many small pieces; without a word the allocator keeps them all while the next stages run."""
    before = private_mb()
    tokens._OPEN["test"] = [bytes(2000) for _ in range(100_000)]
    pin = bytes(2000)  # the last piece stays in use, so the heap can't shrink by itself
    assert private_mb() - before > 150
    tokens.forget()
    assert private_mb() - before < 60 and pin


def test_no_stage_starts_workers_beside_those_of_its_arrow_tasks(spark, monkeypatch):
    """An RDD of Python's, even an empty one, has a daemon and workers of its own on each executor: 84 MB that do nothing."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(60)
    docs = docs.union(docs.withColumn("doc_id", docs.doc_id + 1_000_000))

    def refused(*args, **more):
        raise AssertionError("an RDD of Python's")

    monkeypatch.setattr(PipelinedRDD, "__init__", refused)
    for _, stage in P.STAGES:
        assert stage(spark, docs, DATA).count() > 0
