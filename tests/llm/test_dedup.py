import hashlib
import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest

from tests.llm import support as S
from tidemark.llm import exact_dedup as E
from tidemark.llm import jaccard_join as J
from tidemark.llm import substring_dedup as D

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_exact(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append((-len(t or ""), i is None, i or 0, i))
    return {k: (min(v)[3], len(v), hashlib.sha256(k.encode()).hexdigest()) for k, v in groups.items()}, norm


@pytest.mark.parametrize("bits", [8])
def test_exact_dedup_matches_brute_force(spark, bits):
    texts = S.corpus(n=60) + ["a b", "ab", " a b ", None, "", "\n"]
    df = S.docs(spark, texts)
    want, norm = brute_exact(list(enumerate(texts)))
    got = E.exact_dedup(df, digest_bits=bits, files_per_batch=1).collect()
    assert len(got) == len(texts)
    for r in got:
        keep, size, sha = want[norm(texts[r.id])]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (keep, size, r.id == keep, sha)


def test_locators_name_file_and_row(spark, tmp_path):
    S.docs(spark, ["a b", "c", "ab", "c c"]).coalesce(1).write.parquet(f"{tmp_path}/d")
    got = {r.id: r.keep_locator for r in E.exact_dedup(spark.read.parquet(f"{tmp_path}/d")).collect()}
    assert got[0] == got[2] and got[0].endswith("#0") and got[3].endswith("#3") and ".parquet" in got[1]


def test_state_goes_on_where_it_ended(spark, tmp_path):
    """Two runs over a growing source with the same folders: entries keep their counts, no digest is forgotten."""
    source, sink, at = (f"{tmp_path}/{x}" for x in ("keys", "sink", "state"))
    for texts, ids in ((["x y", "z"], [5, 6]), (["xy ", "w"], [3, 9])):
        E.keyed_rows(S.docs(spark, texts, ids)).write.mode("append").parquet(source)
        state = {r.keep_id: r.n for r in E.stream_state(spark, source, sink, at).collect()}
    assert state == {3: 2, 6: 1, 9: 1}


def test_exact_dedup_awkward_rows(spark):
    df = S.clashing(S.awkward(spark))
    got = E.exact_dedup(df).collect()
    assert len(got) == 11
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    kept = E.keep_first(df)
    assert kept.columns == df.columns and kept.count() == len({r.text_sha256 for r in got})
    assert E.exact_dedup(S.empty(spark)).count() == 0


def shingles(t, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return set() if not w else {tuple(w)} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute_components(texts, k, num, den):
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j]:
                inter = len(sets[i] & sets[j])
                if den * inter >= num * (len(sets[i]) + len(sets[j]) - inter):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize(("k", "num", "den", "pairwise"), [(3, 9, 10, 16), (5, 4, 5, 2), (1, 7, 10, 3)])
def test_near_duplicates_match_brute_force(spark, k, num, den, pairwise):
    texts = S.corpus(seed=k + num, n=80) + ["A b C", "a B c", "x", "", None, "a b"]
    p = J.JaccardParams(k=k, num=num, den=den, pairwise=pairwise)
    comp, sizes = brute_components(texts, k, num, den)
    got = {r.id: r for r in J.near_duplicates(S.docs(spark, texts), p).collect()}
    assert len(got) == len(texts)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (sizes[i], comp[i]) for i in range(len(texts))}


def test_large_group_of_near_copies_stays_one_component(spark):
    base = [f"t{i}" for i in range(200)]
    texts = [" ".join(base[:i] + [f"e{i}"] + base[i + 1 :]) for i in range(60)]
    out = J.near_duplicates(S.docs(spark, texts), J.JaccardParams(k=3, num=9, den=10)).collect()
    assert {r.component_id for r in out} == {0}


@pytest.mark.parametrize("pairwise", [16, 2])
def test_each_pair_is_verified_once_and_no_link_is_lost(spark, pairwise, monkeypatch):
    """A large group of near copies of which not all reach one another, through lists, long lists and hubs."""
    r = random.Random(3)
    base = [f"t{i}" for i in range(150)]
    texts = []
    for i in range(90):
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(150)] = r.choice(["q", "z", f"e{i}"])
        texts.append(" ".join(w))
    judged = []
    verify = J._sketched
    monkeypatch.setattr(J, "_sketched", lambda pairs, *more: (judged.extend(map(tuple, pairs.collect())), verify(pairs, *more))[1])
    got = {x.id: x.component_id for x in J.near_duplicates(S.docs(spark, texts), J.JaccardParams(k=3, num=9, den=10, pairwise=pairwise)).collect()}
    assert got == dict(enumerate(brute_components(texts, 3, 9, 10)[0]))
    assert len(judged) == len(set(judged)) and len(judged) < 90 * 89 / 2


def test_near_duplicates_awkward_rows(spark):
    df = S.clashing(S.awkward(spark))
    got = J.near_duplicates(df).collect()
    assert len(got) == 11
    by = {(r.id, r.n_shingles): r.component_id for r in got}
    assert by[(1, 0)] == 1 and by[(6, max(n for _, n in by))] == 5 and by[(8, 1)] == 7
    assert J.near_duplicates(S.empty(spark)).count() == 0


def test_repeated_identifiers_link_their_rows(spark):
    df = S.docs(spark, ["p q r s t u", "k l m n o p", "k l m n o p"], [5, 5, 9])
    assert {(r.id, r.component_id) for r in J.near_duplicates(df).collect()} == {(5, 5), (9, 5)}


def brute_substring(rows, k):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for p in range(len(w) - k + 1):
            s = tuple(w[p : p + k])
            first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for p in range(len(w) - k + 1):
            if first[tuple(w[p : p + k])] < i:
                gone |= set(range(p, p + k))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("k", "segment"), [(13, 32), (13, 3), (50, 32)])
def test_substring_dedup_matches_brute_force(spark, k, segment):
    texts = S.corpus(seed=k, n=90, vocab=60) + ["z z z z z z z z z z z z z z z z z z z", "z z z z z z z z z z z z z z", None, "", "q"]
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts)]
    df = S.docs(spark, texts, [i for i, _ in rows])
    got = D.substring_dedup(df, D.SubstringParams(k=k, segment=segment)).select("id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute_substring(rows, k))


def test_substring_workers_take_bounded_texts_at_once(spark, monkeypatch):
    """Python gets small batches wherever texts are taken apart, and takes them apart in smaller slices still."""
    batch = pa.RecordBatch.from_pydict({"id": list(range(40)), "text": ["word " * 20_000] * 39 + ["word " * 200_000]})
    slices = [(hi - lo, len(words.data)) for lo, hi, words, _, _ in D._slices(batch)]
    assert sum(n for n, _ in slices) == 40
    assert all(size <= 600_000 or n == 1 for n, size in slices)
    made = {}
    table = D.Scratch.table

    def noted(self, df, name, keep=False, batch_bytes=None):
        made[name] = batch_bytes
        return table(self, df, name, keep, **({"batch_bytes": batch_bytes} if batch_bytes else {}))

    monkeypatch.setattr(D.Scratch, "table", noted)
    passage = " ".join(f"p{i}" for i in range(30))
    got = D.substring_dedup(S.docs(spark, [f"a {passage} b", f"c {passage} d"]), D.SubstringParams(k=13)).collect()
    assert {r.id: r.n_removed for r in got} == {0: 0, 1: 30}
    assert all(made[f"substring-{x}"] == 2 << 20 for x in ("scan", "runs", "sources", "cut"))


def test_substring_dedup_awkward_rows(spark):
    df = S.clashing(S.awkward(spark))
    got = D.substring_dedup(df).collect()
    assert len(got) == 11
    assert {r.id: r.n_removed for r in got}[6] == 30_000
    out = D.remove_repeats(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id or 0 for r in out.select("doc_id").collect()) == [0, 1, 2, 3, 4, 5, 7, 7, 8, 10]
    assert D.substring_dedup(S.empty(spark)).count() == 0


def test_long_passage_is_cut_from_later_documents(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"start {passage} end", f"other {passage} words here", "clean text"]
    out = {r.doc_id: r.text for r in D.remove_repeats(S.docs(spark, texts)).collect()}
    assert out == {0: texts[0], 1: "other words here", 2: "clean text"}
