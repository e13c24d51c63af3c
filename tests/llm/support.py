"""Small tables with the cases that every operator must stand, and brute-force helpers."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))


def docs(spark, texts, ids=None, lang="en"):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """Null, empty, blank, one word, very long, repeated rows, a null identifier, odd white space."""
    texts = [None, "", " \t\n", "one", LONG, LONG, "a b c", "a  b\tc", "a b c", "Ünï çødé   x y", "end "]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 7, None, 10]
    return docs(spark, texts, ids)


def clashing(df):
    """Extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in ("id", "key", "n", "rep", "digest", "length", "part", "kept", "norm", "token", "words", "block", "_s", "_kept", "_id", "_sha", "_chars", "_top", "_uid", "row_id", "row_forms", "seg", "edges", "component")})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def corpus(seed=7, n=120, vocab=400, words=(20, 160)):
    """Random texts with exact copies, near copies and shared passages."""
    r = random.Random(seed)
    voc = [f"v{i}" for i in range(vocab)]
    passage = [r.choice(voc) for _ in range(70)]
    out = []
    for i in range(n):
        k = r.random()
        if out and k < 0.15:
            out.append(r.choice(out))
        elif out and k < 0.4:
            w = r.choice(out).split()
            for _ in range(r.randint(1, 4)):
                w[r.randrange(len(w))] = r.choice(voc)
            out.append(" ".join(w))
        else:
            w = [r.choice(voc) for _ in range(r.randint(*words))]
            if k > 0.8:
                at = r.randrange(len(w))
                w[at:at] = passage
            out.append(" ".join(w))
    return out
