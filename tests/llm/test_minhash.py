import random
import re

import numpy as np
from pyspark.sql import types as T

from radiospark.llm import minhash as M
from radiospark.llm.queries import op3_dart_minhash

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("class_id", T.StringType())])
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, threshold=0.8):
    """Classes by all pairs that share a shingle."""
    sets = {}
    for d, t, *_ in rows:
        sets.setdefault(shingles(t), []).append(d)
    root = {d: d for d, *_ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def join(x, y):
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)

    having = {}
    for s, ids in sets.items():
        if s:
            for d in ids:
                join(ids[0], d)
            for x in s:
                having.setdefault(x, []).append(s)
    for s, ids in sets.items():
        for other in {o for x in s for o in having[x]}:
            if len(s & other) >= threshold * len(s | other):
                join(ids[0], sets[other][0])
    return {d: find(d) for d, *_ in rows}


def test_shingles_are_those_of_the_words():
    texts = ["", " \n", "One", "a b c d", "a b c d e", "a b c d e f", "A b C d e a b c d e a", "é b c d e é b c d e é"]
    elements, times, sizes = M.shingle_sets([t.encode() for t in texts])
    assert sizes.tolist() == [len(shingles(t)) for t in texts]
    assert times.sum() == sum(max(1, len(t.split()) - 4) if t.split() else 0 for t in texts)
    alone = np.concatenate([M.shingle_sets([t.encode()])[0] for t in texts])
    assert (alone == elements).all()


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    for size, top in ((3, 1.0), (40, 1.0), (40, 6.0), (3000, 1.0), (50_000, 1.0)):
        x = rng.uniform(0.2, top, size) if top > 1 else np.ones(size)
        y = np.where(rng.random(size) < 0.7, x, rng.uniform(0.2, top, size) if top > 1 else 0)
        true = np.minimum(x, y).sum() / np.maximum(x, y).sum()
        e = rng.integers(0, 2**63, size).astype(np.uint64)
        a, b = (M.signatures(e[v > 0], v[v > 0], np.array([(v > 0).sum()]), 1024)[0] for v in (x, y))
        assert (a != M._FILL).all() and abs((a == b).mean() - true) < 0.06, (size, top, true, (a == b).mean())
    together = M.signatures(np.concatenate([e, e[:100]]), np.ones(len(e) + 100), np.array([len(e), 0, 100]))
    assert (together[2] == M.signatures(e[:100], np.ones(100), np.array([100]))[0]).all() and (together[1] == M._FILL).all()


def test_against_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []

    def add(words):
        rows.append((len(rows), " ".join(words), "x"))

    for _ in range(40):  # groups of near copies, at all distances
        base = [word() for _ in range(rng.choice([4, 12, 60, 300]))]
        for _ in range(rng.choice([1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = word()
            add(copy)
    for _ in range(150):  # unlike texts around one passage
        add([word() for _ in range(rng.randrange(20, 60))] + passage + [word() for _ in range(20)])
    for _ in range(120):  # one large group of near copies
        copy = passage * 2
        copy[rng.randrange(len(copy))] = word()
        add(copy)
    rows += [(5000, None, "x"), (5001, "", "x"), (5002, " \n", "x"), (5003, rows[0][1].upper(), "x"), (5003, rows[0][1].upper(), "x")]
    got = M.classes(spark.createDataFrame(rows + [(None, "only this one has these words", "x")], SCHEMA)).collect()
    want = brute(rows)
    assert len(got) == len(rows) + 1
    for r in got:
        if r["doc_id"] is None:
            assert r["class_id"] is None and r["kept"]
        else:
            assert r["class_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["class_id"])
    assert M.classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_inside_a_crowd(spark):
    """A large family, less than alike to each other, holds pairs that are alike."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(400)]
    rows = []

    def changed(words, times):
        copy = list(words)
        for at in rng.sample(range(0, 400, 6), times):
            copy[at] = word()
        rows.append((len(rows), " ".join(copy), "x"))
        return copy

    for k in range(400):  # 0.73 to 0.80 to most others
        one = changed(base, 6)
        if k % 6 == 0:  # about 0.84 to one of them
            changed(one, 7)
    sets = [shingles(t) for _, t, _ in rows]
    at = {x: k for k, x in enumerate(set().union(*sets))}
    table = np.zeros((len(sets), len(at)), dtype=np.float32)
    for k, s in enumerate(sets):
        table[k, [at[x] for x in s]] = 1
    both, sizes = table @ table.T, table.sum(axis=1)
    alike, want = both >= 0.8 * (sizes[:, None] + sizes - both), np.arange(len(sets))
    for _ in range(len(sets)):
        want = np.where(alike, want, len(sets)).min(axis=1)
    assert 60 <= (want != np.arange(len(sets))).sum() <= 300
    got = {r["doc_id"]: r["class_id"] for r in M.classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[k] for k in range(len(sets))] == want.tolist()


def test_common_elements():
    rng = np.random.default_rng(2)
    sets = [np.unique(np.concatenate([rng.integers(0, 60, 40), rng.integers(0, 4000, 60)]).astype(np.uint64)) for _ in range(230)] + [np.zeros(0, np.uint64)]
    a, b = sets[:120], sets[100:]
    assert (M.common(a, b) == [[len(np.intersect1d(x, y)) for y in b] for x in a]).all()


def test_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: r["class_id"] for r in op3_dart_minhash(spark, sf_dir).collect()}
    assert got == brute(rows)
