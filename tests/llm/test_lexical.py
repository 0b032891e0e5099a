"""Operator 11 against brute force and its SQL, exact bounds, and defined cases."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from radiospark.llm import lexical as lx
from radiospark.llm.queries import OP11_SQL

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=20):
    held = [(i, Counter(TERM.findall(t.translate(FOLD)))) for i, t in docs if t and TERM.search(t)]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        terms = Counter(TERM.findall((text or "").translate(FOLD)))
        scores = []
        for i, c in held:
            m = 100 - 25 + (25 * c.total() * n_docs) // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in terms.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, n + 1, i, -s) for n, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def got(spark, docs, items, **more):
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as n", "text as terms", "2 as item", "3 as ahead")
    i = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as size", "2 as batch", "text as counts")
    return sorted((tuple(r) for r in lx.rank(d, i, **more).select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def made():
    rng = random.Random(1)
    words = [f"w{int(rng.paretovariate(0.7)) % 700}" for _ in range(4000)] + ["Ünï", "日本", "x1", "A-B", "ZÉro"]
    text = lambda n: rng.choice([" ", "\n", "_", "-"]).join(rng.choice(words) for _ in range(n))
    topics = [text(30) for _ in range(12)]
    docs = [(i, rng.choice(topics) + " " + text(rng.randrange(60))) for i in range(700)] + [(i, "common copy " + topics[0]) for i in range(700, 1000)]
    docs += [(None, topics[1]), (None, topics[1]), (5, topics[2]), (5, topics[2]), (1001, None), (1002, ""), (1003, " .!\t"), (1004, "w1 " * 60_000 + "tail"), (1005, "long" * 100_000)]
    items = [(i, text(12)) for i in range(25)] + [(30, topics[0]), (30, topics[1]), (31, None), (32, ""), (33, "never seen"), (34, "w1 W1 w1 tail"), (None, topics[2]), (35, "long" * 100_000), (36, "common")]
    return docs, items


def test_against_brute_force(spark, made):
    want = brute(*made)
    assert got(spark, *made) == want
    assert got(spark, *made, segment=64, block=4, batch=500) == want
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", made[0]), ("benchmark", "item_id", made[1])):
        con.execute(f"create table {name} ({key} bigint, text varchar)")
        con.executemany(f"insert into {name} values (?, ?)", rows)
    assert sorted(con.execute(OP11_SQL).fetchall(), key=str) == want


def test_summaries_bound_every_document_of_a_block_and_blocks_are_left_out():
    rng = np.random.default_rng(2)
    n, size = 600, 400
    rows = [np.sort(rng.choice(np.arange(k % 4 * 90, k % 4 * 90 + 130), 20, replace=False)) for k in range(n)]
    terms, starts = np.concatenate(rows), np.arange(0, 20 * n + 1, 20)
    segment = lx.Segment(np.arange(n), starts, terms, rng.integers(1, 1_000_000, len(terms)), 16)
    for at in range(len(segment.known)):
        docs, begins, first, names, most = segment.blocks(at)
        assert sorted(docs.tolist()) == [k for k in range(n) if segment.known[at] in rows[k]]
        for b, begin in enumerate(begins):
            summary = dict(zip(names[first[b] :].tolist(), most[first[b] :].tolist())) if b == len(first) - 1 else dict(zip(names[first[b] : first[b + 1]].tolist(), most[first[b] : first[b + 1]].tolist()))
            want = {}
            for d in docs[begin : begin + 16].tolist():
                for t, v in zip(terms[20 * d : 20 * d + 20].tolist(), segment.values[20 * d : 20 * d + 20].tolist()):
                    want[t] = max(want.get(t, 0), v)
            assert summary == want
    left = 0
    for q in range(30):
        asked = np.sort(rng.choice(size, 8, replace=False))
        weights, best = rng.integers(1, 5000, 8), lx.Best(5)
        dense, seen = np.zeros(size, np.int64), np.zeros(n, bool)
        left += lx.search(segment, asked, weights, best, dense, seen)[1]
        assert not dense.any() and not seen.any()
        full = np.zeros(size, np.int64)
        full[asked] = weights
        scores = np.add.reduceat(segment.values * full[terms], starts[:-1])
        want = sorted((-int(s), k) for k, s in enumerate(scores) if s > 0)[:5]
        assert [(-s, i) for s, i in zip(best.scores.tolist(), best.ids.tolist())] == want
    assert left > 0


def test_terms_are_never_cut(monkeypatch):
    text = ("aB9 é-日本語 " * 50 + "z" * 300 + " end. ").encode()
    whole = [t for some in lx.terms_of(text) for t in some]
    for window in (1, 2, 3, 7, 64):
        monkeypatch.setattr(lx, "WINDOW", window)
        assert [t for some in lx.terms_of(text) for t in some] == whole


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == [] and got(spark, [(1, "a")], []) == [] and got(spark, [], []) == []
