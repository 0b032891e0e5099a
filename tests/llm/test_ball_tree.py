"""Operator 12 against brute force and its SQL, bounds, and defined cases."""

import duckdb
import numpy as np
import pytest

from radiospark.llm import ball_tree as bt
from radiospark.llm.queries import OP12_SQL, op12_ball_tree_search

VECTORS = "vec_id long, embedding array<double>"


def brute(rows, k=10, step=100):
    fine = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in sorted({(i, tuple(v)) for i, v in fine if i % step == 0}):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def got(df, **more):
    return sorted(tuple(r) for r in bt.top_k(df, **more).select("query_id", "rank", "vec_id", "score").collect())


def test_bounds_hold_and_search_is_exact():
    rng = np.random.default_rng(1)
    rows = np.floor(1024 * np.concatenate([rng.normal(size=(300, 3)), rng.normal(size=(300, 3)) * 0.05 + 3])).astype(np.int64)
    tree = bt.Tree(np.arange(600), rows, 16)
    queries = rows[::50]
    bounds = bt.upper(queries.astype(float), tree.centres, tree.radii)
    for n, (a, b, _, _) in enumerate(tree.nodes):
        assert (bounds[:, n] >= (queries @ tree.rows[a:b].T).max(axis=1)).all()
    best = bt.Best(np.arange(0, 600, 50), queries, 5, np.full(12, bt.NO_SCORE), np.full(12, bt.NO_ID))
    bt.search(best, bt.Tree.read(tree.row(), 16))
    for q in range(12):
        want = sorted((-int(queries[q] @ rows[i]), i) for i in range(600) if i != q * 50)[:5]
        assert [(-s, i) for s, i in zip(best.scores[q].tolist(), best.found[q].tolist())] == want
    alone = bt.Best(np.array([550]), queries[11:], 5, np.full(1, bt.NO_SCORE), np.full(1, bt.NO_ID))
    assert bt.search(alone, tree) < sum(n[2] < 0 for n in tree.nodes) / 2  # most balls are ruled out


def test_large_numbers_stay_whole():
    big = np.array([[1 << 40, 3], [5, 1 << 20]], np.int64)
    assert bt.products(big[:1], big, 1 << 40 >> 20).tolist() == (big[:1] @ big.T).tolist()
    with pytest.raises(ArithmeticError):
        bt.products(big, big, 1 << 40)


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    made = [(i, (rng.normal(size=8) + 4 * (i % 5)).tolist()) for i in range(900)]
    made += [(i, [0.5] * 8) for i in range(900, 1300)]  # a very common vector
    made += [(i, rng.normal(size=3).tolist()) for i in range(1300, 1420)] + [(1500, [1.0]), (1600, []), (1601, []), (-100, [0.0] * 8), (-200, [-1.0] * 8)]
    made += [(1700, None), (1800, [None, 1.0]), (1900, [float("nan")]), (2000, [float("inf")] * 8), (None, [1.0] * 8), (2100, [2.0] * 8), (2100, [2.0] * 8), (7, [2.0] * 8), (7, [2.0] * 8)]
    df = spark.createDataFrame(made, VECTORS).selectExpr("*", "1 as dim", "2 as cell", "vec_id as pack", "3 as score")
    want = brute(made)
    assert got(df) == want
    assert got(df.repartition(7), shard=64, block=4, leaf=8) == want
    con = duckdb.connect()
    con.execute("create table embeddings (vec_id bigint, embedding double[])")
    con.executemany("insert into embeddings values (?, ?)", made)
    assert sorted(con.execute(OP12_SQL).fetchall()) == want


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in op12_ball_tree_search(spark, sf_dir).select("query_id", "rank", "vec_id", "score").collect()) == brute(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert got(empty) == [] and got(spark.createDataFrame([(100, [1.0])], VECTORS)) == []
