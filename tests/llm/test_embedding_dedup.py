import math

import numpy as np
from pyspark.sql import types as T

from radiospark.llm import embedding_dedup as E
from radiospark.llm.graph import connected_components
from radiospark.llm.queries import op7_embedding_dedup

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("n_links", T.StringType())])


def brute(rows, threshold=0.95):
    def usable(r):
        return r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    links = [0] * len(rows)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    at = [k for k, r in enumerate(rows) if usable(r)]
    vectors = {k: np.array(np.float32(rows[k][1]), dtype=np.float64) for k in at}
    for n, a in enumerate(at):
        for b in at[n + 1 :]:
            x, y = vectors[a], vectors[b]
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a] += 1
                links[b] += 1
                p, q = find(rows[a][0]), find(rows[b][0])
                root[max(p, q)] = min(p, q)
    return sorted(((r[0], links[k], None if r[0] is None else find(r[0]), r[0] is not None and find(r[0]) == r[0]) for k, r in enumerate(rows)), key=str)


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 20))
    rows = [(int(i), (centres[i % 12] + rng.normal(size=20) * rng.choice([0.02, 0.2, 0.35])).tolist(), "x") for i in range(300)]
    chain = [(1000 + k, [math.cos(0.3 * k), math.sin(0.3 * k)], "x") for k in range(9)]
    odd = [(2000, None, "x"), (2001, [], "x"), (2002, [0.0] * 20, "x"), (2003, [float("nan")] * 20, "x"), (2004, [None] + [1.0] * 19, "x"), (2005, [float("inf")] * 20, "x"), (None, rows[0][1], "x"), (2006, [3.0], "x"), (2007, [5.0], "x"), (2008, [-5.0], "x")]
    rows += chain + odd + rows[:5] + [(3000 + k, rows[7][1], "x") for k in range(6)]
    got = E.near_duplicates(spark.createDataFrame(rows, SCHEMA), tile=32, stops=(2, 4, 9))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tiles_go_to_near_buckets_alone(spark, monkeypatch):
    """Bytes bound tiles and buckets, and a bucket out of reach is not sent to."""
    rng = np.random.default_rng(4)
    centres = np.eye(8)
    rows = [(i, (centres[i % 8] + rng.normal(size=8) * 0.02).tolist(), "x") for i in range(640)]
    monkeypatch.setattr(E, "TILE_BYTES", 16 * 64)
    sent = []
    where = E._sent
    monkeypatch.setattr(E, "_sent", lambda *args: sent.append(E.written(where(*args), "t")) or sent[0])
    got = E.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)
    tiles = sent[0].select("tile").distinct().count()
    assert tiles >= 40 and sent[0].count() < 6 * tiles


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted([tuple(r) for r in op7_embedding_dedup(spark, sf_dir).collect()], key=str) == brute(rows)


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (2000, 2001)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(len(edges)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {k: v for k, v in root.items() if k != v}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_boxes_of_boxes_lose_no_link(spark, monkeypatch):
    """Many buckets of small tiles under boxes of three: the same links, and tiles are sent to few groups."""
    monkeypatch.setattr(E, "BOXED", 3)
    monkeypatch.setattr(E, "LEAST_BUCKETS", 25)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 6)) * 3
    rows = [(int(i), (centres[i % 40] + rng.normal(size=6) * 0.4).tolist(), "x") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = E.near_duplicates(df, tile=8)
    assert sorted((tuple(r) for r in got.select("vec_id", "n_links", "component_id", "kept").collect()), key=str) == brute(rows)
    nodes = E._usable(df.select("vec_id", E.F.col("embedding").alias("v")))
    basis = E.Shared(spark, E.axes([np.array(r[1]) for r in rows]))
    tiles = E.written(E._tiles(nodes, basis, 0.95, 8), "tiles")
    sent = E._sent(tiles, 25, 0.95).select("group", "tile").collect()
    assert len({(r["group"], r["tile"]) for r in sent}) == len(sent) < 0.7 * 25 * tiles.count()
