import re

import numpy as np
from pyspark.sql import types as T

from radiospark.llm import mixing
from radiospark.llm.common import written
from radiospark.llm.queries import op9_mixing

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("text", T.StringType()), T.StructField("size", T.StringType())])


def brute_targets(sizes):
    """Reshare the excess until nothing is above its limit."""
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 2 * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / w for s in open_}
            break
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return out


def check(rows, got, block):
    size = {}
    for _, s, t, *_ in rows:
        size[s] = size.get(s, 0) + len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    want = brute_targets(size)
    taken = {}
    for r in got:
        assert r["taken"] <= 2 * r["size"] and r["source_size"] == size[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in size:
        assert abs(taken[s] - want[s]) <= 2 * block, (s, taken[s], want[s])


def test_report_on_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    source = {r[0]: r[1] for r in rows}
    got = [r.asDict() | {"source": source[r["doc_id"]]} for r in op9_mixing(spark, sf_dir).collect()]
    assert len(got) == len(rows)
    check(rows, got, mixing.BLOCK_WORDS)
    again = {r["doc_id"]: r["taken"] for r in op9_mixing(spark, sf_dir).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_nulls_small_sources_and_repeats(spark):
    rows = [(1, None, "a b c", "x"), (2, "b", None, "x"), (3, "b", "", "x"), (4, "a", "one two\nthree " * 50, "x"), (4, "a", "one two\nthree " * 50, "x"), (None, "c", " w " * 30, "x"), (7, "zz", "", "x"), (8, "\U0001f642", "a " * 99, "x"), (9, "～", "b " * 70, "x")]
    report = mixing.mix_report(spark.createDataFrame(rows, SCHEMA), block_words=8).collect()
    source = {(r[0], len((r[2] or "").split())): r[1] for r in rows}
    check(rows, [r.asDict() | {"source": source[(r["doc_id"], r["size"])]} for r in report], 8)
    assert len(report) == len(rows)
    assert mixing.mix_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_permutations():
    for n in (1, 2, 3, 7, 100, 1000):
        x = np.arange(n)
        assert sorted(mixing.permuted(x, np.full(n, n), np.full(n, 9, dtype=np.uint64)).tolist()) == x.tolist()


def test_draws_of_few_and_of_many_sources(spark):
    few = spark.createDataFrame([(0, 30_000, 40_000), (1, 2, 3), (2, 5, 0), (3, 9_999, 9_999)], "s long, blocks long, quota long")
    many = spark.range(10_000).selectExpr("id as s", "id % 7 + 1 as blocks", "id % 5 as quota")
    for given, group in ((few, mixing.GROUP), (few, 2), (many, 512)):
        got = mixing.draws(given, shard_blocks=512, group=group).collect()
        quota = {r["s"]: r["quota"] for r in given.collect()}
        total = dict.fromkeys(quota, 0)
        for r in sorted(got, key=lambda r: (r["s"], r["shard"])):
            assert r["n"] > 0 and r["first"] == total[r["s"]]
            total[r["s"]] += r["n"]
        assert total == quota
        shards = {}
        for r in got:
            shards[r["shard"]] = shards.get(r["shard"], 0) + r["n"]
        assert len(shards) == -(-sum(quota.values()) // 512) and max(shards.values()) < 1.5 * 512


def test_the_mix_depends_on_data_and_seed_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(docs.limit(5))  # repeated rows are interchangeable
    found = []
    for parts, cores in ((1, "8"), (3, "5"), (17, "3")):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", cores)
        dealt = docs.repartition(parts, "n_chars").sortWithinPartitions("lang", "n_chars")
        found.append(sorted(map(tuple, mixing.mix_report(dealt).collect())))
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
    assert sorted(map(tuple, mixing.mix_report(docs, seed=18).collect())) != found[0]


def test_a_very_long_text(spark):
    rows = [(1, "a", "word " * 1_000_000, "x"), (2, "b", "some other words " * 50, "x")]
    report = mixing.mix_report(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, [r.asDict() | {"source": "ab"[r["doc_id"] - 1]} for r in report], mixing.BLOCK_WORDS)


def test_documents_as_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    report = {r["doc_id"]: r for r in mixing.mix_report(docs, block_words=16).collect()}
    mixed = mixing.mixed_documents(docs, block_words=16)
    assert mixed.columns == docs.columns
    words, original = {}, {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixed.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(re.findall("[^\x20\x09-\x0d]+", r["text"]))
        assert all(part in original[r["doc_id"]] for part in [r["text"]][: len(r["text"]) == len(original[r["doc_id"]])])
    assert {d: n for d, n in words.items()} == {d: r["taken"] for d, r in report.items() if r["taken"]}
    blocks = mixing.mixed_blocks(docs, block_words=16).collect()
    assert sum(x["end"] - x["first"] for b in blocks for x in b["spans"]) == sum(words.values())


def test_one_python_function_a_task(spark, sf_dir, monkeypatch):
    """Spark keeps the workers of all functions that a task runs at once, so no table of the mix comes from two of them."""
    found = {}

    def watched(df, label):
        found[label] = df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
        return written(df, label)

    monkeypatch.setattr(mixing, "written", watched)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    found["mix"] = mixing.mixed_documents(docs, block_words=16)._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
    assert {"sizes", "drawn", "slots", "mix"} <= set(found)
    assert max(found.values()) == 1, found
