import hashlib
import random

import duckdb
import numpy as np
from pyspark.sql import types as T

from radiospark.llm import line_dedup as L
from radiospark.llm.queries import OP1_SQL, op1_line_dedup

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_lines", T.StringType())])
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, threshold, shortest=1):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    count = {}
    for _, t, _ in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            count[k] = count.get(k, 0) + 1
    out = []
    for d, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < shortest or count[key(x)] < threshold]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n, first=0):
    rng = random.Random(seed)
    pool = ["", " ", "A line", "a LINE \t", "éÉ", "ÉÉ", "x\rx"] + [f"line {i}" for i in range(60)]
    return [(first + i, rng.choice([None, "", "\n".join(rng.choices(pool, k=rng.randrange(1, 12)))]), "z") for i in range(n)]


def test_against_brute_force(spark):
    rows = corpus(1, 300) + [(None, "A line\nown", "q"), (5, "A line", "q"), (5, "A line", "q")]
    for threshold, shortest in ((10, 1), (3, 6), (1, 2)):
        got = L.report(spark.createDataFrame(rows, SCHEMA), threshold=threshold, shortest=shortest).collect()
        assert sorted([tuple(r) for r in got], key=str) == brute(rows, threshold, shortest)
    wide = L.cleaned(spark.createDataFrame(rows, SCHEMA))
    assert wide.columns == ["doc_id", "text", "in_n_lines", "n_lines", "n_dropped"]
    assert L.report(spark.createDataFrame([], SCHEMA)).count() == 0


def state(index):
    refs = sorted(tuple(r) for r in index.refs.collect())
    held = {r["shard"]: L.CuckooFilter.load(bytes(r["filter"])) for r in index.filters.collect()}
    return refs, held


def test_documents_come_and_go(spark):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    base, more = corpus(2, 120), corpus(3, 150, 1000)
    start = L.build(frame(base), threshold=20, shard_keys=8)
    grown = L.update(start, added=frame(more))
    back = L.update(grown, removed=frame(more))
    fresh = L.build(frame(base + more), threshold=20, shard_keys=8)
    assert state(grown)[0] == state(fresh)[0] and state(back)[0] == state(start)[0]
    for index in (start, grown, back):
        refs, held = state(index)
        for shard, filter_ in held.items():
            keys = [k2 for k1, k2, n in refs if n >= 20 and k1 % index.shards == shard]
            assert filter_.contains(np.array(keys, dtype=np.int64).view(np.uint64)).all()
            assert (filter_.table > 0).sum() == len(keys)
    rows = L.cleaned(frame(base), back).collect()
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows), key=str) == brute(base, 20)
    try:
        L.update(start, removed=frame(more))
        raise AssertionError
    except ValueError:
        pass


def test_filter_holds_what_it_is_given():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    filter_ = L.CuckooFilter.of(keys)
    assert filter_.contains(keys).all()
    filter_.delete(keys[:10_000])
    assert filter_.contains(keys[10_000:]).all() and filter_.contains(keys[:10_000]).mean() < 0.01


def test_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    assert sorted(tuple(r) for r in op1_line_dedup(spark, sf_dir).collect()) == sorted(con.execute(OP1_SQL).fetchall())
