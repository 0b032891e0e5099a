import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiospark.llm import exact_dedup
from radiospark.llm.exact_dedup import exact_duplicates
from radiospark.llm.queries import OP4_SQL, op4_block_naming

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("kept", T.StringType())])


def brute(rows):
    groups = {}
    for i, (d, t, _) in enumerate(rows):
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(((d is None, d or 0, i), d))
    out = []
    for t, members in groups.items():
        first = min(members)
        for m in members:
            out.append((m[1], first[1], len(members), m is first, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "\n\t ", "a b", "a  b", "a\nb ", "a b c"] + ["".join(rng.choice("ab \n") for _ in range(rng.choice([5, 30, 64, 300]))) for _ in range(40)]
    base = "".join(rng.choice("xyz ") for _ in range(40_000))
    texts += [base, base[:-1] + "q", "q" + base[1:], base]
    rows = [(i, rng.choice(texts), "x") for i in range(200)] + [(i, t, "y") for i, t in enumerate(texts, 500)] + [(500, None, "y"), (None, "a b", "z"), (None, "only", "z")]
    got = exact_duplicates(spark.createDataFrame(rows, SCHEMA), block_bytes=32)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_different_blocks_of_one_digest(spark, monkeypatch):
    """With digests of one value the blocks themselves are compared."""
    rows = [(i, t, "x") for i, t in enumerate(["a" * 40, "b" * 40, "a" * 40, "c", "", None])]
    frame = spark.createDataFrame(rows, SCHEMA)
    cut = exact_dedup.cut
    monkeypatch.setattr(exact_dedup, "cut", lambda *args: cut(*args).withColumn("digest", F.when(F.col("block").isNotNull(), F.lit(b"same"))))
    assert sorted([tuple(r) for r in exact_duplicates(frame, block_bytes=16).collect()], key=str) == brute(rows)


def test_a_block_in_all_documents_and_a_very_long_text(spark):
    long = "head " * 400_000
    rows = [(i, "x" * 64 + str(i % 50), "x") for i in range(2000)] + [(9000, long, "x"), (9001, long + "z", "x"), (9002, long, "x")]
    got = exact_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(16), block_bytes=64)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    got = sorted(tuple(r) for r in op4_block_naming(spark, sf_dir).collect())
    assert got == sorted(con.execute(OP4_SQL).fetchall())
