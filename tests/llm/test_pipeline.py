import hashlib
import re

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as P
from radiospark.llm import bpe, mixing, quality

from test_minhash import brute as near_classes

RANKS = bpe.load_ranks(public_tokenizers.path(P.RANKS))
ORACLE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}

    good = P.written(P.quality_filter(spark, docs, sf_dir), "t")
    assert good.columns == columns
    table = quality.fit(docs, labels)
    want = {d for d, r in rows.items() if quality.score([r["text"].encode()], table, quality.Settings())[0] >= 0.5}
    assert {r["doc_id"] for r in good.collect()} == want
    clean = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    assert len(clean & want) >= 0.95 * len(clean)

    exact = P.written(P.exact_duplicates(spark, good, sf_dir), "t")
    first = {}
    for d in sorted(want):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", rows[d]["text"]), d)
    assert exact.columns == columns and sorted(r["doc_id"] for r in exact.collect()) == sorted(first.values())

    near = P.written(P.near_duplicates(spark, exact, sf_dir), "t")
    classes = near_classes([(d, rows[d]["text"]) for d in first.values()])
    assert near.columns == columns and sorted(r["doc_id"] for r in near.collect()) == sorted(d for d, c in classes.items() if d == c)

    mixed = P.written(P.mix(spark, near, sf_dir), "t")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_report(near).collect()}
    words = {}
    for r in mixed.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(re.findall("[^\x20\x09-\x0d]+", r["text"]))
    assert mixed.columns == columns and words == {d: n for d, n in taken.items() if n}

    done = P.tokens(spark, mixed, sf_dir)
    spelled = lambda t: (len(ORACLE.encode_ordinary(t)), hashlib.sha256(",".join(map(str, ORACLE.encode_ordinary(t))).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in done.collect()) == sorted(spelled(r["text"]) for r in mixed.collect())
    assert P.run(spark, sf_dir).count() == mixed.count()


def test_null_ids_and_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    odd = docs.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id"))).unionByName(docs.withColumn("text", F.lit(None).cast("string")))
    for given in (odd, docs.where("false")):
        now = given
        for _, stage in P.STAGES:
            now = P.written(stage(spark, now, sf_dir), "t")
        assert now.count() <= 2 * given.count() and bool(now.count()) == bool(given.count())


def test_one_row_is_kept_whatever_the_ids(spark):
    """Repeated rows, null ids and ids with several texts: the rows decide."""
    words = [" ".join(f"{c}{k}" for k in range(60)) for c in "abcd"]
    near = words[0] + " more"
    rows = [(1, words[0]), (1, words[0]), (3, words[0]), (3, words[1]), (None, words[1]), (None, words[2]), (None, words[2]), (None, words[0]), (4, near), (None, near + " yet"), (5, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    exact = P.written(P.exact_duplicates(spark, docs, ""), "t")
    said = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    want = [(1, words[0]), (3, words[1]), (None, words[2]), (5, None)]
    assert exact.columns == docs.columns and said(exact) == sorted([*want, (4, near), (None, near + " yet")], key=str)
    assert said(P.near_duplicates(spark, exact, "")) == sorted(want, key=str)
    assert said(P.near_duplicates(spark, docs, "")) == sorted([*want, (None, "")], key=str)


def test_results_of_stages_do_not_touch_each_other(spark):
    """Two pipelines in one session, stage by stage, their results kept unread."""
    text = lambda n: " ".join(f"w{n}x{k}" for k in range(30))
    one = spark.createDataFrame([(1, text(1)), (2, text(1)), (3, text(2))], "doc_id long, text string")
    two = spark.createDataFrame([(7, text(3)), (8, text(3) + " more")], "doc_id long, text string")
    a = P.exact_duplicates(spark, one, "")
    b = P.near_duplicates(spark, two, "")
    c = P.near_duplicates(spark, a, "")
    d = P.exact_duplicates(spark, b, "")
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert ids(a) == [1, 3] and ids(b) == [7] and ids(c) == [1, 3] and ids(d) == [7]


def test_long_texts_and_clashing_names(spark):
    """Texts of over a MB, and further columns that bear the stages' own names, go through all stages but the classifier."""
    long = " ".join(f"word{k % 5000}{k // 5000}" for k in range(120_000))
    rows = [(1, long, "a"), (2, long + " end", "a"), (3, "x" * 1_200_000, "b"), (4, "short text of a few words here", None)]
    more = ["_row", "class_id", "kept", "keep_id", "group_size", "s", "size", "target", "taken", "rid", "n_tokens", "order"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit(c) for c in more if c != "_row"})
    now = docs
    for _, stage in P.STAGES[1:4]:
        now = P.written(stage(spark, now, ""), "t")
        assert now.columns == docs.columns
    assert {r["doc_id"] for r in now.collect()} <= {1, 3, 4}
    done = P.tokens(spark, now, "").collect()
    assert len(done) == now.count() and all(r["n_tokens"] > 0 for r in done)
