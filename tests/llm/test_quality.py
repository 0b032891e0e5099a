import zlib

import numpy as np
from pyspark.sql import types as T

from radiospark.llm import quality
from radiospark.llm.queries import op8_quality

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType())])


def plain_score(text, table, settings):
    """The average over the features, one after another."""
    at, times = quality.sparse(text, settings)
    return 1 / (1 + np.exp(-float((table[at].astype(np.float64) * times).sum() / times.sum())))


def test_scores_are_the_average_of_the_features():
    settings = quality.Settings(bits=12)
    table = np.random.default_rng(1).normal(size=1 << 12).astype(np.float32) * 5
    texts = [b"", b" \n", b"one", b"one one one two", "Ärger the the\tend".encode() * 20, b"x" * 3000]
    together = quality.score(texts, table, settings)
    assert np.allclose(together, [plain_score(t, table, settings) for t in texts])
    assert np.allclose(together, [quality.score([t], table, settings)[0] for t in texts])


def plain_train(rows, settings):
    """The same gradient descent, number by number."""
    rng = np.random.Generator(np.random.PCG64(settings.seed))
    vectors = [[float(x) for x in v] for v in rng.uniform(-1 / settings.dim, 1 / settings.dim, (1 << settings.bits, settings.dim))]
    softmax = [[0.0] * settings.dim for _ in (0, 1)]
    share, steps, done = [sum(r[0] == k for r in rows) / len(rows) for k in (0, 1)], settings.epochs * len(rows), 0
    for _ in range(settings.epochs):
        for k in rng.permutation(len(rows)):
            label, at, times = rows[k]
            rate, done, all_ = settings.rate * (1 - done / steps), done + 1, float(sum(times))
            hidden = [sum(float(t) / all_ * vectors[b][d] for b, t in zip(at, times)) for d in range(settings.dim)]
            odds = [sum(w * h for w, h in zip(row, hidden)) for row in softmax]
            p = [float(np.exp(o)) / sum(float(np.exp(x)) for x in odds) for o in odds]
            p = [0.5 / share[label] * (x - (c == label)) for c, x in enumerate(p)]
            back = [p[0] * softmax[0][d] + p[1] * softmax[1][d] for d in range(settings.dim)]
            softmax = [[w - rate * p[c] * h for w, h in zip(softmax[c], hidden)] for c in (0, 1)]
            for b, t in zip(at, times):
                vectors[b] = [v - float(t) / all_ * rate * g for v, g in zip(vectors[b], back)]
    return np.array([sum(v * (a - b) for v, a, b in zip(vec, softmax[1], softmax[0])) for vec in vectors])


def test_training_is_plain_gradient_descent():
    settings = quality.Settings(bits=6, dim=3, epochs=3, rate=0.5)
    rows = [(k % 3 == 0, *quality.sparse(t.encode(), settings)) for k, t in enumerate(["a b c", "some words here", "", "a a a", "other here", "c b"])]
    rows = [(int(label), at, times.astype(np.float32)) for label, at, times in rows]
    assert np.abs(quality.train(rows, settings) - plain_train(rows, settings)).max() < 1e-4


def test_a_very_long_training_text_keeps_its_counts(spark):
    docs = spark.createDataFrame([(k, ("good " if k % 2 else "bad ") * 70_000 + str(k), "x") for k in (2, 3, 5, 6, 8, 9)], DOCS)
    labels = spark.createDataFrame([(k, k % 2) for k in (2, 3, 5, 6, 8, 9)], LABELS)
    seen = []
    train, quality.train = quality.train, lambda rows, settings: seen.extend(rows) or train(rows, settings)
    try:
        table = quality.fit(docs, labels)
    finally:
        quality.train = train
    assert seen and all(times.max() >= 69_999 for _, _, times in seen)
    assert {r["doc_id"] % 2 == r["predicted"] for r in quality.scored(docs, table).collect()} == {True}


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    got = op8_quality(spark, data).collect()
    assert len(got) == spark.read.parquet(f"{data}/documents.parquet").count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    for value in (0, 1):
        hit = [r["predicted"] == value for r in held if labels[r["doc_id"]] == value]
        assert len(hit) > 10 and sum(hit) / len(hit) >= 0.9


def test_nulls_no_labels_and_repeats(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "a b", "y"), (2, "", "z"), (2, "", "z")], DOCS)
    none = spark.createDataFrame([(1, None), (None, 1), (2, 1)], LABELS)
    got = quality.classify(docs, none).collect()
    assert len(got) == 4 and all(r["score"] == 0.5 and r["predicted"] == 1 for r in got)
    assert not next(r for r in got if r["doc_id"] is None)["held_out"]
    assert quality.classify(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0
    wide = quality.scored(docs, np.zeros(1 << 18, np.float32))
    assert wide.columns == ["doc_id", "text", "in_score", "score", "predicted"] and wide.count() == 4


def test_the_driver_gives_back_what_training_took(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"{'good' if k % 2 else 'bad'} {k}", "x") for k in (2, 3, 5, 6)], DOCS)
    order, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda rows, settings: order.append("train") or train(rows, settings))
    monkeypatch.setattr(quality, "give_back", lambda: order.append("give_back"), raising=False)
    quality.fit(docs, spark.createDataFrame([(k, k % 2) for k in (2, 3, 5, 6)], LABELS))
    assert order == ["train", "give_back"]
