import numpy as np
from pyspark.sql import types as T

from radiospark.llm import toxicity as X
from radiospark.llm.common import labelled_sample
from radiospark.llm.queries import op6_toxicity

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType())])


def test_counts_of_stems():
    texts = [b"", b"Idiot, idiots! you-idiot", b"an idio", "ÉTÉ étéx".encode(), b"SHOUT LOUD a*** b!!"]
    hits, totals = X.stem_counts(texts, {"idiot": 0, "été": 1})
    assert hits.tolist() == [[0, 0], [3, 0], [0, 0], [0, 2], [0, 0]]
    assert totals.tolist() == [[0, 0, 0, 0], [3, 0, 0, 0], [2, 0, 0, 0], [2, 1, 0, 0], [4, 2, 1, 1]]
    again = [X.stem_counts([t], {"idiot": 0, "été": 1}) for t in texts]
    assert np.concatenate([h for h, _ in again]).tolist() == hits.tolist()


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    y = rng.random(6000) < 0.3
    voter = lambda right, fires: np.where(rng.random(6000) < fires, np.where((rng.random(6000) < right) == y, X.TOXIC, X.CLEAN), X.ABSTAIN)
    first = voter(0.85, 0.7)
    votes = np.stack([first, np.where(rng.random(6000) < 0.95, first, voter(0.85, 0.7)), voter(0.9, 0.6), voter(0.75, 0.9), voter(0.5, 0.5), voter(0.9, 1.0)], axis=1)
    posterior, blocks, right = X.label_model(votes)
    assert np.abs(right - [0.85, 0.85, 0.9, 0.75, 0.5, 0.9]).max() < 0.06
    assert [0, 1] in blocks and ((posterior > 0.5) == y).mean() > 0.93


def test_posteriors_beat_voters_and_their_majority():
    rng = np.random.default_rng(5)
    y = rng.random(8000) < 0.4
    rights = [0.9, 0.88, 0.62, 0.6, 0.58, 0.55]
    votes = np.stack([np.where(rng.random(8000) < 0.8, np.where((rng.random(8000) < r) == y, X.TOXIC, X.CLEAN), X.ABSTAIN) for r in rights], axis=1)
    posterior, _, _ = X.label_model(votes)
    hit = lambda guess: (guess == y).mean()
    majority = (votes == X.TOXIC).sum(axis=1) > (votes == X.CLEAN).sum(axis=1)
    single = max(hit(votes[:, v] == X.TOXIC) for v in range(len(rights)))
    assert hit(posterior > 0.5) > hit(majority) + 0.03 and hit(posterior > 0.5) > single + 0.03
    assert ((posterior > 0.05) & (posterior < 0.95)).mean() > 0.2  # unsure where votes differ


def test_wrong_labels_do_not_pass_through(spark):
    """Toxic rows that are labelled clean get the class that their votes say."""
    rows = [(k, ("horrid vile nasty " if k % 3 == 0 else "kind mild quiet ") + f"text {k % 17}", "x") for k in range(900)]
    labels = [(k, int(k % 3 == 0 and k % 90 != 0)) for k in range(900)]
    model = X.fit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    got = X.scored(spark.createDataFrame(rows, DOCS), model).collect()
    assert all(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in got)
    assert "label" not in model.accuracies


def test_logistic_is_at_its_minimum():
    rng = np.random.default_rng(2)
    x, target = rng.normal(size=(300, 4)), rng.random(300)
    w = X.logistic(x, target)
    loss = lambda v: (np.log1p(np.exp(x @ v)) - target * (x @ v)).sum() + 0.15 * (v @ v)
    assert all(loss(w) < loss(w + d) for d in 0.01 * np.concatenate([np.eye(4), -np.eye(4)]))


def test_a_very_long_text_and_repeated_rows_in_the_sample(spark):
    docs = [(k, "badword and more" if k % 2 else "and more good words", "x") for k in range(60)] * 20
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], LABELS)
    assert labelled_sample(spark.createDataFrame(docs, DOCS), labels, "toxic", 10).count() == 20
    model = X.fit(spark.createDataFrame(docs, DOCS), labels)
    long = spark.createDataFrame([(1, "calm words " * 300_000 + "badword", "x"), (2, "calm words " * 300_000, "x")], DOCS)
    scores = {r["doc_id"]: r["score"] for r in X.scored(long, model).select("doc_id", "score").collect()}
    assert scores[1] > scores[2]


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    got = op6_toxicity(spark, data).collect()
    assert len(got) == spark.read.parquet(f"{data}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    caught = [r["predicted"] for r in held if labels[r["doc_id"]] == 1]
    blamed = [r["predicted"] for r in held if labels[r["doc_id"]] == 0]
    assert len(caught) > 50 and sum(caught) / len(caught) > 0.85 and sum(blamed) / len(blamed) < 0.02


def test_nulls_no_labels_and_repeats(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "a b", "y"), (2, "", "z"), (2, "", "z")], DOCS)
    got = X.classify(docs, spark.createDataFrame([(1, None), (None, 1), (2, 1)], LABELS)).collect()
    assert len(got) == 4 and all(r["score"] == 0.5 and r["predicted"] == 0 for r in got)
    assert X.classify(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0
    trained = spark.createDataFrame([(k, "badword and more" if k % 2 else "and more good words", "x") for k in range(60)], DOCS)
    model = X.fit(trained, spark.createDataFrame([(k, k % 2) for k in range(60)], LABELS))
    assert model.stems and all("badword".startswith(s) for s in model.stems)
    wide = X.scored(docs, model)
    assert wide.columns == ["doc_id", "text", "in_score", "score", "predicted"]
    assert all(r["score"] < 0.5 for r in wide.collect())
