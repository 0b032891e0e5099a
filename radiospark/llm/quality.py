"""Operator 8: a quality classifier on supervised subword embeddings.

A document is the average of learned vectors, found by hashing, of its words, their character n-grams (bytes of the word
between < and >), its word bigrams (a word that follows itself counts as one bigram, whatever the word) and one end mark.
A softmax over two classes reads the average. Vectors and softmax are trained by numpy stochastic gradient descent on the
driver, from the bounded sample of labelled rows that ``train_docs`` states.

Since the average is linear, a class score is the average of one number a bucket; only that table (4 * 2**bits bytes) is
broadcast, and tasks score whole texts of any length slice by slice, each distinct word of a slice once.

Defined cases: null and empty texts have the end mark alone; without labelled rows of both classes the score is 0.5;
a null label or an unlabelled row teaches nothing; repeated rows are scored each; an empty table gives an empty table;
a null id counts as the fold of the empty text (0), so it is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Shared, fold, give_back, labelled_sample, lean, mix64, pieces_of, release, renamed, token_hashes, written


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    dim: int = 12
    shortest: int = 3
    longest: int = 5
    epochs: int = 6
    rate: float = 8.0
    train_docs: int = 1500  # of each class at most
    seed: int = 11


_KEYS = np.random.Generator(np.random.PCG64(77)).integers(1, 2**64, (8, 256), dtype=np.uint64)
_SAME, _PAIR, _END = np.uint64(0x51), np.uint64(0xB5297A4D3F84D5B5), np.uint64(0x454E44)


def _subwords(words: list[bytes], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word numbers) of the character n-grams of all ``words``."""
    joined = np.frombuffer(b"".join([b"<" + w + b">" for w in words]), dtype=np.uint8)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    last = np.repeat(np.cumsum(sizes), sizes)
    buckets, owners = [], []
    value = np.zeros(len(joined), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, settings.longest + 1):
            m = max(0, len(joined) - n + 1)
            value = value[:m] + _KEYS[n - 1][joined[n - 1 : n - 1 + m]]
            if n >= settings.shortest:
                fits = np.arange(m) + n <= last[:m]
                buckets.append(mix64(value[fits] ^ np.uint64(n)) >> np.uint64(64 - settings.bits))
                owners.append(owner[:m][fits])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def _features(texts: list[bytes], settings: Settings):
    """What the texts' features come from: (words a text, bucket of each distinct word, its n-grams' buckets and owners,
    number of the distinct word at each place, bucket of the bigram at each place but a text's last, its text)."""
    hashes, counts, data, starts, ends = token_hashes(texts, lower=False)
    distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    raw = data.tobytes()
    grams, owners = _subwords([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())], settings)
    shift = np.uint64(64 - settings.bits)
    of_text = np.repeat(np.arange(len(texts)), counts)
    inner = of_text[1:] == of_text[:-1]
    left, right = hashes[:-1][inner], hashes[1:][inner]
    with np.errstate(over="ignore"):
        pairs = np.where(left == right, mix64(_SAME), mix64(left * _PAIR + right))
    return counts, (distinct >> shift).astype(np.int64), grams, owners, place, (pairs >> shift).astype(np.int64), of_text[1:][inner], of_text


def _end_bucket(settings: Settings) -> int:
    return int(mix64(np.array([_END], dtype=np.uint64))[0] >> np.uint64(64 - settings.bits))


def sparse(text: bytes, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """A text's distinct buckets and how often it has each."""
    _, words, grams, owners, place, pairs, _, _ = _features([text], settings)
    times = np.bincount(place, minlength=len(words)).astype(np.float64)
    every = np.concatenate([words, grams, pairs, [_end_bucket(settings)]])
    weight = np.concatenate([times, times[owners], np.ones(len(pairs) + 1)])
    at, number = np.unique(every, return_inverse=True)
    return at.astype(np.int32), np.bincount(number, weights=weight)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings) -> np.ndarray:
    """One number a bucket: what a feature adds to the log-odds of label 1. rows: (label, buckets, counts)."""
    if len({label for label, *_ in rows}) < 2:
        return np.zeros(1 << settings.bits, dtype=np.float32)
    rng = np.random.Generator(np.random.PCG64(settings.seed))
    vectors = rng.uniform(-1 / settings.dim, 1 / settings.dim, (1 << settings.bits, settings.dim)).astype(np.float32)
    softmax = np.zeros((2, settings.dim), dtype=np.float32)
    steps, done = settings.epochs * len(rows), 0
    share = [np.bincount([x[0] for x in rows], minlength=2)[k] / len(rows) for k in (0, 1)]
    for _ in range(settings.epochs):
        for k in rng.permutation(len(rows)):
            label, at, times = rows[k]
            rate = settings.rate * (1 - done / steps)
            done += 1
            weight = (times / times.sum())[:, None]
            hidden = (weight * vectors[at]).sum(axis=0)
            odds = softmax @ hidden
            p = np.exp(odds - odds.max())
            p /= p.sum()
            p[label] -= 1
            p *= 0.5 / share[label]
            back = p @ softmax
            softmax -= (rate * np.outer(p, hidden)).astype(np.float32)
            vectors[at] -= weight * (rate * back).astype(np.float32)
    return vectors @ (softmax[1] - softmax[0])


def score(texts: list[bytes], table: np.ndarray, settings: Settings) -> np.ndarray:
    """Probability of label 1 of each text."""
    counts, words, grams, owners, place, pairs, pair_text, of_text = _features(texts, settings)
    own = table[words].astype(np.float64) + np.bincount(owners, weights=table[grams], minlength=len(words))
    many = 1.0 + np.bincount(owners, minlength=len(words))
    n = len(texts)
    total = np.bincount(of_text, weights=own[place], minlength=n) + np.bincount(pair_text, weights=table[pairs], minlength=n) + table[_end_bucket(settings)]
    size = np.bincount(of_text, weights=many[place], minlength=n) + np.bincount(pair_text, minlength=n) + 1
    return 1 / (1 + np.exp(-np.clip(total / size, -60, 60)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings()) -> np.ndarray:
    """Train on a bounded sample of the labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, label, settings.train_docs)
    schema = "doc_id string, label int, at binary, times binary"

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces_of(batch, "text"):
                made = [sparse(t, settings) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array([a.tobytes() for a, _ in made], pa.binary()), pa.array([t.astype(np.uint32).tobytes() for _, t in made], pa.binary())],
                    names=["doc_id", "label", "at", "times"],
                )

    # Written by all tasks at once; then read in part after part, so that the driver never holds two copies.
    found = written(sample.select(F.col("doc_id").cast("string"), "label", "text").mapInArrow(run, schema), "sample")
    rows = [(r["doc_id"], r["label"], np.frombuffer(r["at"], np.int32), np.frombuffer(r["times"], np.uint32).astype(np.float32)) for r in found.toLocalIterator()]
    release(found)
    rows.sort(key=lambda r: (r[0], r[2].tobytes()))
    table = train([r[1:] for r in rows], settings)
    del rows
    give_back()  # the driver goes on with the table alone
    return table


def scored(docs: DataFrame, table: np.ndarray, threshold: float = 0.5, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with score and predicted (1 if score >= threshold, else 0)."""
    source = renamed(docs, {"score", "predicted"})
    shared = Shared(docs.sparkSession, np.asarray(table, dtype=np.float32))
    schema = T.StructType([*source.schema.fields, T.StructField("score", T.DoubleType())])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces_of(batch, "text", 2 << 20):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score(texts, shared.value, settings), pa.float64())], names=schema.fieldNames())

    return source.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.5, settings: Settings = Settings()) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    table = fit(docs, labels, label, settings)
    done = scored(docs.select("doc_id", "text"), table, threshold, settings)
    return done.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")
