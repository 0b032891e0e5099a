"""Operator 6: toxicity by weak supervision.

Voters look at whole texts: each lexicon voter looks for words that begin with one stem (or are it, for stems that end in $), pattern voters at shouting,
masked words, exclamation and texts without any stem. The stems are found in the bounded sample of labelled rows: word
beginnings that toxic rows have and others do not, chosen until each toxic row is covered a few times.

A generative label model explains the votes (toxic, clean, abstain) of the sample by a hidden class. It never sees a
label: it starts from the balance of votes, and labels serve to choose the stems and, in the end, to say which of the two
classes is the toxic one. Every voter has a table of vote probabilities for each class; voters that stay correlated within
a class are put together in blocks with a joint table. Expectation-maximisation estimates all tables and the class balance,
and gives each row a posterior. A logistic regression on the votes and on how often and how densely stems occur is trained
on the posteriors; it scores all whole texts. Only stems and weights (a few kB) are broadcast.

Defined cases: null and empty texts get the score of a text without votes; without labelled rows of both classes every
score is 0.5; repeated rows are scored each; a null id counts as the fold of the empty text (0: not held out); an empty
table gives an empty table; further columns pass through ``scored``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Shared, fold, labelled_sample, lean, pieces_of, renamed, token_hashes

THRESHOLD = 0.7
TRAIN_DOCS = 2500  # of each class at most
STEM_SIZES = (3, 4, 5, 6, 7, 8)
MOST_STEMS, CANDIDATES, COVER = 120, 1200, 4
LEAST_ROWS, LEAST_SHARE = 6, 0.95
#: Conditional correlation from which two voters share a block, and the most voters of a block.
CORRELATED, BLOCK = 0.25, 3
ABSTAIN, CLEAN, TOXIC = 0, 1, 2
PATTERNS = ("shouts", "masks", "exclaims", "no stem")
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    stems: list[str]
    weights: np.ndarray  # of the features, the last of the constant 1
    accuracies: dict[str, float] = field(default_factory=dict)  # P(vote is right | it votes), by the label model
    blocks: list[list[str]] = field(default_factory=list)  # correlated voters


def _distinct_words(texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words as they stand, number of the word at each place, text of each place, words a text)."""
    hashes, counts, data, starts, ends = token_hashes(texts, lower=False)
    _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    raw = data.tobytes()
    words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    return words, place, np.repeat(np.arange(len(texts)), counts), counts


def stem_counts(texts: list[bytes], stems: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(texts, stems) counts of words that begin with each stem, and (texts, 4) totals: words, words in capitals of two
    letters or more, words with a run of mask characters, words with two exclamation marks."""
    words, place, owner, counts = _distinct_words(texts)
    n, m = len(texts), max(1, len(stems))
    which, what, marks = [], [], np.zeros((len(words), 3), dtype=bool)
    sizes = sorted({len(s) for s in stems if s[-1] != "$"})
    for k, word in enumerate(words):
        marks[k] = (len(word) > 1 and word.isupper(), "***" in word or "$$$" in word or "###" in word, "!!" in word)
        for run in _LETTERS.findall(word.lower()):
            if (s := stems.get(run + "$")) is not None:
                which.append(k)
                what.append(s)
            for size in sizes:
                if (s := stems.get(run[:size])) is not None and len(run) >= size:
                    which.append(k)
                    what.append(s)
    hits = np.zeros((n, m))
    if which:
        which, what = np.array(which), np.array(what)
        order = np.argsort(place, kind="stable")  # the places of each distinct word, together
        begin = np.searchsorted(place[order], np.arange(len(words) + 1))
        times = begin[which + 1] - begin[which]
        at = np.repeat(begin[which] - np.cumsum(times) + times, times) + np.arange(times.sum())
        np.add.at(hits, (owner[order[at]], np.repeat(what, times)), 1)
    totals = np.stack([counts, *(np.bincount(owner, weights=marks[place, k], minlength=n) for k in range(3))], axis=1) if len(words) else np.zeros((n, 4))
    return hits[:, : len(stems)], totals


def votes_of(hits: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """(texts, voters): the lexicon voters, then the pattern voters."""
    lexicon = np.where(hits > 0, TOXIC, ABSTAIN)
    share = totals[:, 1:] / np.maximum(1, totals[:, :1])
    loud = np.where(share > 0.3, TOXIC, ABSTAIN)
    none = np.where((hits.sum(axis=1) == 0) & (totals[:, 0] > 0), CLEAN, ABSTAIN)
    return np.concatenate([lexicon, loud, none[:, None]], axis=1).astype(np.int8)


def features_of(hits: np.ndarray, totals: np.ndarray) -> np.ndarray:
    votes = votes_of(hits, totals)
    every = hits.sum(axis=1)
    many = [np.log1p(every), (every >= 1), (every >= 2), np.minimum(1, 20 * every / np.maximum(1, totals[:, 0])), np.ones(len(hits))]
    return np.concatenate([(votes[:, :-1] == TOXIC).astype(float), np.stack(many, axis=1)], axis=1)


def label_model(votes: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, list[list[int]], np.ndarray]:
    """(posterior of class 1 of each row, blocks of voters, P(right | votes) of each voter), from votes alone; the first
    estimate is the balance of a row's votes."""
    rows, voters = votes.shape
    balance = (votes == TOXIC).sum(axis=1) - (votes == CLEAN).sum(axis=1)
    p = 1 / (1 + np.exp(0.5 - np.clip(balance, -30.0, 30.0)))
    blocks: list[list[int]] = [[v] for v in range(voters)]

    def fitted(blocks: list[list[int]], p: np.ndarray) -> np.ndarray:
        for _ in range(rounds):
            odds = np.full(rows, np.log(max(p.mean(), 1e-6)) - np.log(max(1 - p.mean(), 1e-6)))
            for block in blocks:
                code = np.zeros(rows, dtype=np.int64)
                for v in block:
                    code = code * 3 + votes[:, v]
                size = 3 ** len(block)
                one, zero = (np.bincount(code, weights=w, minlength=size) + 1 / size for w in (p, 1 - p))
                odds += (np.log(one / one.sum()) - np.log(zero / zero.sum()))[code]
            new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
            if np.abs(new - p).max() < 1e-6:
                return new
            p = new
        return p

    p = fitted(blocks, p)
    fired = (votes != ABSTAIN).astype(float)
    strength = np.zeros((voters, voters))
    for w in (p, 1 - p):
        if w.sum() > 10:
            centred = fired - (w @ fired) / w.sum()
            cov = (centred * w[:, None]).T @ centred / w.sum()
            scale = np.sqrt(np.diag(cov))
            strength = np.maximum(strength, np.abs(cov) / np.maximum(np.outer(scale, scale), 1e-6) * (np.outer(scale, scale) > 1e-4))
    np.fill_diagonal(strength, 0)
    block_of = list(range(voters))
    for a, b in sorted(zip(*np.nonzero(np.triu(strength >= CORRELATED))), key=lambda ab: -strength[ab]):
        joined = [v for v in range(voters) if block_of[v] in (block_of[a], block_of[b])]
        if block_of[a] != block_of[b] and len(joined) <= BLOCK:
            for v in joined:
                block_of[v] = block_of[a]
    blocks = [[v for v in range(voters) if block_of[v] == k] for k in sorted(set(block_of))]
    p = fitted(blocks, p)
    right = np.array([((p * (votes[:, v] == TOXIC) + (1 - p) * (votes[:, v] == CLEAN)).sum() + 1) / ((votes[:, v] != ABSTAIN).sum() + 2) for v in range(voters)])
    return p, blocks, right


def oriented(posterior: np.ndarray, truth: np.ndarray) -> bool:
    """Whether the classes have to change places: class 1 is likelier for rows of label 0."""
    return posterior[truth == 1].mean() < posterior[truth == 0].mean()


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 0.3, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression on soft targets, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - target) + ridge * w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _chosen_stems(hits: np.ndarray, label: np.ndarray, stems: list[str]) -> list[str]:
    """Greedily those that cover most toxic rows that are not covered COVER times yet."""
    has = hits > 0
    need = np.where(label == 1, COVER, 0)
    picked: list[int] = []
    while len(picked) < MOST_STEMS:
        gain = has[need > 0].sum(axis=0) - 10 * has[label == 0].sum(axis=0)
        best = max(range(len(stems)), key=lambda k: (gain[k], stems[k][-1] != "$", len(stems[k]), stems[k]), default=None)
        if best is None or gain[best] < LEAST_ROWS:
            break
        picked.append(best)
        need = need - (has[:, best] & (need > 0))
        nested = [k for k, s in enumerate(stems) if s.startswith(stems[best].rstrip("$")) or stems[best].startswith(s)]
        has[:, nested] = False
    return [stems[k] for k in sorted(picked, key=lambda k: stems[k])]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_docs: int = TRAIN_DOCS) -> Model:
    """Train on a bounded sample of the labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, label, train_docs)

    @lean
    def beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces_of(batch, "text"):
                own, of = [], []
                for text, value in zip(texts, part.column("label").to_pylist()):
                    runs = {r for r in _LETTERS.findall(text.decode("utf-8", "replace").lower())}
                    found = {r[:size] for r in runs for size in STEM_SIZES if len(r) >= size} | {r + "$" for r in runs}
                    own += found
                    of += [value] * len(found)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array(of, pa.int32())], names=["stem", "label"])

    counted = sample.mapInArrow(beginnings, "stem string, label int").groupBy("stem").agg(F.count_if(F.col("label") == 1).alias("with"), F.count_if(F.col("label") == 0).alias("without"))
    fine = counted.where((F.col("with") >= LEAST_ROWS) & (F.col("with") >= LEAST_SHARE * (F.col("with") + F.col("without"))))
    stems = [r["stem"] for r in fine.orderBy(F.desc("with"), "stem").limit(CANDIDATES).collect()]

    @lean
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {s: k for k, s in enumerate(stems)}
        for batch in batches:
            for part, texts in pieces_of(batch, "text"):
                hits, totals = stem_counts(texts, numbers)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array([h.astype(np.float32).tobytes() for h in hits], pa.binary()), pa.array([t.tobytes() for t in totals], pa.binary())],
                    names=["doc_id", "label", "hits", "totals"],
                )

    named = sample.select(F.col("doc_id").cast("string"), "label", "text")
    rows = named.mapInArrow(counts, "doc_id string, label int, hits binary, totals binary").collect()  # 2 * train_docs at most
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["totals"]), bytes(r["hits"])))
    truth = np.array([r["label"] for r in rows])
    if len(set(truth.tolist())) < 2:
        return Model([], np.zeros(0))
    hits = np.stack([np.frombuffer(r["hits"], np.float32) for r in rows]).astype(float)
    totals = np.stack([np.frombuffer(r["totals"], np.float64) for r in rows])
    chosen = _chosen_stems(hits, truth, stems)
    hits = hits[:, [stems.index(s) for s in chosen]]
    votes = votes_of(hits, totals)
    posterior, blocks, right = label_model(votes)
    if oriented(posterior, truth):
        posterior, right = 1 - posterior, 1 - right
    names = [*chosen, *PATTERNS]
    weights = logistic(features_of(hits, totals), posterior)
    return Model(chosen, weights, dict(zip(names, right.tolist())), [[names[v] for v in b] for b in blocks if len(b) > 1])


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted (1 if score >= threshold, else 0)."""
    source = renamed(docs, {"score", "predicted"})
    shared = Shared(docs.sparkSession, (model.stems, model.weights))
    schema = T.StructType([*source.schema.fields, T.StructField("score", T.DoubleType())])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stems, weights = shared.value
        numbers = {s: k for k, s in enumerate(stems)}
        for batch in batches:
            for part, texts in pieces_of(batch, "text", 2 << 20):
                score = np.full(len(texts), 0.5)
                if len(weights):
                    score = 1 / (1 + np.exp(-np.clip(features_of(*stem_counts(texts, numbers)) @ weights, -60, 60)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score, pa.float64())], names=schema.fieldNames())

    return source.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    done = scored(docs.select("doc_id", "text"), fit(docs, labels, label, train_docs), threshold)
    return done.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")
