import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import types as T

from radiospark.llm import ngram_lm as L
from radiospark.llm.queries import op2_ngram_lm

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return [*re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)), None]


def brute(rows):
    """Exact counts in place of the filter's."""
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    words, pairs, texts = Counter(), Counter(), 0
    for d, t, *_ in rows:
        if not held(d):
            own = split(t)
            words.update(own)
            pairs.update(zip([""] + own, own))
            texts += 1
    n, v = sum(words.values()), len(words)
    quantised = lambda c: float(L.count_of(L.level_of(np.array([c])))[0]) if c else 0.0
    out = []
    for d, t, *_ in rows:
        own = split(t)
        base = score = 0.0
        for before, w in zip([""] + own, own):
            p = (words[w] + 0.1) / (n + 0.1 * (v + 1))
            context = texts if before == "" else words[before]
            base += math.log10(p)
            score += math.log10((min(quantised(pairs[before, w]), context) + L.MU * p) / (context + L.MU))
        out.append((d, held(d), len(own), sum(words[w] > 0 for w in own), n, base, score))
    return out


def compare(got, want):
    got, want = (sorted((tuple(r) for r in x), key=lambda r: (str(r[0]), r[2], r[5])) for x in (got, want))
    assert len(got) == len(want)
    off = 0
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5]))
        off += abs(g[6] - w[6]) > 0.02 * abs(w[6]) + 1e-9
    assert off <= 0.02 * len(got)  # the filter's false positives


def test_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = op2_ngram_lm(spark, sf_dir).collect()
    compare(got, brute(rows))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(i, t, "x") for i, t in enumerate([None, "", " ", "A b", "a B", "a\tb\nc", "é é É", "b a " * 40] * 5)] + [(None, "a b", "x"), (3, "A b", "x"), (3, "A b", "x")]
    compare(L.held_out_scores(spark.createDataFrame(rows, SCHEMA)).collect(), brute(rows))
    assert L.held_out_scores(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = [(None, "a b", "x")]
    compare(L.held_out_scores(spark.createDataFrame(alone, SCHEMA)).collect(), brute(alone))


def test_filter_levels():
    rng = np.random.default_rng(1)
    hashes, counts = rng.integers(0, 2**63, 20_000).astype(np.uint64), rng.zipf(1.5, 20_000).clip(1, 10**9)
    filter_ = L.LogBloom.of(hashes, counts)
    got = filter_.levels(hashes)
    assert (got >= L.level_of(counts)).all() and (got == L.level_of(counts)).mean() > 0.99
    assert (filter_.levels(rng.integers(0, 2**63, 20_000).astype(np.uint64)) > 0).mean() < 0.01
    assert L.level_of(np.array([1, 2, 3, 4, 100])).tolist() == [1, 2, 3, 4, 12] and L.count_of(np.array([0, 1])).tolist() == [0, 1]
    values = np.sort(hashes)
    assert (L.unpack(L.pack(values, 8), 8) == values).all() and (L.unpack(L.pack(values, 6), 6) == values & ~np.uint64(0xFFFF)).all()
