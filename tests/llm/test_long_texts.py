"""Texts of over a MB: no operator reads a prefix, and none fails on them."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from radiospark.llm import exact_dedup, line_dedup, minhash, mixing, ngram_lm, toxicity

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(seed, n):
    rng = random.Random(seed)
    return [f"{rng.choice('abcdefgh')}{rng.randrange(4000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def long_rows():
    """(doc_id, text): three texts of about 1.1 MB, two of them alike but for their last words, and short ones."""
    one = words(1, 200_000)
    other = words(2, 200_000)
    texts = [" ".join(one), " ".join([*one[:-3], "quite", "another", "end"]), "\n".join(" ".join(other[k : k + 10]) for k in range(0, len(other), 10))]
    return [*enumerate(texts), *((3 + k, " ".join(words(50 + k, 200)) if k else "") for k in range(20)), (23, None)]


@pytest.fixture(scope="module")
def docs(spark, long_rows):
    return spark.createDataFrame([(d, t, "ab"[d % 2]) for d, t in long_rows], "doc_id long, text string, source string").repartition(4)


def test_exact_identity_depends_on_the_last_word(docs, spark, long_rows):
    twice = docs.unionByName(spark.createDataFrame([(30, long_rows[1][1], "a")], docs.schema))
    kept = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_duplicates(twice).collect()}
    assert kept[0] == (0, 1) and kept[1] == kept[30] == (1, 2) and kept[2] == (2, 1) and kept[23] == kept[3] == (3, 2)


def test_lines_of_a_long_text(docs, spark, long_rows):
    last = long_rows[2][1].rsplit("\n", 1)[1]
    extra = spark.createDataFrame([(40 + k, f"own {k}\n{last}", "a") for k in range(9)], docs.schema)
    got = {r["doc_id"]: r for r in line_dedup.report(docs.unionByName(extra)).collect()}
    lines = long_rows[2][1].split("\n")
    assert (got[2]["n_lines"], got[2]["n_dropped"]) == (len(lines), 1)
    assert got[2]["kept_sha256"] == hashlib.sha256("\n".join(lines[:-1]).encode()).hexdigest()
    assert all(got[40 + k]["n_dropped"] == 1 for k in range(9)) and got[0]["n_dropped"] == 0


def test_near_copies_of_long_texts(docs):
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()}
    assert got[0] == got[1] == 0 and all(got[d] == d for d in range(2, 24))


def test_base_scores_count_every_word(docs, long_rows):
    held = {d for d, _ in long_rows if zlib.crc32(str(d).encode()) % 10 == 0}
    tokens = {d: [*WORD.findall((t or "").lower()), None] for d, t in long_rows}
    count = {}
    for d, found in tokens.items():
        for w in found if d not in held else ():
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    got = {r["doc_id"]: r for r in ngram_lm.held_out_scores(docs).collect()}
    for d, found in tokens.items():
        base = math.fsum(math.log10((count.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in found)
        assert got[d]["n_tokens"] == len(found) and got[d]["n_known"] == sum(w in count for w in found) and got[d]["train_tokens"] == n
        assert abs(got[d]["base_score"] - base) <= 1e-9 * abs(base) and math.isfinite(got[d]["score"])


def test_sizes_in_the_mix(docs, long_rows):
    got = {r["doc_id"]: r for r in mixing.mix_report(docs).collect()}
    assert {d: got[d]["size"] for d, _ in long_rows} == {d: len(WORD.findall(t or "")) for d, t in long_rows}
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got.values())


def test_stems_of_a_long_text_are_all_counted():
    short = " ".join(words(7, 500))
    stems = {s: k for k, s in enumerate(sorted({w[:1] for w in short.split()}))}
    some, all_ = toxicity.stem_counts([short.encode()], stems)
    many, of = toxicity.stem_counts([" ".join([short] * 900).encode()], stems)
    assert np.asarray(some).sum() > 0 and np.array_equal(np.asarray(many), 900 * np.asarray(some)) and np.array_equal(np.asarray(of), 900 * np.asarray(all_))
