"""Operator 2: language-model scores from a log-frequency Bloom filter.

Training counts words exactly and word pairs as quantised counts: a pair seen c times has level 1 + floor(log_b c), and the
filter holds (pair, 1) ... (pair, level). A count is read back by probing levels 1, 2, ... until one is missing. A text's
probability is the product over its tokens of

    P(w | v) = (count(v, w) + mu * P(w)) / (count(v) + mu),    P(w) = (count(w) + 0.1) / (N + 0.1 * (V + 1)),

count(v, w) being the filter's, at most count(v). The filter holds every pair of the corpus, so it outgrows whatever may be
broadcast (about 0.2 bytes a byte of text); it is cut into segments by hash, and the segments are sent to the workers that
probe them, as the README says.

At scale: tasks sort and count their own n-grams and shuffle them as packed arrays, one for each segment, so a frequent
word or pair is one number a task. To score, texts are dealt to blocks; a block sends each distinct n-gram once to its
segment and gets one byte a pair and one count a word back, in the order it asked. Segments and blocks are of bounded size
and grow in number with the input.

Defined cases: null and empty texts are one token, the end; a null id counts as the fold of the empty text (0: held out);
no training text leaves N = V = 0, so that P(w) is 1 for all; repeated rows are trained on and scored each; an empty table
gives an empty table; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, lean, mix64, pieces_of, token_hashes, written

SMOOTH = 0.1
MU = 8.0
BASE = 1.5
BITS, PROBES = 12, 8
#: Bytes of text for each segment of the filter and for each block of texts; tokens that a task counts at once.
SEGMENT_BYTES, BLOCK_BYTES, FLUSH_TOKENS = 8 << 20, 8 << 20, 1_500_000
LEAST_PARTS = 40
#: Segments or blocks of a task, about.
TASK_PARTS = 4
END, START = np.uint64(0x9DDFEA08EB382D69), np.uint64(0xC3A5C85C97CB3127)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a pair's hash that are kept: its 48 high bits.
PAIR_BYTES = 6


def pack(values: np.ndarray, size: int) -> bytes:
    """The ``size`` high bytes of 64-bit values, all values' highest bytes first: sorted values pack well then."""
    return np.ascontiguousarray(values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def unpack(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(size, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :size] = planes.T
    return out.reshape(-1).view(">u8").astype(np.uint64)


def _pack_counts(values: np.ndarray) -> bytes:
    return pack(values.astype(np.uint64), 8)


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes with an end after each text, hash before each token, pair hashes cut to 48 bits, text of each token)."""
    words, counts, *_ = token_hashes(texts)
    sizes = counts + 1
    ends = np.cumsum(sizes)
    out = np.full(int(ends[-1]) if len(ends) else 0, END, dtype=np.uint64)
    inner = np.ones(len(out), dtype=bool)
    inner[ends - 1] = False
    out[inner] = words
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[ends - sizes] = START
    with np.errstate(over="ignore"):
        pairs = mix64(before * _STEP + out) & ~np.uint64(0xFFFF)
    return out, before, pairs, np.repeat(np.arange(len(texts)), sizes)


def _segment(values: np.ndarray, segments: int) -> np.ndarray:
    """Segment of each hash, rising with the hash."""
    return ((values >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _cuts(values: np.ndarray, segments: int) -> list[tuple[int, int]]:
    at = np.searchsorted(_segment(values, segments), np.arange(segments + 1)).tolist()
    return list(zip(at, at[1:]))


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the mean of its range; 0 for level 0."""
    low, high = np.ceil(BASE ** (levels - 1.0) - 1e-9), np.ceil(BASE ** (levels + 0.0) - 1e-9) - 1
    return np.where(levels > 0, (low + np.maximum(low, high)) / 2, 0.0)


class LogBloom:
    """A Bloom filter of (hash, level) events."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def _places(self, hashes: np.ndarray, levels: np.ndarray | int) -> Iterator[np.ndarray]:
        with np.errstate(over="ignore"):
            one = mix64(hashes ^ (np.asarray(levels, dtype=np.uint64) * _STEP))
            two = mix64(one) | np.uint64(1)
            for k in range(PROBES):
                yield ((one + np.uint64(k) * two) % np.uint64(len(self.bits) * 8)).astype(np.int64)

    @classmethod
    def of(cls, hashes: np.ndarray, counts: np.ndarray) -> LogBloom:
        levels = level_of(counts) if len(counts) else np.zeros(0, np.int64)
        size = max(64, int(levels.sum()) * BITS)
        out, marks = cls(np.zeros(-(-size // 8), np.uint8)), np.zeros(-(-size // 8) * 8, dtype=bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            for at in out._places(hashes[levels >= level], level):
                marks[at] = True
        out.bits = np.packbits(marks)
        return out

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Probe upwards until a level is missing."""
        out, alive, level = np.zeros(len(hashes), np.uint8), np.arange(len(hashes)), 1
        while len(alive) and level < 255:
            here = np.ones(len(alive), dtype=bool)
            for at in self._places(hashes[alive], level):
                here &= (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            alive = alive[here]
            out[alive] = level
            level += 1
        return out


def _dealt(df: DataFrame, key: str, groups: int) -> DataFrame:
    """``df`` dealt to tasks by ``key``, a few of its ``groups`` each: the number of tasks grows with the input."""
    return df.repartition(max(LEAST_PARTS, groups // TASK_PARTS), key)


@dataclass
class Model:
    """parts: (segment, words, counts, filter); tokens: N; distinct: V; texts: number of training texts."""

    parts: DataFrame
    segments: int
    tokens: int
    distinct: int
    texts: int


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def train(docs: DataFrame, text_bytes: int) -> Model:
    """Count the n-grams of all whole texts of ``docs`` (column text)."""
    segments = max(LEAST_PARTS, text_bytes // SEGMENT_BYTES)
    kinds = {"segment": pa.int64(), "words": pa.binary(), "word_counts": pa.binary(), "pairs": pa.binary(), "pair_counts": pa.binary()}

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def told() -> pa.RecordBatch:
            words, times = np.unique(np.concatenate([h[0] for h in held]), return_counts=True)
            pairs, pair_times = np.unique(np.concatenate([h[1] for h in held]), return_counts=True)
            rows = [
                (s, pack(words[a:b], 8), _pack_counts(times[a:b]), pack(pairs[c:d], PAIR_BYTES), _pack_counts(pair_times[c:d]))
                for s, ((a, b), (c, d)) in enumerate(zip(_cuts(words, segments), _cuts(pairs, segments)))
                if a < b or c < d
            ]
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds.values())], names=list(kinds))

        for batch in batches:
            for _, texts in pieces_of(batch, "text"):
                words, _, pairs, _ = tokens_of(texts)
                held.append((words, pairs))
                if sum(len(h[0]) for h in held) >= FLUSH_TOKENS:
                    yield told()
                    held = []
        if held:
            yield told()

    def merge(rows: pa.Table) -> pa.Table:
        got = {c: [x or b"" for x in rows.column(c).to_pylist()] for c in list(kinds)[1:]}
        joined = lambda c, size: np.concatenate([unpack(x, size) for x in got[c]])
        words, times = _summed(joined("words", 8), joined("word_counts", 8))
        filter_ = LogBloom.of(*_summed(joined("pairs", PAIR_BYTES), joined("pair_counts", 8)))
        return pa.table({
            "segment": rows.column("segment").slice(0, 1), "words": pa.array([pack(words, 8)], pa.binary()), "counts": pa.array([_pack_counts(times)], pa.binary()),
            "filter": pa.array([filter_.bits.tobytes()], pa.binary()), "tokens": pa.array([int(times.sum())], pa.int64()), "distinct": pa.array([len(words)], pa.int64()),
            "texts": pa.array([int(times[words == END].sum())], pa.int64()),
        })

    counted = docs.select("text").mapInArrow(count, "segment long, words binary, word_counts binary, pairs binary, pair_counts binary")
    parts = written(_dealt(counted, "segment", segments).groupBy("segment").applyInArrow(merge, "segment long, words binary, counts binary, filter binary, tokens long, distinct long, texts long"), "model")
    n = parts.agg(F.sum("tokens"), F.sum("distinct"), F.sum("texts")).first()
    return Model(parts, segments, n[0] or 0, n[1] or 0, n[2] or 0)


def score(docs: DataFrame, model: Model, text_bytes: int) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every whole text of ``docs`` (doc_id, text)."""
    blocks = max(LEAST_PARTS, text_bytes // BLOCK_BYTES)
    segments, total, distinct, texts = model.segments, model.tokens, model.distinct, model.texts
    own = F.xxhash64(F.col("doc_id").cast("string"), "text")  # rows with one id or none are dealt by their texts
    dealt = _dealt(docs.select(F.pmod(own, F.lit(blocks)).alias("block"), "doc_id", "text"), "block", blocks)

    def texts_of(rows: pa.Table) -> list[bytes]:
        return [t or b"" for t in rows.column("text").cast(pa.large_binary()).to_pylist()]

    def ask(rows: pa.Table) -> pa.Table:
        words, _, pairs, _ = tokens_of(texts_of(rows))
        words, pairs = np.unique(words), np.unique(pairs)
        block = rows.column("block")[0].as_py()
        asked = [(block, s, pack(words[a:b], 8), pack(pairs[c:d], PAIR_BYTES)) for s, ((a, b), (c, d)) in enumerate(zip(_cuts(words, segments), _cuts(pairs, segments))) if a < b or c < d]
        return pa.table([pa.array(x, kind) for x, kind in zip(zip(*asked), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["block", "segment", "words", "pairs"])

    def answer(asked: pa.Table, parts: pa.Table) -> pa.Table:
        if parts.num_rows:
            known, counts = (unpack(parts.column(c)[0].as_py(), 8) for c in ("words", "counts"))
            filter_ = LogBloom(np.frombuffer(parts.column("filter")[0].as_py(), np.uint8))
        else:
            known, counts, filter_ = np.zeros(0, np.uint64), np.zeros(0, np.uint64), None
        out = []
        for block, segment, words, pairs in zip(*(asked.column(c).to_pylist() for c in ("block", "segment", "words", "pairs"))):
            words, pairs = unpack(words, 8), unpack(pairs, PAIR_BYTES)
            found = np.zeros(len(words), np.uint64)
            if len(known):
                at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                found = np.where(known[at] == words, counts[at], np.uint64(0))
            levels = filter_.levels(pairs) if filter_ is not None else np.zeros(len(pairs), np.uint8)
            out.append((block, segment, _pack_counts(found), levels.tobytes()))
        return pa.table([pa.array(x, kind) for x, kind in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))] if out else [pa.array([], k) for k in (pa.int64(), pa.int64(), pa.binary(), pa.binary())], names=["block", "segment", "counts", "levels"])

    def tell(rows: pa.Table, answers: pa.Table) -> pa.Table:
        tokens, before, pairs, owner = tokens_of(texts_of(rows))
        answers = answers.sort_by("segment")
        counts = np.concatenate([unpack(x, 8) for x in answers.column("counts").to_pylist()]).astype(np.float64)
        levels = np.concatenate([np.frombuffer(x, np.uint8) for x in answers.column("levels").to_pylist()])
        at = np.unique(tokens, return_inverse=True)[1]
        own = counts[at]
        first = before == START
        context = np.empty_like(own)
        context[1:] = own[:-1]
        context[first] = texts
        seen = np.minimum(count_of(np.arange(256))[levels[np.unique(pairs, return_inverse=True)[1]]], context)
        single = (own + SMOOTH) / (total + SMOOTH * (distinct + 1))
        n = rows.num_rows
        summed = lambda x: np.bincount(owner, weights=x, minlength=n)
        return pa.table({
            "doc_id": rows.column("doc_id"), "n_tokens": pa.array(np.bincount(owner, minlength=n), pa.int64()), "n_known": pa.array(summed(own > 0).astype(np.int64), pa.int64()),
            "base_score": pa.array(summed(np.log10(single)), pa.float64()), "score": pa.array(summed(np.log10((seen + MU * single) / (context + MU))), pa.float64()),
        })

    asked = dealt.groupBy("block").applyInArrow(ask, "block long, segment long, words binary, pairs binary")
    parts = model.parts.select("segment", "words", "counts", "filter")
    asked, parts = _dealt(asked, "segment", segments), _dealt(parts, "segment", segments)
    answers = asked.groupBy("segment").cogroup(parts.groupBy("segment")).applyInArrow(answer, "block long, segment long, counts binary, levels binary")
    answers = _dealt(answers, "block", blocks)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(tell, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def held_out_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", modulus: int = 10) -> DataFrame:
    """Train on the documents outside the held-out fold and score all: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score."""
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    held = fold(F.col("doc_id"), modulus) == 0
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    model = train(given.where(~held), size)
    done = score(given, model, size)
    return done.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
