"""Operator 3: near-duplicate documents by DartMinHash signatures.

A document is the weighted set of its word shingles. Darts are thrown at the plane of (weight, rank) of every element by
hashing: the plane is cut into cells, a cell's number of darts is a hashed Poisson draw of its area, and each dart has a
weight, a rank and a coordinate of the signature. A document keeps, for each coordinate, the dart of the lowest rank among
those below its elements' weights. Two documents agree on a coordinate with the probability of their weighted Jaccard
similarity. Large documents look at low ranks alone, so the darts looked at are about k ln k + 2k whatever the size.

Bands of coordinates are joined. Documents of equal shingle sets are one class from the start and go on as one. In a
bucket of few classes all pairs are candidates; in a larger one each class is a candidate with the smallest. Every
candidate is checked on whole texts. The members of larger buckets that are not all joined by that meet again in an exact
way: two sets of similarity t share one of the n - ceil(t n) + 1 rarest shingles of each. Where few share such a shingle
all pairs are candidates, if they share a band too; those who share common ones with many make a crowd, of which all pairs
are counted in blocks of matrix products. No bucket yields all its pairs as rows. Links make classes by connected
components.

With 32 bands of 4, a pair of similarity 0.8 is missed by all bands with a probability below 1e-7.

Defined cases: null, empty and white texts have no shingles, resemble nothing and are kept; texts of fewer words than a
shingle are one shingle; words are runs of non-white characters with A-Z lower-cased; equal texts share a class; rows with
the same id are one document; rows with a null id are told apart by their text, and their
class is null unless a known id is in it; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, give_back, lean, mix64, pieces_of, release, token_hashes, written
from .graph import connected_components

WORDS = 5
SIMILARITY = 0.8
K = 128
ROWS = 4
#: Buckets of at most so many classes give all their pairs.
SMALL = 12
#: Slots that count shingles for their order, a power of two; any order is right, a good one makes few candidates.
SLOTS = 1 << 20
#: Shingles of a block of a crowd: at most about the first, and as few as the second where that makes SPREAD blocks or fewer.
BLOCK, LEAST_BLOCK, SPREAD = 1 << 20, 1 << 16, 8
#: The lowest cell of ranks is [0, 2**LOWEST); each further cell doubles the range.
LOWEST = -4
_FILL = np.uint64(2**64 - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CDF: dict[float, np.ndarray] = {}


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(elements, times, sizes): the distinct shingles of each text in order of their hash, how often each occurs, and the
    number of distinct ones a text."""
    hashes, counts, *_ = token_hashes(texts)
    ends = np.cumsum(counts)
    short = counts < words
    n = np.where(short, np.minimum(counts, 1), counts - words + 1)
    first = np.repeat(ends - counts - np.cumsum(n) + n, n) + np.arange(n.sum())
    width = np.minimum(words, np.repeat(counts, n))
    value = np.zeros(len(first), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words):
            inside = k < width
            at = np.where(inside, first + k, 0)
            value = (value * _STEP) ^ np.where(inside, hashes[at] if len(hashes) else 0, np.uint64(k + 1)).astype(np.uint64)
            value = mix64(value)
    owner = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return value[at], np.diff(at, append=len(value)), np.bincount(owner[at], minlength=len(texts))


def _poisson(mean: float) -> np.ndarray:
    """The distribution function of a Poisson variable."""
    if mean not in _CDF:
        top = int(mean + 12 * np.sqrt(mean) + 20)
        k = np.arange(1, top)
        _CDF[mean] = np.cumsum(np.exp(np.concatenate([[-mean], np.cumsum(np.log(mean / k)) - mean])))
    return _CDF[mean]


def signatures(elements: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int = K) -> np.ndarray:
    """DartMinHash: a (sets, k) matrix of dart identities; sets without elements keep the filler in every coordinate."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    norm = np.bincount(owner, weights=weights, minlength=n)
    out = np.full((n, k), _FILL, dtype=np.uint64)
    flat = out.reshape(-1)
    with np.errstate(divide="ignore"):
        level = np.ceil(np.log2(k * (np.log(k) + 2) / norm))
    level = np.where(norm > 0, np.maximum(level, LOWEST), -np.inf)
    highest = weights.max(initial=0)
    cell = LOWEST
    with np.errstate(over="ignore"):
        while (active := (level >= cell)).any():
            low, high = (0.0, 2.0**cell) if cell == LOWEST else (2.0 ** (cell - 1), 2.0**cell)
            inside = active[owner]
            below, above, band = 0.0, 1.0, 0
            while below < highest:
                at = np.flatnonzero(inside & (weights > below))
                area = (high - low) * (above - below)
                seed = mix64(elements[at] ^ mix64(np.full(1, (cell + 4096) * 8192 + band, dtype=np.uint64)))
                number = np.searchsorted(_poisson(area), (seed >> np.uint64(11)) * 2.0**-53, side="right")
                hit = number > 0
                at, seed, number = at[hit], seed[hit], number[hit]
                who = np.repeat(at, number)
                turn = np.arange(len(who)) - np.repeat(np.cumsum(number) - number, number) + 1
                dart = mix64(np.repeat(seed, number) + turn.astype(np.uint64) * _STEP)
                other = mix64(dart ^ _STEP)
                if above > 1 or weights.min(initial=1) < 1:
                    fits = below + (above - below) * ((other >> np.uint64(40)) * 2.0**-24) < weights[who]
                    who, dart, other = who[fits], dart[fits], other[fits]
                rank = (low + (high - low) * ((dart >> np.uint64(11)) * 2.0**-53)).astype(np.float32)
                packed = (rank.view(np.uint32).astype(np.uint64) << np.uint64(32)) | (dart & np.uint64(0xFFFFFFFF))
                np.minimum.at(flat, owner[who] * k + (other % np.uint64(k)).astype(np.int64), packed)
                below, above, band = above, 2 * above, band + 1
            empty = (norm > 0) & (out == _FILL).any(axis=1)
            level = np.where(empty, np.maximum(level, cell + 1), level)
            cell += 1
    return out


def band_keys(matrix: np.ndarray, rows: int, bands: int, salt: int) -> np.ndarray:
    """(sets, bands) keys of ``rows`` coordinates each; bands beyond the first k // rows draw coordinates anew."""
    k, rng = matrix.shape[1], np.random.Generator(np.random.PCG64(salt))
    drawn = [rng.permutation(k)[: k // rows * rows].reshape(-1, rows) for _ in range(-(-bands * rows // k))]
    chosen = np.concatenate(drawn)[:bands]
    out = np.zeros((len(matrix), bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for b, columns in enumerate(chosen):
            value = np.full(len(matrix), salt * 4096 + b, dtype=np.uint64)
            for c in columns:
                value = mix64(value * _STEP ^ matrix[:, c])
            out[:, b] = value
    return out.view(np.int64)


def _signed(docs: DataFrame, rows: int, bands: int, salt: int) -> DataFrame:
    """(id, h1, h2, n, keys) for (id, text): digest and size of the shingle set, and its band keys (null without words)."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces_of(batch, "text", 2 << 20):
                elements, _, sizes = shingle_sets(texts)
                keys = band_keys(signatures(elements, np.ones(len(elements)), sizes), rows, bands, salt)
                ends = np.cumsum(sizes)
                halves = np.array([np.frombuffer(hashlib.blake2b(elements[e - s : e].tobytes(), digest_size=16).digest(), np.int64) for s, e in zip(sizes.tolist(), ends.tolist())]).reshape(-1, 2)
                at = np.arange(len(texts) + 1) * bands
                listed = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys.reshape(-1)), mask=pa.array(sizes == 0))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(sizes, pa.int64()), listed],
                    names=["id", "h1", "h2", "n", "keys"],
                )

    return docs.mapInArrow(run, "id long, h1 long, h2 long, n long, keys array<long>")


def similarity(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two texts' shingle sets; 0 if either is empty."""
    elements, _, sizes = shingle_sets([a, b])
    both = len(np.intersect1d(elements[: sizes[0]], elements[sizes[0] :], assume_unique=True))
    return both / (len(elements) - both) if sizes.all() else 0.0


def _links(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The candidate pairs (a, b) whose whole texts are similar enough."""
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, left in pieces_of(batch, "text_a", 2 << 20, "text_b"):
                right = [t or b"" for t in part.column("text_b").cast(pa.binary()).to_pylist()]
                ends, elements = 0, []
                every, _, sizes = shingle_sets([*left, *right])
                for s in sizes.tolist():
                    elements.append(every[ends : ends + s])
                    ends += s
                n = len(left)
                alike = []
                for x, y in zip(elements[:n], elements[n:]):
                    both = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= threshold * max(len(x), len(y)) else 0
                    alike.append(both > 0 and both >= threshold * (len(x) + len(y) - both))
                keep = pa.array(alike, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (key, id, n, own) whose key others with another ``own`` have too, with the key's number of members and its
    head, the smallest of them."""
    groups = rows.groupBy("key").agg(F.count("*").alias("members"), F.min("own").alias("least"), F.max("own").alias("most"), F.min(F.struct("id", "n", "own")).alias("head"))
    groups = written(groups.where("members > 1 and least != most").drop("least", "most"), "buckets")
    out = written(rows.join(groups, "key"), "shared")
    release(groups)
    return out


def _within(shared: DataFrame, threshold: float) -> DataFrame:
    """Candidate pairs (a, b) among ``shared`` rows of one key and different ``own``: all of them in a small bucket, those
    with the head in a larger one; sizes too different to be similar are left out."""
    near = lambda x, y: F.least(x, y) >= threshold * F.greatest(x, y)
    star = shared.where((F.col("members") > SMALL) & (F.col("id") != F.col("head.id")) & (F.col("own") != F.col("head.own")) & near(F.col("n"), F.col("head.n")))
    some = shared.where(F.col("members") <= SMALL).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("id", "n", "own"))).alias("of"))  # SMALL at most
    some = some.select("of", F.explode("of").alias("x")).select("x", F.explode("of").alias("y"))
    some = some.where((F.col("x.id") < F.col("y.id")) & (F.col("x.own") != F.col("y.own")) & near(F.col("x.n"), F.col("y.n")))
    pairs = star.select(F.col("head.id").alias("a"), F.col("id").alias("b")).unionAll(some.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
    return pairs.distinct()


def _order(docs: DataFrame) -> np.ndarray:
    """How often each slot's shingles occur in ``docs``: SLOTS numbers whatever the table."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for _, texts in pieces_of(batch, "text", 2 << 20):
                total += np.bincount((shingle_sets(texts)[0] & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "times"])

    found = docs.select("text").mapInArrow(run, "slot long, times long").groupBy("slot").agg(F.sum("times").alias("times")).toArrow()  # SLOTS rows at most
    out = np.zeros(SLOTS, dtype=np.int64)
    out[found["slot"].to_numpy()] = found["times"].to_numpy()
    del found
    give_back()
    return out


def _prefixes(docs: DataFrame, threshold: float) -> DataFrame:
    """(id, own, n, key) for (id, own, text): the shingles of which two similar sets have one in common, without those that
    occur once."""
    order = Shared(docs.sparkSession, _order(docs))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = order.value
        for batch in batches:
            for part, texts in pieces_of(batch, "text", 2 << 20):
                elements, _, sizes = shingle_sets(texts)
                owner = np.repeat(np.arange(len(texts)), sizes)
                often = times[(elements & np.uint64(SLOTS - 1)).astype(np.int64)]
                by = np.lexsort((elements, often, owner))
                place = np.arange(len(elements)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                taken = place <= (sizes - np.ceil(threshold * sizes - 1e-9))[owner]
                taken = by[taken & (often[by] > 1)]
                rows = pa.array(owner[taken])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(rows) for c in ("id", "own")), pa.array(sizes[owner[taken]], pa.int64()), pa.array(elements[taken].view(np.int64))],
                    names=["id", "own", "n", "key"],
                )

    return docs.select("id", "own", "text").mapInArrow(run, "id long, own long, n long, key long")


def common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The number of elements that each set of ``a`` has in common with each of ``b``: frequent elements by matrix products,
    the others one by one."""
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    every, sides = np.concatenate([*a, *b]), np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    order = np.lexsort((sides, every))
    every, sides = every[order], sides[order]
    starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(every))
    mids = starts + np.add.reduceat(sides < len(a), starts) if len(starts) else starts
    work = (mids - starts) * (ends - mids)
    for s, m, e in zip(*(x[(work > 0) & (work <= 4096)].tolist() for x in (starts, mids, ends))):
        out[sides[s:m, None], sides[None, m:e] - len(a)] += 1
    frequent = np.flatnonzero(work > 4096)
    for at in range(0, len(frequent), 1024):
        chosen = frequent[at : at + 1024]
        left, right = np.zeros((len(a), len(chosen)), np.float32), np.zeros((len(b), len(chosen)), np.float32)
        for k, c in enumerate(chosen.tolist()):
            left[sides[starts[c] : mids[c]], k] = 1
            right[sides[mids[c] : ends[c]] - len(a), k] = 1
        out += left @ right.T
    return out


def _joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from the smallest id of each component of the links (a, b) to its other ids."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    least = np.arange(len(ids))
    while True:
        before = least.copy()
        low = np.minimum(least[u], least[v])
        np.minimum.at(least, u, low)
        np.minimum.at(least, v, low)
        least = least[least]
        if (least == before).all():
            return ids[least][least != np.arange(len(ids))], ids[least != np.arange(len(ids))]


def _crowd_links(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between members (crowd, id, own, n) of one crowd and different ``own``, of all pairs in blocks.

    Only neighbouring classes of size meet, and the blocks of a crowd's largest ``own`` do not meet each other.
    """
    largest = members.groupBy("crowd", "own").count().groupBy("crowd").agg(F.max_by("own", F.struct("count", "own")).alias("largest"))
    rows = members.join(largest, "crowd").withColumn("side", (F.col("own") == F.col("largest")).cast("int")).withColumn("size", F.floor(F.log("n") / float(np.log(1 / threshold))))
    total = F.sum("n")
    blocks = F.greatest(F.ceil(total / BLOCK), F.least(F.lit(SPREAD), F.ceil(total / LEAST_BLOCK))).cast("int")
    units = written(rows.groupBy("crowd", "size", "side").agg(blocks.alias("blocks")), "units")
    rows = rows.join(units, ["crowd", "size", "side"])
    own = F.struct("size", "side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
    rows = rows.select("crowd", "id", "own", "side", own.alias("mine"), F.explode(F.array(*(F.col("size") + k for k in (-1, 0, 1)))).alias("size"))
    others = units.select("crowd", "size", F.col("side").alias("other"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    met = rows.join(others, ["crowd", "size"]).where("side + other < 2")
    met = met.withColumn("theirs", F.struct("size", F.col("other").alias("side"), "block"))
    met = met.select("crowd", F.least("mine", "theirs").alias("x"), F.greatest("mine", "theirs").alias("y"), (F.col("mine") <= F.col("theirs")).alias("first"), "id", "own")
    met = met.join(texts.select("id", "text"), "id")

    def run(table: pa.Table) -> pa.Table:
        sets, at = [], 0
        for batch in table.select(["text"]).combine_chunks().to_batches():
            for _, some in pieces_of(batch, "text", 2 << 20):
                elements, _, sizes = shingle_sets(some)
                sets += np.split(elements, np.cumsum(sizes)[:-1])
        ids, own, first = (table[c].to_numpy() for c in ("id", "own", "first"))
        left, right = np.flatnonzero(first), np.flatnonzero(~first)
        if table["x"][0] == table["y"][0]:
            right = left
        found, n = [], np.array([len(s) for s in sets])
        for at in range(0, len(left), 1024):
            for to in range(0, len(right), 1024):
                i, j = left[at : at + 1024], right[to : to + 1024]
                both = common([sets[k] for k in i], [sets[k] for k in j])
                alike = (both > 0) & (both >= threshold * (n[i][:, None] + n[j][None] - both)) & (own[i][:, None] != own[j][None])
                p, q = np.nonzero(alike)
                found.append(np.stack(_joined(ids[i[p]], ids[j[q]])))
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return met.groupBy("crowd", "x", "y").applyInArrow(run, "a long, b long")


def _crowded_links(shared: DataFrame, sets: DataFrame, texts: DataFrame, parts: DataFrame, threshold: float) -> DataFrame:
    """The links among the members of larger buckets that ``parts`` does not join."""
    crowded = shared.where(F.col("members") > SMALL).select("key", "id").join(parts.select(F.col("node").alias("id"), F.col("component").alias("own")), "id", "left")
    crowded = written(crowded.withColumn("own", F.coalesce("own", "id")), "crowded")
    apart = crowded.groupBy("key").agg(F.min("own").alias("least"), F.max("own").alias("most")).where("least != most")
    open_ = written(crowded.join(apart, "key").select("id", "own").distinct(), "open")
    docs = written(texts.select("id", "text").dropDuplicates(["id", "text"]).join(open_, "id"), "texts")
    rows = written(_prefixes(docs, threshold), "prefixes")
    met = _shared(rows)
    few = _within(met.where(F.col("members") <= SMALL), threshold)
    banded = lambda side: sets.join(open_, "id").select(F.col("id").alias(side), F.col("keys").alias("keys_" + side))
    few = few.join(banded("a"), "a").join(banded("b"), "b").where(F.arrays_overlap("keys_a", "keys_b")).select("a", "b").distinct()
    many = written(met.where(F.col("members") > SMALL).select(F.col("head.id").alias("a"), F.col("id").alias("b"), "own", "n").distinct(), "crowds")
    crowds = connected_components(many)
    members = many.select(F.col("b").alias("id"), "own", "n").distinct().join(crowds.withColumnRenamed("node", "id"), "id", "left")
    members = written(members.withColumn("crowd", F.coalesce("component", "id")).drop("component"), "members")
    out = written(_links(few, docs, threshold).unionAll(_crowd_links(members, docs, threshold)), "links")
    release(crowded, open_, docs, rows, met, many, members)
    return out


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row a document: doc_id, class_id (the smallest id of its class), n_shingles, kept (doc_id = class_id)."""
    nameless = F.lit(-(1 << 62)) - F.shiftrightunsigned(F.xxhash64(text), 2)  # below all ids in use
    given = docs.select(F.coalesce(F.col(doc_id).cast("long"), nameless).alias("id"), F.col(text).alias("text"))
    signed = written(_signed(given, ROWS, K // ROWS, 1), "signatures")
    sets = written(signed.where("n > 0").groupBy("h1", "h2").agg(F.min("id").alias("id"), F.any_value("n").alias("n"), F.any_value("keys").alias("keys")), "sets")
    shared = _shared(sets.select("id", "n", F.col("id").alias("own"), F.explode("keys").alias("key")))
    # The texts that any check can ask for: those that share a bucket with another set.
    wanted = written(shared.groupBy("id").agg(F.max("members").alias("members")), "wanted")
    texts = written(given.join(wanted, "id"), "texts")
    links = written(_links(_within(shared, threshold), texts, threshold), "links")
    parts = connected_components(links)
    more = _crowded_links(shared, sets, texts, parts, threshold)
    parts = connected_components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more))
    known = sets.select("h1", "h2", F.col("id").alias("node")).join(parts, "node", "left")
    known = written(known.select("h1", "h2", F.coalesce("component", "node").alias("class")), "classes")
    release(shared, wanted, texts, links, more, sets)
    out = signed.select("id", "h1", "h2", "n").join(known, ["h1", "h2"], "left")
    class_, named = F.coalesce("class", "id"), lambda c: F.when(c > -(1 << 62), c)
    return out.select(named(F.col("id")).alias("doc_id"), named(class_).alias("class_id"), F.col("n").alias("n_shingles"), (F.col("id") == class_).alias("kept"))
