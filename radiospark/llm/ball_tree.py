"""Operator 12: exact top-k inner-product search by ball trees, branch and bound.

Vectors become whole numbers, floor(1024 * x). A splitter fitted on a bounded sample lays similar vectors side by side; range
partitions of that order are cut into shards of bounded size, and each shard becomes a ball tree: halves between two far
points, down to leaves, with the centre, radius and smallest id of every ball. Queries are packed in the same order into
blocks. The product of a query q with anything in a ball is at most q . centre + |q| radius, so a search takes nodes from a
heap by that bound, leaves out those that cannot reach the query's kth score, and scores the leaves that are left as whole
numbers. Where a ball can at best draw level with the kth row, it is left out if all its ids are greater.

The kth score is shared: it starts from the sample, goes from shard to shard inside a task, and between two waves through a
table: in the first, blocks visit the shards with their queries' highest bounds, in the second all others whose root can
still reach. Which block meets which shard is settled on directories of the shards' roots first. A task holds one shard and
streams blocks by; both are bounded, and no key grows with the table.

Exact whatever the sample says; where bounds cannot rule anything out, the work is queries times rows, in blocks.

Defined cases: rows whose id or vector is null, or whose vector holds null or non-finite components, take no part; vectors of
other lengths than the query's do not meet it, empty ones meet each other at 0; rows that carry the query's id are its own;
repeated rows count each as candidates, repeated queries once; an empty table gives an empty table. Components that do not
fit into 64 bits, and scores that might not, raise an error. Further columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import numbered
from .common import Shared, lean, release, written

SCALE = 1024
#: Vectors of a shard, of a leaf and of a block of queries at most; bytes of a shard (vectors of 8-byte numbers).
SHARD, LEAF, BLOCK, SHARD_BYTES = 4096, 64, 256, 4 << 20
#: Rows and bytes of the sample at most; levels of the splitter at most.
SAMPLE, SAMPLE_BYTES, LEVELS = 8192, 16 << 20, 10
#: Roots of a directory, blocks that meet a shard in one group, blocks whose state a task holds.
ROOTS, TOGETHER, HELD = 512, 128, 256
NO_SCORE, NO_ID = -(1 << 62), (1 << 63) - 1


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def far_points(rows: np.ndarray) -> np.ndarray:
    """The direction from the point furthest from another to that furthest from it."""
    a = rows[np.argmax(((rows - rows.mean(axis=0)) ** 2).sum(axis=1))]
    b = rows[np.argmax(((rows - a) ** 2).sum(axis=1))]
    return b - a


def splitter(sample: np.ndarray, levels: int = LEVELS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Directions and thresholds, level by level, of a tree that halves the sample between far points."""
    sample = sample.astype(np.float64)
    parts, ways, cuts = [sample], [], []
    while len(ways) < levels and max(len(p) for p in parts) > 2 * LEAF:
        way = np.stack([far_points(p) if len(p) else np.zeros(sample.shape[1]) for p in parts])
        seen = [p @ w for p, w in zip(parts, way)]
        cut = np.array([np.median(s) if len(s) else 0.0 for s in seen])
        parts = [half for p, s, c in zip(parts, seen, cut) for half in (p[s <= c], p[s > c])]
        ways.append(way)
        cuts.append(cut)
    return ways, cuts


def cells(rows: np.ndarray, split: tuple[list[np.ndarray], list[np.ndarray]]) -> np.ndarray:
    """The splitter's leaf, in order, of each row."""
    at = np.zeros(len(rows), np.int64)
    for way, cut in zip(*split):
        at = 2 * at + ((rows * way[at]).sum(axis=1) > cut[at])
    return at << (LEVELS - len(split[0]))


def spans(n: int, leaf: int = LEAF) -> list[tuple[int, int, int, int]]:
    """The nodes (start, end, left, right) of a tree of ``n`` rows halved down to leaves, whose children are -1."""
    out: list[tuple[int, int, int, int]] = []

    def add(a: int, b: int) -> int:
        k = len(out)
        out.append((a, b, -1, -1))
        if b - a > leaf:
            left, right = add(a, (a + b) // 2), add((a + b) // 2, b)
            out[k] = (a, b, left, right)
        return k

    add(0, n)
    return out


class Tree:
    """A shard's vectors in the order of its ball tree, and the balls."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        order, real = np.arange(len(ids)), rows.astype(np.float64)
        self.nodes = spans(len(ids), leaf)
        for a, b, left, _ in self.nodes:
            if left >= 0:
                own = order[a:b]
                order[a:b] = own[np.lexsort((ids[own], real[own] @ far_points(real[own])))]
        self.ids, self.rows = ids[order], rows[order]
        self._balls()

    def _balls(self) -> None:
        real = self.real = self.rows.astype(np.float64)
        self.centres = np.stack([real[a:b].mean(axis=0) for a, b, _, _ in self.nodes])
        self.radii = np.array([np.sqrt(((real[a:b] - c) ** 2).sum(axis=1).max()) for (a, b, _, _), c in zip(self.nodes, self.centres)])
        self.least = np.array([self.ids[a:b].min() for a, b, _, _ in self.nodes])
        self.top = int(np.abs(self.rows).max(initial=0))

    def row(self) -> dict:
        kind = np.int32 if self.top < 1 << 31 else np.int64
        whole = {"ids": self.ids.tobytes(), "rows": self.rows.astype(kind).tobytes(), "centres": self.centres.tobytes(), "radii": self.radii.tobytes(), "least": self.least.tobytes()}
        return whole | {"dim": self.rows.shape[1], "wide": kind is np.int64}

    @classmethod
    def read(cls, row: dict, leaf: int = LEAF) -> Tree:
        self = cls.__new__(cls)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.rows = np.frombuffer(row["rows"], np.int64 if row["wide"] else np.int32).reshape(len(self.ids), row["dim"]).astype(np.int64)
        self.real, self.top = self.rows.astype(np.float64), int(np.abs(self.rows).max(initial=0))
        self.radii, self.least = np.frombuffer(row["radii"], np.float64), np.frombuffer(row["least"], np.int64)
        self.centres = np.frombuffer(row["centres"], np.float64).reshape(len(self.radii), row["dim"])
        self.nodes = spans(len(self.ids), leaf)
        return self


def upper(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """For each query and ball the bound of their products, with some room for rounding."""
    long = np.linalg.norm(queries, axis=1)[:, None]
    room = 1e-9 * long * (np.linalg.norm(centres, axis=1) + radii)[None]
    return queries @ centres.T + long * radii[None] + room


def products(queries: np.ndarray, rows: np.ndarray, top: int) -> np.ndarray:
    """Inner products as exact whole numbers; ``top`` bounds the sizes of the components of ``rows``."""
    most = int(np.abs(queries).max(initial=0)) * top * max(1, queries.shape[1])
    if most < 1 << 53:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if most >= 1 << 62:
        raise ArithmeticError("inner products of these vectors may not fit into 64 bits")
    return queries.astype(np.int64) @ rows.T.astype(np.int64)


class Best:
    """The k best (score, id) so far of each query of a block, and floors known from elsewhere."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, floors: np.ndarray, last: np.ndarray):
        self.ids, self.rows, self.real, self.k = ids, rows, rows.astype(np.float64), k
        self.scores, self.found = np.full((len(ids), k), NO_SCORE), np.full((len(ids), k), NO_ID)
        self.floors, self.last = floors.copy(), last.copy()

    def hopeful(self, bounds: np.ndarray, least: int) -> np.ndarray:
        """The queries that a ball of these bounds and smallest id can still serve."""
        return (bounds >= self.floors) & ~((bounds < self.floors + 1) & (least > self.last))

    def take(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge the scores of the queries ``at`` with rows ``ids``."""
        scores = np.where(ids[None] == self.ids[at][:, None], NO_SCORE, scores)
        some = (scores >= self.floors[at][:, None]).any(axis=1)
        at, scores = at[some], scores[some]
        if not len(at):
            return
        every = np.concatenate([self.scores[at], scores], axis=1)
        named = np.concatenate([self.found[at], np.where(scores == NO_SCORE, NO_ID, np.broadcast_to(ids, scores.shape))], axis=1)
        order = np.lexsort((named, -every), axis=1)[:, : self.k]
        self.scores[at], self.found[at] = np.take_along_axis(every, order, 1), np.take_along_axis(named, order, 1)
        kth, last = self.scores[at, -1], self.found[at, -1]
        better = (kth > self.floors[at]) | ((kth == self.floors[at]) & (last < self.last[at]))
        self.floors[at[better]], self.last[at[better]] = kth[better], last[better]


def search(best: Best, tree: Tree) -> int:
    """Branch and bound over a tree for all queries of a block; the number of leaves scored."""
    bounds = upper(best.real, tree.centres, tree.radii)
    heap, leaves = [(-float(bounds[:, 0].max()), 0)], 0
    while heap:
        _, node = heapq.heappop(heap)
        at = np.flatnonzero(best.hopeful(bounds[:, node], tree.least[node]))
        if not len(at):
            continue
        a, b, left, right = tree.nodes[node]
        if left < 0:
            leaves += 1
            best.take(at, products(best.rows[at], tree.real[a:b], tree.top), tree.ids[a:b])
        else:
            for child in (left, right):
                heapq.heappush(heap, (-float(bounds[at, child].max()), child))
    return leaves


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, dim, v): the rows that take part, in whole numbers."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    return vectors.where(fine).select(F.col(vec_id).cast("long").alias("vec_id"), F.size(vector).alias("dim"), F.transform(v, lambda x: F.floor(SCALE * x)).alias("v"))


def _placed(rows: DataFrame, splits: Shared) -> DataFrame:
    """``rows`` in range partitions, similar vectors side by side."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                if dim in splits.value and dim:
                    cell[at] = cells(matrix(batch.column("v").take(pa.array(at)), dim), splits.value[dim])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    named = rows.mapInArrow(run, "vec_id long, dim int, v array<long>, cell long")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return named.repartitionByRange(parts, "dim", "cell", "vec_id", "v").sortWithinPartitions("dim", "cell", "vec_id", "v")


def _packed(placed: DataFrame, most: int, limit: int, made, schema: str) -> DataFrame:
    """Consecutive rows of one length, up to ``most`` and ``limit`` bytes, as one row each by ``made(ids, rows)``."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def packs(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal n, held
            ids, rows = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            step = max(1, min(most, limit // (8 * max(1, rows.shape[1]))))
            done = 0
            while len(ids) - done >= step or (final and done < len(ids)):
                yield pa.RecordBatch.from_pylist([{"pack": part + n} | made(ids[done : done + step], rows[done : done + step])])
                n, done = n + 1, done + step
            held = [(ids[done:], rows[done:])] if done < len(ids) else []

        for batch in batches:
            dims = batch.column("dim").to_numpy()
            ids = batch.column("vec_id").to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)  # lengths come in order
                if held and held[0][1].shape[1] != dim:
                    yield from packs(True)
                held.append((ids[at], matrix(batch.column("v").take(pa.array(at)), dim)))
                yield from packs(False)
        if held:
            yield from packs(True)

    return placed.mapInArrow(run, schema)


TREES = "pack long, ids binary, rows binary, centres binary, radii binary, least binary, dim long, wide boolean"
BLOCKS = "pack long, dim long, ids binary, rows binary, floors binary, last binary"


def _directories(shards: DataFrame) -> DataFrame:
    """(dir, dim, packs, centres, radii, least): the roots of up to ROOTS shards of one length."""
    root = shards.select("pack", "dim", F.substring("centres", 1, 8 * F.col("dim")).alias("centre"), F.substring("radii", 1, 8).alias("radius"), F.substring("least", 1, 8).alias("low"))
    placed = numbered(root, ["dim", "pack"], "place").withColumn("dir", F.floor(F.col("place") / float(ROOTS)).cast("int"))
    gathered = placed.groupBy("dir", "dim").agg(F.array_sort(F.collect_list(F.struct("pack", "centre", "radius", "low"))).alias("roots"))
    return written(gathered, "directories")


def _pairs(blocks: DataFrame, directories: DataFrame, first: bool) -> DataFrame:
    """(block, shard): the shards that a block has to visit; with ``first`` those of its queries' highest bounds."""
    last = directories.agg(F.max("dir")).first()[0] or 0
    sent = blocks.withColumn("dir", F.explode(F.sequence(F.lit(0), F.lit(last))))
    both = sent.join(directories.withColumnRenamed("dim", "dim2"), "dir").where("dim = dim2").drop("dim2", "dir")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                best = _best(row, 1)
                roots, dim = row["roots"], row["dim"]
                centres = np.frombuffer(b"".join(r["centre"] for r in roots), np.float64).reshape(len(roots), dim)
                radii, least = (np.frombuffer(b"".join(r[c] for r in roots), kind) for c, kind in (("radius", np.float64), ("low", np.int64)))
                bounds = upper(best.real, centres, radii)
                fits = (bounds >= best.floors[:, None]) & ~((bounds < best.floors[:, None] + 1) & (least[None] > best.last[:, None]))
                if first:
                    fits = fits & (bounds == bounds.max(axis=1)[:, None])
                hit = np.flatnonzero(fits.any(axis=0))
                packs = np.array([roots[k]["pack"] for k in hit.tolist()], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), row["pack"])), pa.array(packs)], names=["block", "shard"])

    return both.mapInArrow(run, "block long, shard long")


def _best(row: dict, k: int) -> Best:
    ids = np.frombuffer(row["ids"], np.int64)
    rows = np.frombuffer(row["rows"], np.int64).reshape(len(ids), row["dim"])
    return Best(ids, rows, k, np.frombuffer(row["floors"], np.int64), np.frombuffer(row["last"], np.int64))


def _visits(pairs: DataFrame, blocks: DataFrame, shards: DataFrame, k: int, leaf: int) -> DataFrame:
    """(block, at, vec_id, score): what the queries of the blocks find in the shards that they visit."""
    place = F.row_number().over(Window.partitionBy("shard").orderBy("block")) - 1
    told = pairs.withColumn("salt", F.floor(place / float(TOGETHER)).cast("int"))
    one = told.select("shard", "salt").distinct().join(shards.withColumnRenamed("pack", "shard"), "shard").withColumn("side", F.lit(0))
    other = told.join(blocks.withColumnRenamed("pack", "block"), "block").withColumn("side", F.lit(1))
    both = one.unionByName(other, allowMissingColumns=True).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "side", "block")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held = None, OrderedDict()

        def told(block: int, best: Best) -> pa.RecordBatch:
            at, n = np.nonzero(best.scores > NO_SCORE)
            arrays = [np.full(len(at), block), at, best.found[at, n], best.scores[at, n]]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names=["block", "at", "vec_id", "score"])

        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in batch.schema.names}
                if row["side"] == 0:
                    tree = Tree.read(row, leaf)
                    continue
                best = held.pop(row["block"], None)
                if best is None:
                    best = _best(row, k)
                held[row["block"]] = best  # the kth scores go on to the next shard of this task
                search(best, tree)
                if len(held) > HELD:
                    yield told(*held.popitem(last=False))
        for block, best in held.items():
            yield told(block, best)

    return both.mapInArrow(run, "block long, at long, vec_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    """Of each query (block, at) the k best rows, ranked."""
    order = Window.partitionBy("block", "at").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, wanted: Column | None = None, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", shard: int = SHARD, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``wanted`` chooses (ids divisible by 100) the k highest inner products
    among all other rows, equal ones by id."""
    spark = vectors.sparkSession
    rows = written(usable(vectors, vec_id, vector), "vectors")
    longest = rows.agg(F.max("dim")).first()[0] or 1
    drawn = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(min(SAMPLE, SAMPLE_BYTES // (8 * longest) + 1)).collect()  # bounded in rows and bytes
    sample = {}
    for dim in sorted({r["dim"] for r in drawn}):
        own = [r for r in drawn if r["dim"] == dim]
        sample[dim] = (np.array([r["vec_id"] for r in own], np.int64), np.array([r["v"] for r in own], np.int64).reshape(len(own), dim))
    splits = Shared(spark, {d: splitter(s[1]) for d, s in sample.items() if d})
    shared = Shared(spark, sample)

    def tree(ids: np.ndarray, own: np.ndarray) -> dict:
        return Tree(ids, own, leaf).row()

    def asked(ids: np.ndarray, own: np.ndarray) -> dict:
        best = Best(ids, own, k, np.full(len(ids), NO_SCORE), np.full(len(ids), NO_ID))
        known = shared.value.get(own.shape[1])
        if known is not None:
            best.take(np.arange(len(ids)), products(own, known[1], int(np.abs(known[1]).max(initial=0))), known[0])
        return {"dim": own.shape[1], "ids": ids.tobytes(), "rows": own.tobytes(), "floors": best.floors.tobytes(), "last": best.last.tobytes()}

    chosen = rows.where(F.col("vec_id") % 100 == 0 if wanted is None else wanted).distinct()
    shards = written(_packed(_placed(rows, splits), shard, SHARD_BYTES, tree, TREES), "shards")
    blocks = written(_packed(_placed(chosen, splits), block, SHARD_BYTES, asked, BLOCKS), "blocks")
    directories = _directories(shards)
    ahead = written(_pairs(blocks, directories, True), "pairs")
    first = written(_visits(ahead, blocks, shards, k, leaf), "found")
    kth = _top(first, k).where(F.col("rank") == k).select("block", "at", "score", "vec_id")
    raised = written(_raised(blocks, kth), "blocks")
    rest = written(_pairs(raised, directories, False).join(ahead, ["block", "shard"], "left_anti"), "pairs")
    second = _visits(rest, raised, shards, k, leaf)
    names = blocks.select(F.col("pack").alias("block"), "ids").mapInArrow(_names, "block long, at long, query_id long")
    best = _top(first.unionByName(second), k).join(names, ["block", "at"])
    out = written(best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "top")
    release(rows, shards, blocks, directories, ahead, first, raised, rest)
    return out


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of the queries of each block."""
    for batch in batches:
        for block, ids in zip(batch.column("block").to_pylist(), batch.column("ids").to_pylist()):
            named = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (np.full(len(named), block), np.arange(len(named)), named)], names=["block", "at", "query_id"])


def _raised(blocks: DataFrame, kth: DataFrame) -> DataFrame:
    """The blocks with the kth (score, id) that their queries have found, where those are better than the floors they had."""
    told = kth.groupBy(F.col("block").alias("pack")).agg(F.collect_list(F.struct("at", "score", "vec_id")).alias("kth"))  # BLOCK rows at most

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors, last = [], []
            for own, end, kth in zip(*(batch.column(c).to_pylist() for c in ("floors", "last", "kth"))):
                f, e = np.frombuffer(own, np.int64).copy(), np.frombuffer(end, np.int64).copy()
                for q in kth or []:
                    if (-q["score"], q["vec_id"]) < (-f[q["at"]], e[q["at"]]):
                        f[q["at"]], e[q["at"]] = q["score"], q["vec_id"]
                floors.append(f.tobytes())
                last.append(e.tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("pack", "dim", "ids", "rows")), pa.array(floors, pa.binary()), pa.array(last, pa.binary())], names=[c.split()[0] for c in BLOCKS.split(", ")])

    return blocks.join(told, "pack", "left").mapInArrow(run, BLOCKS)
