"""Operator 7: near-duplicate embeddings by PCA-ordered tiled comparison.

Unit vectors are turned to the principal axes of a bounded sample. Turning changes no cosine, it only brings the large
components to the front. Vectors are sorted by their cell on the first axes and cut into tiles, and neighbouring tiles into
buckets. A pair of tiles is left out if the boxes around them are further apart than the threshold allows. Otherwise the
products of the components up to the first of ``stops`` are accumulated for all pairs at once, together with the product of
the norms of what is left; where the sum of both, an upper bound, cannot reach the threshold, the pair stops. The others go
on to the next stop. For the few that pass the last, the cosine is taken in double precision from the vectors as given.

Tiles meet in groups (i, j) of buckets. Which tiles can link with which buckets is settled on tables of boxes first, of many
buckets, of buckets, and of tiles, so a tile is sent to those groups alone. Tiles, buckets and the sample are bounded in bytes, no task has a key of its own to
grow, and equal vectors are compared once, with their number. Within a pair of tiles only counts and a spanning forest of
the links leave the task, never all pairs of a group.

Exact for any number of vectors and any rotation; the work is quadratic in tiles that the bounds cannot rule out.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null id, link
with nothing; vectors of different lengths do not link; repeated rows link with each other; rows with the same id are one
node of a component; an empty table gives an empty table; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import numbered
from .common import Shared, lean, release, written
from .graph import connected_components

THRESHOLD = 0.95
#: Vectors of a tile at most, and bytes of a tile, of a bucket of tiles and of the sample, about; vectors are held as doubles.
TILE, TILE_BYTES, BUCKET_BYTES, SAMPLE, SAMPLE_BYTES = 1024, 1 << 20, 32 << 20, 20_000, 32 << 20
#: Numbers of leading components after which pairs may stop.
STOPS = (8, 16, 32)
#: Buckets at least, so that small tables are dealt over some tasks.
LEAST_BUCKETS = 12
CELL_AXES, BOX_AXES = 3, 8
#: Buckets of a larger box.
BOXED = 64
SLACK = 1e-5


def axes(sample: list[np.ndarray]) -> dict[int, np.ndarray]:
    """For each length of vector, the principal axes (columns, largest first) of the sample's unit vectors."""
    out = {}
    for size in sorted({len(v) for v in sample}):
        rows = np.stack([v for v in sample if len(v) == size]).astype(np.float64)
        rows /= np.linalg.norm(rows, axis=1)[:, None]
        out[size] = np.linalg.eigh(rows.T @ rows)[1][:, ::-1]
    return out


def turned(rows: np.ndarray, basis: dict[int, np.ndarray]) -> np.ndarray:
    """Unit vectors on the principal axes."""
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    return unit @ basis[rows.shape[1]] if rows.shape[1] in basis else unit


def _usable(vectors: DataFrame) -> DataFrame:
    """(node, many, v): one row for each distinct usable vector, its smallest id and its number of rows."""
    v = F.col("v")
    fine = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    fine = vectors.where(fine & F.exists(v, lambda x: x != 0))
    return fine.groupBy("v").agg(F.min("vec_id").cast("long").alias("node"), F.count("*").alias("many"))


def _tiles(nodes: DataFrame, basis: Shared, threshold: float, tile: int) -> DataFrame:
    """(tile, dim, low, high, nodes, many, rows): up to ``tile`` vectors each, near each other on the leading axes, and the box
    around them."""
    single = nodes.schema["v"].dataType.elementType == T.FloatType()  # tiles keep the vectors' own precision
    width = float(np.sqrt(2 - 2 * threshold)) or 1.0

    @lean
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("v").to_pylist()
            sizes = np.array([len(v) for v in rows], dtype=np.int64)
            found = np.zeros((len(rows), CELL_AXES), dtype=np.int64)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                front = turned(np.array([rows[k] for k in at.tolist()], dtype=np.float64), basis.value)[:, :CELL_AXES]
                found[at, : front.shape[1]] = np.floor(front / width)
            named = [pa.array(found[:, k], pa.int32()) for k in range(CELL_AXES)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *named], names=[*batch.schema.names, *(f"c{k}" for k in range(CELL_AXES))])

    keys = [f"c{k}" for k in range(CELL_AXES)]
    placed = nodes.mapInArrow(cells, f"v {nodes.schema['v'].dataType.simpleString()}, node long, many long, " + ", ".join(f"{k} int" for k in keys))
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.withColumn("dim", F.size("v")).repartitionByRange(parts, "dim", *keys, "node").sortWithinPartitions("dim", *keys, "node")

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        held: list[tuple[int, int, list[float]]] = []

        def made() -> pa.RecordBatch:
            nonlocal n
            n += 1
            rows = np.array([h[2] for h in held], dtype=np.float64)
            ids, many = (np.array([h[k] for h in held], dtype=np.int64) for k in (0, 1))
            front = np.zeros((len(rows), BOX_AXES))
            front[:, : rows.shape[1]] = turned(rows, basis.value)[:, :BOX_AXES]
            whole = rows.astype(np.float32) if single else rows
            return pa.RecordBatch.from_pylist([{
                "tile": (part << 33) | n, "dim": rows.shape[1], "low": front.min(axis=0).tolist(), "high": front.max(axis=0).tolist(),
                "nodes": ids.tobytes(), "many": many.tobytes(), "rows": whole.tobytes(),
            }])

        for batch in batches:
            for node, many, v in zip(*(batch.column(c).to_pylist() for c in ("node", "many", "v"))):
                if held and (len(held) == tile or 8 * len(held) * len(v) >= TILE_BYTES or len(held[0][2]) != len(v)):
                    yield made()
                    held = []
                held.append((node, many, v))
        if held:
            yield made()

    return placed.mapInArrow(cut, "tile long, dim long, low array<double>, high array<double>, nodes binary, many binary, rows binary")


class _Tile:
    def __init__(self, row: dict, basis: dict[int, np.ndarray], stops: tuple[int, ...]):
        self.nodes, self.many = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["many"], np.int64)
        single = len(row["rows"]) == 4 * len(self.nodes) * row["dim"]
        self.rows = np.frombuffer(row["rows"], np.float32 if single else np.float64).reshape(len(self.nodes), -1).astype(np.float64)
        axes_ = turned(self.rows, basis)
        self.low, self.high = np.array(row["low"]), np.array(row["high"])
        self.axes = axes_[:, : stops[-1]].astype(np.float32)
        self.left = [np.sqrt(np.maximum(0, 1 - (axes_[:, :s] ** 2).sum(axis=1))).astype(np.float32) for s in stops]
        self.front = np.concatenate([self.axes[:, : stops[0]], self.left[0][:, None]], axis=1)
        self.norm = np.linalg.norm(self.rows, axis=1)


def links(a: _Tile, b: _Tile, threshold: float, stops: tuple[int, ...] = STOPS) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (in a, in b) of the linked pairs; within one tile each pair once."""
    none = np.zeros(0, np.int64)
    if a.rows.shape[1] != b.rows.shape[1]:
        return none, none
    gap = np.maximum(0, np.maximum(a.low - b.high, b.low - a.high))
    if (gap**2).sum() > 2 - 2 * threshold + SLACK:
        return none, none
    i, j = np.nonzero(a.front @ b.front.T >= threshold - SLACK)
    if a is b:
        i, j = i[i < j], j[i < j]
    found = []
    for s in range(0, len(i), 1 << 15):
        x, y = i[s : s + (1 << 15)], j[s : s + (1 << 15)]
        upto, done = np.zeros(len(x), np.float32), 0
        for stop, left_a, left_b in zip(stops, a.left, b.left):  # products so far, and a bound of the rest
            upto = upto + np.einsum("ij,ij->i", a.axes[x, done:stop], b.axes[y, done:stop])
            on = upto + left_a[x] * left_b[y] >= threshold - SLACK
            x, y, upto, done = x[on], y[on], upto[on], stop
        sure = np.einsum("ij,ij->i", a.rows[x], b.rows[y]) / (a.norm[x] * b.norm[y]) >= threshold
        found.append((x[sure], y[sure]))
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (none, none)


def _forest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node of the edges (x, y) the smallest node that they join it to."""
    nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    p, q, root = at[: len(x)], at[len(x) :], np.arange(len(nodes))
    while True:
        low = np.minimum(root[p], root[q])
        new = root.copy()
        np.minimum.at(new, root[p], low)
        np.minimum.at(new, root[q], low)
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def _near(threshold: float) -> Column:
    """Whether the boxes (low, high) and (low2, high2) are so near that vectors inside can link."""
    apart = [F.greatest(F.lit(0.0), F.col("low")[k] - F.col("high2")[k], F.col("low2")[k] - F.col("high")[k]) for k in range(BOX_AXES)]
    return sum((g * g for g in apart), F.lit(0.0)) <= 2 - 2 * threshold + SLACK


def _sent(tiles: DataFrame, buckets: int, threshold: float) -> DataFrame:
    """The tiles with group and side, once for each group of buckets (i, j) in which they can have a link.

    Buckets are held against boxes of BOXED buckets first, then against the buckets of those that are near, and tiles against
    the buckets that theirs is near to: no tile meets a bucket that its neighbours rule out.
    """
    count = tiles.count()
    light = written(numbered(tiles.select("tile", "dim", "low", "high"), ["tile"], "place").select("tile", "dim", "low", "high", F.expr(f"cast(place * {buckets} div {max(1, count)} as int)").alias("bucket")), "tiles")
    bound = lambda low, high: [F.array(*(F.min(F.col("low")[k]) for k in range(BOX_AXES))).alias(low), F.array(*(F.max(F.col("high")[k]) for k in range(BOX_AXES))).alias(high)]
    boxes = written(light.groupBy("bucket", "dim").agg(*bound("low", "high")), "boxes")
    wide = boxes.groupBy(F.expr(f"bucket div {BOXED}").alias("box"), "dim").agg(*bound("low2", "high2"))
    coarse = boxes.withColumn("box", F.explode(F.sequence(F.lit(0), F.lit((buckets - 1) // BOXED)))).join(wide, ["box", "dim"]).where(_near(threshold)).drop("low2", "high2")
    named = boxes.select(F.col("bucket").alias("other"), "dim", F.col("low").alias("low2"), F.col("high").alias("high2"))
    inside = F.sequence((F.col("box") * BOXED).cast("bigint"), (F.least((F.col("box") + 1) * BOXED, F.lit(buckets)) - 1).cast("bigint"))
    fine = coarse.withColumn("other", F.explode(inside)).join(named, ["other", "dim"]).where(_near(threshold)).select("bucket", "dim", "other", "low2", "high2")
    near = light.join(fine, ["bucket", "dim"]).where(_near(threshold))
    where = near.groupBy("tile", "bucket").agg(F.collect_set("other").alias("others"))  # one number a bucket at most
    out = tiles.join(where, "tile").withColumn("other", F.explode("others")).drop("others")
    i, j = F.least("bucket", "other"), F.greatest("bucket", "other")
    return out.withColumn("side", (F.col("bucket") != i).cast("int")).withColumn("group", i * buckets + j).drop("bucket", "other")


def _compared(tiles: DataFrame, basis: Shared, buckets: int, threshold: float, stops: tuple[int, ...]) -> DataFrame:
    """(node, links, root): for each group of tiles, a node's number of links there and a node that they lead to."""
    parts = max(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets)
    sent = _sent(tiles, buckets, threshold).repartition(parts, "group").sortWithinPartitions("group", "side", "tile")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, left = None, []
        gathered: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def told() -> pa.RecordBatch:
            arrays = [np.concatenate([g[k] for g in gathered]) for k in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names=["node", "links", "root"])

        def met(a: _Tile, b: _Tile) -> None:
            i, j = links(a, b, threshold, stops)
            if a is b:
                same = np.flatnonzero(a.many > 1)  # equal vectors link with each other
                if len(same):
                    gathered.append((a.nodes[same], a.many[same] - 1, a.nodes[same]))
            if not len(i):
                return
            nodes, root = _forest(a.nodes[i], b.nodes[j])
            count = np.zeros(len(nodes), np.int64)
            np.add.at(count, np.searchsorted(nodes, a.nodes[i]), b.many[j])
            np.add.at(count, np.searchsorted(nodes, b.nodes[j]), a.many[i])
            gathered.append((nodes, count, root))

        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                if row["group"] != current:
                    if gathered:
                        yield told()
                        gathered = []
                    current, left = row["group"], []
                own = _Tile(row, basis.value, stops)
                i, j = divmod(current, buckets)
                for other in left if i == j or row["side"] else []:
                    met(other, own)
                if i == j:
                    met(own, own)
                if row["side"] == 0:  # of a pair of buckets, the first is held and the second streams by
                    left.append(own)
        if gathered:
            yield told()

    return sent.mapInArrow(run, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE, stops: tuple[int, ...] = STOPS) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    kind = "array<float>" if vectors.schema[vector].dataType == T.ArrayType(T.FloatType()) else "array<double>"
    given = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast(kind).alias("v"))
    nodes = written(_usable(given), "vectors")
    longest = nodes.agg(F.max(F.size("v"))).first()[0] or 1
    sample = nodes.select("v").orderBy(F.xxhash64("v"), "v").limit(min(SAMPLE, SAMPLE_BYTES // (8 * longest) + 1)).collect()  # it only orders axes
    basis = Shared(spark, axes([np.array(r["v"]) for r in sample]))
    tiles = written(_tiles(nodes, basis, threshold, tile), "tiles")
    size = tiles.agg(F.sum(F.length("nodes") * F.col("dim"))).first()[0] or 0  # 8 bytes a node, 8 a component
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    met = written(_compared(tiles, basis, buckets, threshold, stops), "links")
    components = connected_components(met.where("node != root"), "node", "root")
    degree = met.groupBy("node").agg(F.sum("links").alias("n_links"))
    known = nodes.select("node", "v").join(degree, "node", "left").join(components, "node", "left")
    known = written(known.select("v", "node", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "node").alias("component")), "known")
    release(nodes, tiles, met)
    out = given.where(F.col("vec_id").isNotNull()).join(known, "v", "left").unionByName(given.where(F.col("vec_id").isNull()), allowMissingColumns=True)
    component = F.coalesce(F.col("component"), F.col("vec_id").cast("long"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
