"""Operator 1: reversible line deduplication with sharded cuckoo filters over exact reference counts.

A line's key is the line, stripped of white space at both ends and with A-Z lower-cased, as a 128-bit digest. The index
has two tables: how many documents hold each key (exact), and a cuckoo filter for each shard of keys, which holds the
keys found in at least ``threshold`` documents. Adding or deleting documents adds to or subtracts from the counts;
keys that cross the threshold are inserted into or deleted from their shard's filter. So an index from which documents
were deleted equals one that never held them.

To clean documents, their distinct keys meet the filters, shard by shard; only hits go on to the exact counts, which
remove the filters' false positives. A shard's lines are dealt over several tasks, each with a copy of its filter (of
bounded size: SHARD_KEYS keys), read as a stream, so a line in a third of all documents fills no task. The confirmation is
an ordinary join that Spark splits where a key is skewed.

Defined cases: null and empty texts have one empty line; keys shorter than ``shortest`` code points are never dropped;
a line repeated in a document counts as one document; repeated rows and null ids are documents of their own; an empty
table gives an empty table; further columns pass through ``cleaned``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WHITE, lean, mix64, pieces_of, renamed, written

THRESHOLD = 10
SHORTEST = 1
SHARD_KEYS = 200_000
SLOTS = 4
KICKS = 500


class CuckooFilter:
    """16-bit fingerprints in buckets of four; each key may stand in two buckets."""

    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, SLOTS), dtype=np.uint16)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(2, int(keys / (SLOTS * 0.8))).bit_length())

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        out = cls(0)
        out.table = np.frombuffer(data, dtype=np.uint16).reshape(-1, SLOTS).copy()
        return out

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mixed = mix64(keys.astype(np.uint64))
        print_ = ((mixed >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        one = (mixed & np.uint64(len(self.table) - 1)).astype(np.int64)
        return print_, one, one ^ self._turn(print_)

    def _turn(self, print_: np.ndarray) -> np.ndarray:
        return (mix64(print_.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        print_, one, two = self._places(keys)
        return ((self.table[one] == print_[:, None]) | (self.table[two] == print_[:, None])).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if a key found no place: build a larger filter then."""
        rng = np.random.Generator(np.random.PCG64(len(self.table)))
        for p, a, b in zip(*(x.tolist() for x in self._places(keys))):
            if not self._put(p, a) and not self._put(p, b):
                at = (a, b)[int(rng.integers(2))]
                for _ in range(KICKS):
                    slot = int(rng.integers(SLOTS))
                    p, self.table[at, slot] = int(self.table[at, slot]), p
                    at ^= int(self._turn(np.array([p], dtype=np.uint16))[0])
                    if self._put(p, at):
                        break
                else:
                    return False
        return True

    def _put(self, print_: int, bucket: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = print_
        return bool(len(free))

    def delete(self, keys: np.ndarray) -> None:
        """Delete keys that were inserted."""
        for p, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for at in (a, b):
                held = np.flatnonzero(self.table[at] == p)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        out = cls.sized(len(keys))
        while not out.insert(keys):
            out = cls(2 * len(out.table))
        return out


@dataclass
class LineIndex:
    """refs: (k1, k2, refs); filters: (shard, filter)."""

    refs: DataFrame
    filters: DataFrame
    shards: int
    threshold: int
    shortest: int


def key_of(line: bytes, shortest: int) -> bytes:
    """16 bytes for a line; zeros for one that is too short."""
    key = line.strip(WHITE).lower()
    short = not key if shortest <= 1 else len(key) < 4 * shortest and len(key.decode("utf-8", "replace")) < shortest
    return bytes(16) if short else hashlib.blake2b(key, digest_size=16).digest()


def with_keys(docs: DataFrame, text: str, shortest: int) -> DataFrame:
    """Add _k1 and _k2, the halves of each line's key in order; 0 and 0 for lines that are too short; and _first, whether the
    key is the document's first of its kind."""
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([*docs.schema.fields, T.StructField("_k1", longs), T.StructField("_k2", longs), T.StructField("_first", T.ArrayType(T.BooleanType()))])

    def first(keys: list[bytes]) -> list[bool]:
        place = dict(zip(reversed(keys), range(len(keys) - 1, -1, -1)))
        return [place[k] == i for i, k in enumerate(keys)]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces_of(batch, text):
                keys = [[key_of(x, shortest) for x in t.split(b"\n")] for t in texts]
                halves = np.frombuffer(b"".join([k for own in keys for k in own]), dtype=np.int64).reshape(-1, 2)
                at = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in keys])]), pa.int32())
                values = [*(pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1)), pa.array([f for own in keys for f in first(own)], pa.bool_())]
                new = [pa.ListArray.from_arrays(at, v) for v in values]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def _distinct_keys(own: DataFrame) -> DataFrame:
    """(rid, k1, k2), one row for each document and distinct key."""
    rid = F.col("_rid").alias("rid") if "_rid" in own.columns else F.lit(None).cast("long").alias("rid")
    pairs = own.select(rid, F.explode(F.filter(F.arrays_zip("_k1", "_k2", "_first"), lambda x: x["_first"])).alias("key"))
    return pairs.select("rid", F.col("key._k1").alias("k1"), F.col("key._k2").alias("k2")).where("k1 != 0 or k2 != 0")


def _counted(own: DataFrame) -> DataFrame:
    return _distinct_keys(own).groupBy("k1", "k2").agg(F.count("*").alias("refs"))


def _filters(frequent: DataFrame, shards: int) -> DataFrame:
    def build(keys: pd.DataFrame) -> pd.DataFrame:
        keys = keys.sort_values("k2")
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "filter": [CuckooFilter.of(keys["k2"].to_numpy(np.int64).view(np.uint64)).dump()]})

    sharded = frequent.select(F.pmod("k1", F.lit(shards)).cast("int").alias("shard"), "k2")
    return sharded.groupBy("shard").applyInPandas(build, "shard int, filter binary")


def _index(refs: DataFrame, threshold: int, shortest: int, shard_keys: int) -> LineIndex:
    frequent = refs.where(F.col("refs") >= threshold)
    shards = -(-frequent.count() // shard_keys) or 1
    return LineIndex(refs, written(_filters(frequent, shards), "filters"), shards, threshold, shortest)


def build(docs: DataFrame, text: str = "text", threshold: int = THRESHOLD, shortest: int = SHORTEST, shard_keys: int = SHARD_KEYS) -> LineIndex:
    """An index of all lines of ``docs``."""
    return _index(written(_counted(with_keys(docs.select(text), text, shortest)), "refs"), threshold, shortest, shard_keys)


def update(index: LineIndex, added: DataFrame | None = None, removed: DataFrame | None = None, text: str = "text") -> LineIndex:
    """The index after adding some documents and deleting others, which it must hold."""
    t = index.threshold
    change = index.refs.select("k1", "k2", F.col("refs").alias("old"), F.lit(0).cast("long").alias("by"))
    for docs, sign in ((added, 1), (removed, -1)):
        if docs is not None:
            counted = _counted(with_keys(docs.select(text), text, index.shortest))
            change = change.unionAll(counted.select("k1", "k2", F.lit(0).cast("long").alias("old"), (sign * F.col("refs")).alias("by")))
    now = written(change.groupBy("k1", "k2").agg(F.sum("old").alias("old"), (F.sum("old") + F.sum("by")).alias("refs")), "refs")
    if not now.where("refs < 0").isEmpty():
        raise ValueError("documents were removed that the index does not hold")
    refs = now.where("refs > 0").select("k1", "k2", "refs")
    crossed = now.where((F.col("old") >= t) != (F.col("refs") >= t))
    crossed = crossed.select(F.pmod("k1", F.lit(index.shards)).cast("int").alias("shard"), "k2", (F.col("refs") >= t).alias("comes"))

    def turn(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        shard = int((old if len(old) else keys)["shard"].iloc[0])
        if not len(keys):
            return pd.DataFrame({"shard": [shard], "filter": [old["filter"].iloc[0]]})
        values, comes = keys["k2"].to_numpy(np.int64).view(np.uint64), keys["comes"].to_numpy(bool)
        filter_ = CuckooFilter.load(old["filter"].iloc[0]) if len(old) else CuckooFilter.sized(len(values))
        filter_.delete(values[~comes])
        return pd.DataFrame({"shard": [shard], "filter": [filter_.dump() if filter_.insert(np.sort(values[comes])) else None]})

    turned = written(index.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(turn, "shard int, filter binary"), "filters")
    full = turned.where("filter is null").select("shard")
    if not full.isEmpty():  # shards that outgrew their filter are built again from the exact counts
        frequent = refs.where(F.col("refs") >= t)
        again = _filters(frequent.join(full, F.pmod("k1", F.lit(index.shards)) == full["shard"], "left_semi"), index.shards)
        turned = written(turned.where("filter is not null").unionAll(again), "filters")
    return LineIndex(refs, turned, index.shards, t, index.shortest)


def _hits(index: LineIndex, keys: DataFrame) -> DataFrame:
    """The (rid, k1, k2) whose key the filters hold."""
    spark = keys.sparkSession
    salts = -(-8 * int(spark.conf.get("spark.sql.shuffle.partitions")) // index.shards)
    shard, salt = F.pmod("k1", F.lit(index.shards)), F.pmod(F.xxhash64("rid"), F.lit(salts))
    lines = keys.select((shard * salts + salt).alias("group"), F.lit(1).alias("kind"), "rid", "k1", "k2", F.lit(None).cast("binary").alias("filter"))
    none = F.lit(None).cast("long")
    copies = F.transform(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: F.col("shard").cast("long") * salts + i)
    filters = index.filters.select(F.explode(copies).alias("group"), F.lit(0).alias("kind"), none.alias("rid"), none.alias("k1"), none.alias("k2"), "filter")
    dealt = lines.unionAll(filters).repartition("group").sortWithinPartitions("group", "kind")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = None, None
        for batch in batches:
            groups = batch.column("group").to_numpy(zero_copy_only=False)
            kinds = batch.column("kind").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(groups) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(groups)]):
                if a == b:
                    continue
                if kinds[a] == 0:
                    held, current = CuckooFilter.load(batch.column("filter")[b - 1].as_py()), groups[a]
                elif held is not None and current == groups[a]:
                    part = batch.slice(a, b - a)
                    yes = held.contains(part.column("k2").to_numpy(zero_copy_only=False).view(np.uint64))
                    yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(yes)) for c in ("rid", "k1", "k2")], names=["rid", "k1", "k2"])

    return dealt.mapInArrow(run, "rid long, k1 long, k2 long")


def cleaned(docs: DataFrame, index: LineIndex | None = None, text: str = "text", threshold: int = THRESHOLD, shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with the text left without its frequent lines (joined by \\n), and n_lines and n_dropped (long) added.

    Without ``index`` the documents are counted among themselves.
    """
    source = renamed(docs, {"n_lines", "n_dropped", "_rid", "_k1", "_k2", "_first", "_drop"})
    own = written(with_keys(source, text, index.shortest if index else shortest).withColumn("_rid", F.monotonically_increasing_id()), "lines")
    if index is None:
        index = _index(written(_counted(own), "refs"), threshold, shortest, SHARD_KEYS)
    hits = _hits(index, _distinct_keys(own))
    sure = hits.join(index.refs.where(F.col("refs") >= index.threshold).select("k1", "k2"), ["k1", "k2"])
    drop = sure.groupBy("rid").agg(F.collect_list(F.struct("k1", "k2")).alias("_drop")).withColumnRenamed("rid", "_rid")
    schema = T.StructType([*source.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces_of(batch, text):
                out, lines, dropped = [], [], []
                for t, drops, k1, k2 in zip(texts, part.column("_drop").to_pylist(), part.column("_k1"), part.column("_k2")):
                    n = len(k1)
                    lines.append(n)
                    if not drops:
                        out.append(t)
                        dropped.append(0)
                        continue
                    gone = {(d["k1"], d["k2"]) for d in drops}
                    kept = [x for x, key in zip(t.split(b"\n"), zip(k1.as_py(), k2.as_py())) if key not in gone]
                    out.append(b"\n".join(kept))
                    dropped.append(n - len(kept))
                new = {text: pa.array(out, pa.binary()).cast(pa.string()), "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
                yield pa.RecordBatch.from_arrays([new[c] if c in new else part.column(c) for c in schema.fieldNames()], names=schema.fieldNames())

    return own.join(drop, "_rid", "left").select(*source.columns, "_k1", "_k2", "_drop").mapInArrow(run, schema)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, shortest: int = SHORTEST) -> DataFrame:
    """One row a document: doc_id, n_lines, n_dropped, kept_sha256."""
    done = cleaned(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), None, "text", threshold, shortest)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
