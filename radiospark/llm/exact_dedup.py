"""Operator 4: exact deduplication by deterministic block naming.

A text, its white-space runs replaced by one space, is cut into blocks of a fixed number of bytes. The distinct blocks
are sorted and numbered, so that equal blocks and only equal blocks share an integer name; then adjacent names are
paired and the distinct pairs sorted and numbered again, until every document has one name. (rounds, name) is its
identity: two documents share it if and only if their texts are equal, with no hash to collide.

At scale: blocks are made distinct by an aggregation with partial sums before they are sorted, so a block in very many
documents is one row a task; names come from sorting each hash partition (partition and rank in it), so no task sees more
than its partition, and go back to their places by a 128-bit digest of the block. Digests only address: where two
different blocks share one, which is looked for every time, the blocks themselves are joined. The rounds move integers
only, for the documents longer than a block. A group of copies is only ever counted and given its smallest id by an aggregation
with partial sums, and joined back as a skewed join that Spark can split.

Defined cases: null text counts as empty, and all empty texts are equal; a null id sorts after all others; of equal rows
with equal ids one stays; an empty table gives an empty table; columns other than id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, pieces_of, release, white_runs, written

BLOCK_BYTES = 4096


def cut(docs: DataFrame, block_bytes: int = BLOCK_BYTES, slice_bytes: int = 8 << 20) -> DataFrame:
    """Rows of two kinds, for (doc_id, text): a slice's distinct blocks (slice, idx, digest, block), and its documents
    (slice, row, doc_id, sha, idxs), whose blocks are named by position in the slice."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("slice", T.LongType()), T.StructField("idx", T.IntegerType()), T.StructField("digest", T.BinaryType()), T.StructField("block", T.BinaryType()), T.StructField("row", T.IntegerType()),
         T.StructField("doc_id", kind), T.StructField("sha", T.BinaryType()), T.StructField("idxs", T.ArrayType(T.IntegerType()))]
    )

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows, texts in pieces_of(batch, "text", slice_bytes):
                numbers: dict[bytes, int] = {}
                shas, idxs = [], []
                for text in texts:
                    plain = white_runs(text)
                    shas.append(hashlib.sha256(plain).digest())
                    idxs.append([numbers.setdefault(plain[a : a + block_bytes], len(numbers)) for a in range(0, max(1, len(plain)), block_bytes)])
                at, b, d = (part << 33) | n, len(numbers), rows.num_rows
                n += 1
                nothing = pa.nulls
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at] * b, pa.int64()), pa.array(range(b), pa.int32()), pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in numbers], pa.binary()), pa.array(list(numbers), pa.binary()), nothing(b, pa.int32()), nothing(b, rows.column("doc_id").type), nothing(b, pa.binary()), nothing(b, pa.list_(pa.int32()))],
                    names=schema.fieldNames(),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at] * d, pa.int64()), nothing(d, pa.int32()), nothing(d, pa.binary()), nothing(d, pa.binary()), pa.array(range(d), pa.int32()), rows.column("doc_id"), pa.array(shas, pa.binary()), pa.array(idxs, pa.list_(pa.int32()))],
                    names=schema.fieldNames(),
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def named(distinct: DataFrame, *content: str) -> DataFrame:
    """The distinct rows ``distinct`` with ``name``, an integer of their own: the place among the sorted rows of a partition.

    The number holds the partition and the rank, so it has to be written before anything is made of it.
    """
    return distinct.sortWithinPartitions(*content).withColumn("name", F.monotonically_increasing_id())


def _block_names(parts: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(slice, idx, name) of the blocks in ``parts``; the written tables behind it."""
    blocks = parts.where(F.col("block").isNotNull())
    numbers = named(blocks.select("digest", "block").distinct(), "block")
    by = ["digest"]
    names = written(numbers.select("digest", "name"), "sorted")
    if not names.groupBy("digest").count().where("count > 1").isEmpty():
        by = ["digest", "block"]
        release(names)
        names = written(numbers, "sorted")
    return blocks.select("slice", "idx", *by).join(names, by).select("slice", "idx", "name"), [names]


def _names(rows: DataFrame) -> DataFrame:
    """The names of each document in order, from rows (slice, row, doc_id, sha, pos, name)."""
    in_order = F.array_sort(F.collect_list(F.struct("pos", "name")))
    return rows.groupBy("slice", "row").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("sha").alias("sha"), F.transform(in_order, lambda x: x["name"]).alias("names"))


def _pair(i: Column) -> Column:
    names = F.col("names")
    return F.struct(F.get(names, 2 * i).alias("a"), F.coalesce(F.get(names, 2 * i + 1), F.lit(-1)).alias("b"))


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: slice and row (its place), doc_id, sha, rounds and name (its identity)."""
    parts = written(cut(docs, block_bytes), "blocks")
    names, behind = _block_names(parts)
    own = parts.where(F.col("row").isNotNull()).select("slice", "row", "doc_id", "sha", F.posexplode("idxs").alias("pos", "idx"))
    state = written(_names(own.join(names, ["slice", "idx"])), "names")
    release(parts, *behind)
    done, rounds, states = [], 0, [state]
    longest = state.agg(F.max(F.size("names"))).first()[0] or 0
    while True:
        done.append(state.where(F.size("names") == 1).select("slice", "row", "doc_id", "sha", F.lit(rounds).alias("rounds"), F.col("names")[0].alias("name")))
        if longest <= 1:
            break
        halves = F.transform(F.expr("sequence(0, (size(names) - 1) div 2)"), lambda i: _pair(i.cast("int")))
        pairs = state.where(F.size("names") > 1).select("slice", "row", "doc_id", "sha", F.posexplode(halves).alias("pos", "pair"))
        pairs = pairs.select("slice", "row", "doc_id", "sha", "pos", "pair.a", "pair.b")
        numbers = written(named(pairs.select("a", "b").distinct(), "a", "b"), "sorted")
        state = written(_names(pairs.join(numbers, ["a", "b"])), "names")
        release(numbers)
        states.append(state)
        rounds, longest = rounds + 1, (longest + 1) // 2
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    out = written(out, "identities")
    release(*states)
    return out


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = identities(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), block_bytes)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "slice", "row")).alias("first")
    groups = written(found.groupBy("rounds", "name").agg(F.count("*").alias("group_size"), first), "groups")
    both = found.join(groups, ["rounds", "name"])
    kept = (F.col("slice") == F.col("first.slice")) & (F.col("row") == F.col("first.row"))
    return both.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
