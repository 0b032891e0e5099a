"""Operator 9: mixing sources to target weights over packed blocks.

The words of each source are packed, in a fixed pseudorandom order of its documents, into blocks of ``block_words``. Every
output shard draws its number of blocks from each source by a multinomial; a source's draws are then scaled along the shards
so that they add up to its quota. The k-th block that a source gives is the k-th of a pseudorandom permutation of its block
indexes (a Feistel network with cycle walking, another one each time round), and a join by (source, index) fetches it.

At scale: the order of a source's words comes from sums over hash buckets, so a source with a third of all rows is dealt
to as many tasks as others. Shards, draws and slots are tables; a task draws for its own shards. With more than GROUP
sources a shard draws groups of sources first and sources within its groups then, so only one number for GROUP sources
passes through the driver; the sources themselves are numbered and levelled in one window of one row a source.

Every draw depends on the data and the seed alone: documents are ordered by a hash of id and text, not by where they stand
in the input, so reruns agree however the input is split. Rows with equal id, source and text are interchangeable.

Defined cases: null text has no words and is never taken; a null source is a source of its own, the last; documents without
words get taken 0; repeated rows are documents of their own; an empty table gives an empty table; further columns stay out
of the report and pass through ``mixed_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, mix64, pieces_of, words_of, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 128
SHARD_BLOCKS = 4096
#: Sources whose shares a task draws from at once.
GROUP = 4096
#: Slots of a task, about.
TASK_SLOTS = 500_000
SEED = 17


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the text replaced by ``size``, its number of runs of non-white characters."""
    rest = [c for c in docs.columns if c != text]
    schema = T.StructType([*docs.select(*rest).schema.fields, T.StructField("size", T.LongType())])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces_of(batch, text):
                data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
                bounds = np.cumsum([len(t) + 1 for t in texts])
                sizes = np.diff(np.searchsorted(words_of(data)[0], bounds), prepend=0)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(sizes, pa.int64())], names=schema.fieldNames())

    return docs.select(*rest, text).mapInArrow(run, schema)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, s, source_size, target), one row a source: s numbers them by code point, null last.

    The target is weight * level, or ``most`` times the source's size where that is less; the level is such that targets
    add up to ``share`` of all words. That is what resharing every excess by weight ends in.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = per.withColumn("s", (F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1).cast("bigint"))
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod("s", F.lit(len(weights))) + 1).cast("int"))
    numbered = numbered.withColumn("weight", weight).withColumn("most", most * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "s")
    every, before = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), order.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy((F.col("most") / F.col("weight")).desc(), F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)  # from the other end, so linear
    level = (share * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = numbered.withColumn("level", level).withColumn("open", F.col("most") > F.col("weight") * F.col("level"))
    chosen = leveled.withColumn("chosen", F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.col("most") / F.col("weight"))).over(every))
    return chosen.select("source", "s", "source_size", F.coalesce(F.least("most", F.col("weight") * F.col("chosen")), F.col("most")).cast("double").alias("target"))


def _order(doc_id: Column, text: Column) -> Column:
    """What documents are ordered by: hashes of id and text."""
    named = (F.coalesce(doc_id.cast("string"), F.lit("")), text)
    return F.struct(F.xxhash64(*named).alias("a"), F.hash(*named).alias("b"))


def offsets(sizes: DataFrame) -> DataFrame:
    """Add ``start``: the number of words that come before a document in its source ``s``; needs rid, s, size and order."""
    buckets = max(64, sizes.count() // 20_000)
    dealt = sizes.withColumn("bucket", F.pmod(F.col("order.a"), F.lit(buckets)))
    inside = Window.partitionBy("s", "bucket").orderBy("order", "rid").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("s", "bucket").agg(F.sum("size").alias("words")).select("s", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    return dealt.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(totals, ["s", "bucket"]).withColumn("start", F.col("start") + F.col("base")).drop("bucket", "base", "order")


def quotas(per: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(s, blocks, quota): the blocks that each source has and gives, from ``targets``."""
    blocks = F.ceil(F.col("source_size") / block_words)
    wanted = F.rint(F.try_divide(F.col("target") * blocks, F.col("source_size"))).cast("bigint")
    return per.select("s", blocks.cast("bigint").alias("blocks"), F.coalesce(F.least(wanted, MOST * blocks), F.lit(0)).cast("bigint").alias("quota"))


def draws(given: DataFrame, seed: int = SEED, shard_blocks: int = SHARD_BLOCKS, group: int = GROUP) -> DataFrame:
    """(shard, s, first, n, blocks) from ``quotas``: multinomial draws of each shard, scaled so that the draws of a source
    add up to its quota; ``first`` counts what the source gave to the shards before."""
    spark = given.sparkSession
    open_ = given.where("quota > 0").withColumn("g", F.expr(f"s div {group}"))
    groups = open_.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("s", "quota"))).alias("of"), F.sum("quota").alias("all"))  # ``group`` at most
    shares = groups.select("g", "all").orderBy("g").collect()  # one row for ``group`` sources
    total = sum(r["all"] for r in shares)
    shards = max(1, -(-total // shard_blocks))
    names, weights = [r["g"] for r in shares], np.array([r["all"] for r in shares], dtype=np.float64)

    @lean
    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in batch.column("shard").to_pylist() if total else []:
                n = total // shards + (k < total % shards)
                drawn = np.random.Generator(np.random.PCG64([seed, k])).multinomial(n, weights / weights.sum())
                rows += [(k, names[g], int(drawn[g])) for g in np.flatnonzero(drawn)]
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["shard", "g", "m"])

    @lean
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, g, m, of in zip(*(batch.column(c) for c in ("shard", "g", "m", "of"))):
                s, share = (of.values.field(c).to_numpy() for c in ("s", "quota"))
                drawn = np.random.Generator(np.random.PCG64([seed, k.as_py(), g.as_py() + 1])).multinomial(m.as_py(), share / share.sum())
                at = np.flatnonzero(drawn)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k.as_py()), pa.int64()), pa.array(s[at], pa.int64()), pa.array(drawn[at], pa.int64())], names=["shard", "s", "n"])

    # Written in between, so that no task runs two Python functions at once: Spark keeps the workers of both until it ends.
    drawn = written(spark.range(shards).withColumnRenamed("id", "shard").mapInArrow(outer, "shard long, g long, m long"), "groups")
    drawn = written(drawn.join(groups.select("g", "of"), "g").mapInArrow(inner, "shard long, s long, n long"), "drawn")
    got = open_.join(drawn.groupBy("s").agg(F.sum("n").alias("got")), "s", "left").select("s", "blocks", "quota", "got")
    order = Window.partitionBy("s").orderBy("shard")
    run = drawn.withColumn("run", F.sum("n").over(order)).join(got, "s")
    until = run.withColumn("until", F.expr("cast((cast(run as decimal(19, 0)) * cast(quota as decimal(19, 0))) div got as bigint)"))
    even = until.withColumn("first", F.coalesce(F.lag("until").over(order), F.lit(0))).withColumn("n", F.col("until") - F.col("first"))
    lone = got.where("got is null").select(F.pmod(F.xxhash64("s"), F.lit(shards)).alias("shard"), "s", F.lit(0).cast("long").alias("first"), F.col("quota").alias("n"), "blocks")
    return even.where("n > 0").select("shard", "s", "first", "n", "blocks").unionByName(lone)


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Images of ``index`` under pseudorandom permutations of 0..n-1, one for each ``key``."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(np.float64))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)

    def once(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        left, right = x >> half[rows], x & mask[rows]
        for turn in range(4):
            left, right = right, left ^ (mix64(right ^ mix64(key[rows] + np.uint64(turn))) & mask[rows])
        return (left << half[rows]) | right

    rows = np.arange(len(index))
    out = once(index.astype(np.uint64), rows)
    while len(rows := np.flatnonzero(out >= n.astype(np.uint64))):
        out[rows] = once(out[rows], rows)
    return out.astype(np.int64)


def slots(given: DataFrame, parts: int, seed: int = SEED) -> DataFrame:
    """(shard, slot, s, turn, block): what each output shard takes of each source, in order, from ``draws``."""
    schema = "shard long, slot int, s long, turn long, block long"

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for a in range(0, row["n"], 1 << 16):
                    j = row["first"] + np.arange(a, min(row["n"], a + (1 << 16)))
                    turn, n = j // row["blocks"], np.full(len(j), row["blocks"])
                    with np.errstate(over="ignore"):
                        key = mix64(mix64(np.full(len(j), seed + 1000003 * row["s"], dtype=np.uint64)) + turn.astype(np.uint64))
                    block = permuted(j % row["blocks"], n, key)
                    same = lambda x: pa.array(np.full(len(j), x), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [same(row["shard"]), pa.array(np.arange(a, a + len(j)), pa.int32()), same(row["s"]), pa.array(turn, pa.int64()), pa.array(block, pa.int64())],
                        names=["shard", "slot", "s", "turn", "block"],
                    )

    return given.repartition(parts, "shard", "s").mapInArrow(run, schema)


def _plan(sizes: DataFrame, block_words: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with s, source_size, target; pieces (rid, s, block, a, b): words a..b of a document that lie in a block;
    slots) from the written table ``sizes`` (rid, source, size, order)."""
    spark = sizes.sparkSession
    per = written(targets(sizes), "targets")
    known = sizes.withColumn("_none", F.col("source").isNull()).withColumn("_key", F.coalesce("source", F.lit("")))
    keyed = per.select(F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_key"), "s", "source_size", "target")
    docs = known.join(keyed, ["_none", "_key"]).drop("_none", "_key")
    words = written(offsets(docs.where("size > 0").select("rid", "s", "size", "order")), "offsets")
    blocks = F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")
    cut = words.select("rid", "s", "start", "size", F.explode(blocks).alias("block"))
    a = F.greatest(F.lit(0), F.col("block") * block_words - F.col("start"))
    b = F.least(F.col("size"), (F.col("block") + 1) * block_words - F.col("start"))
    pieces = cut.select("rid", "s", "block", a.alias("a"), b.alias("b"))
    given = written(quotas(per, block_words), "quotas")
    drawn = written(draws(given, seed), "draws")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (given.agg(F.sum("quota")).first()[0] or 0) // TASK_SLOTS)
    # Written, so that joins see how large the slots are: their number grows with the words.
    return docs, pieces, written(slots(drawn, parts, seed), "slots")


def mix_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken."""
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"), _order(F.col(doc_id), F.col(text)).alias("order"))
    sizes = written(word_counts(given).withColumn("rid", F.monotonically_increasing_id()), "sizes")
    known, pieces, chosen = _plan(sizes, block_words, seed)
    uses = chosen.groupBy("s", "block").agg(F.count("*").alias("uses"))
    taken = pieces.join(uses, ["s", "block"]).groupBy("rid").agg(F.sum((F.col("b") - F.col("a")) * F.col("uses")).alias("taken"))
    return known.join(taken, "rid", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixed_blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix itself: (shard, slot, s, block, spans), spans being (doc_id, first word, end word) in order."""
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"), _order(F.col(doc_id), F.col(text)).alias("order"))
    sizes = written(word_counts(given).withColumn("rid", F.monotonically_increasing_id()), "sizes")
    known, pieces, chosen = _plan(sizes, block_words, seed)
    spans = F.array_sort(F.collect_list(F.struct("rid", "doc_id", "a", "b")))
    content = pieces.join(known.select("rid", "doc_id"), "rid").groupBy("s", "block").agg(F.transform(spans, lambda x: F.struct(x["doc_id"].alias("doc_id"), x["a"].alias("first"), x["b"].alias("end"))).alias("spans"))
    return chosen.join(content, ["s", "block"]).select("shard", "slot", "s", "block", "spans")


def _taken_text(df: DataFrame) -> DataFrame:
    """``df`` (with text and spans) with the text replaced by its words of the spans, as they stand in it."""
    schema = T.StructType([f for f in df.schema.fields if f.name != "_spans"])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces_of(batch, "text"):
                out = []
                for text, spans in zip(texts, part.column("_spans").to_pylist()):
                    starts, ends = words_of(np.frombuffer(text, dtype=np.uint8))
                    runs: list[list[int]] = []
                    for a, b in sorted((x["a"], x["b"]) for x in spans):
                        if runs and runs[-1][1] == a:
                            runs[-1][1] = b
                        else:
                            runs.append([a, b])
                    whole = runs == [[0, len(starts)]]
                    out.append(text if whole else b"\n".join(text[starts[a] : ends[b - 1]] for a, b in runs))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string()) if f.name == "text" else part.column(f.name) for f in schema.fields], names=schema.fieldNames())

    return df.mapInArrow(run, schema)


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The documents as the mix takes them, with their columns: one row for each time round that takes words of a document,
    its text being those words (the whole text where all are taken) and n_chars their number of characters."""
    own = written(docs.withColumn("_rid", F.monotonically_increasing_id()), "mixed")
    named = F.col("doc_id") if "doc_id" in docs.columns else F.lit("")
    sizes = written(word_counts(own.select(F.col("_rid").alias("rid"), "source", "text", _order(named, F.col("text")).alias("order"))), "sizes")
    _, pieces, chosen = _plan(sizes, block_words, seed)
    taken = pieces.join(chosen.select("s", "block", "turn"), ["s", "block"]).groupBy("rid", "turn").agg(F.collect_list(F.struct("a", "b")).alias("_spans"))
    joined = own.join(taken.select(F.col("rid").alias("_rid"), "_spans"), "_rid").drop("_rid")
    mixed = _taken_text(joined)
    return (mixed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else mixed).select(*docs.columns)
