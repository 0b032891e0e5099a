"""Operator 11: ranked lexical search with per-term geometric blocking.

Documents become forward vectors of whole-number impacts, over the terms that the queries ask for. Segments of neighbouring
documents are indexed by themselves, so the posting list of a frequent term lies in many segments and none grows with the
table. Inside a segment each posting list is clustered by the similarity of its documents (projected vectors, drawn to the
nearest of some of the list's own documents), and the clusters are cut into blocks; a block stores the coordinatewise maximum
of its documents' vectors. The product of a query with that summary bounds the score of every document of the block, exactly:
a block is left out only if the bound is below the query's kth score, and the rest is scored on the forward vectors. Lists
are taken rarest first; once the maxima of the lists that are left sum to less than the kth score, no unseen document can
reach it. Lists are blocked when a query first asks for them.

The kth scores go from segment to segment in a task, and from a first wave (a sixteenth of the documents, chosen by a hash)
to the second. Queries are taken in batches of ``BATCH_BYTES`` of text, and what is broadcast for a batch (its terms, their
weights and the queries) is bounded by that; more queries make more batches. Each task returns k rows a query at most.

Exact: bounds only ever leave out what cannot be among the k best.

Defined cases: null and empty texts, and texts without terms, have none: they count for nothing and are never found, and
items without terms find nothing; rows are documents of their own, whatever their ids, and items too (two items of one id
have a ranking each); null ids come after all others (2^63 - 1 counts as null); terms are of any length; empty tables give
an empty table; further columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import running_total
from .common import Shared, lean, pieces_of, release, scratch_path, written

#: Bytes of terms (digits, letters, all of UTF-8 beyond ASCII) and the A-Z fold.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Bytes of items in a batch, about; documents and postings of a segment; documents of a block; bytes of a text read at once.
BATCH_BYTES, SEGMENT, POSTINGS, BLOCK, WINDOW = 8 << 20, 4096, 1 << 20, 32, 1 << 20
#: Dimensions in which documents are compared for clusters, and rows of the table of random directions.
DIRECTIONS, HASHED = 16, 1 << 14
#: One document in so many is searched in the first wave.
AHEAD = 16
NO_ID = (1 << 63) - 1


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time; a term is never cut."""
    at = 0
    while at < len(text):
        end = at + WINDOW
        if end < len(text):
            piece = text[at:end].translate(FOLD)
            cut = len(piece)
            while cut and (piece[cut - 1] > 127 or chr(piece[cut - 1]).isalnum()):
                cut -= 1
            if not cut:  # one term fills the window
                rest = re.compile(rb"[^0-9A-Za-z\x80-\xff]").search(text, end)
                end = rest.start() if rest else len(text)
                piece, cut = text[at:end].translate(FOLD), end - at
            yield TERM.findall(piece[:cut])
            at += cut
        else:
            yield TERM.findall(text[at:].translate(FOLD))
            at = len(text)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term that occurs ``tf`` times in a document of ``n`` terms adds to a score, before its weight."""
    length = 100 - 25 + (25 * n * n_docs) // max(1, n_terms)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * length)


def counted_items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, item_id, size, terms, counts): the items' own terms; ``item`` numbers the rows."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces_of(batch, "text"):
                made = [Counter() for _ in texts]
                for counts, t in zip(made, texts):
                    for some in terms_of(t):
                        counts.update(some)
                named = [[x.decode() for x in sorted(c)] for c in made]
                numbers = [[c[x] for x in sorted(c)] for c in made]
                columns = [part.column("item"), part.column("item_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(named, pa.list_(pa.string())), pa.array(numbers, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "size", "terms", "counts"])

    given = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(run, "item long, item_id long, size long, terms array<string>, counts array<long>")


def forward(docs: DataFrame, numbers: Shared, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, tfs): the number of a document's terms, and those that ``numbers`` (term to number) asks for;
    documents without terms are left out."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value.get
        for batch in batches:
            for part, texts in pieces_of(batch, "text"):
                held, sizes, terms, tfs = [], [], [], []
                for k, t in enumerate(texts):
                    counts: Counter = Counter()
                    for some in terms_of(t):
                        counts.update(map(number, some))
                    n = counts.total()
                    if n:
                        counts.pop(None, None)
                        own = sorted(counts)
                        held.append(k)
                        sizes.append(n)
                        terms.append(np.array(own, np.int32))
                        tfs.append(np.array([counts[x] for x in own], np.int64))
                ends = np.cumsum([0, *map(len, terms)]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x) if x else np.zeros(0, kind), type_)) for x, kind, type_ in ((terms, np.int32, pa.int32()), (tfs, np.int64, pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(held, pa.int64())), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    given = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Segment:
    """Some documents: their forward vectors, and the blocked posting lists that have been asked for."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, block: int = BLOCK):
        self.ids, self.starts, self.terms, self.values, self.block = ids, starts, terms, values, block
        self.sizes = np.diff(starts)
        order = np.argsort(terms, kind="stable")
        self.known, first = np.unique(terms[order], return_index=True)
        self.bounds = np.append(first, len(order))
        self.docs = np.repeat(np.arange(len(ids)), self.sizes)[order]
        self.top = np.maximum.reduceat(values[order], first) if len(order) else np.zeros(0, np.int64)
        rng = np.random.Generator(np.random.PCG64(11))
        ways = rng.standard_normal((HASHED, DIRECTIONS), dtype=np.float32)
        rare = np.log1p(len(ids) / np.diff(self.bounds)).astype(np.float32) if len(order) else np.zeros(0, np.float32)
        felt = values.astype(np.float32) * rare[np.searchsorted(self.known, terms)]
        self.place = np.zeros((len(ids), DIRECTIONS), np.float32)
        some = np.flatnonzero(self.sizes)
        if len(some):
            self.place[some] = np.add.reduceat(felt[:, None] * ways[terms % HASHED], starts[:-1][some])
        self.place /= np.maximum(np.linalg.norm(self.place, axis=1), 1e-9)[:, None]
        self.blocked: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the forward entries of documents, and where each document's begin."""
        sizes = self.sizes[docs]
        ends = np.cumsum(sizes)
        return np.repeat(self.starts[docs] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0), ends - sizes

    def blocks(self, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(documents by block, where blocks begin, summary starts, summary terms, summary maxima) of the list number ``at``."""
        if at not in self.blocked:
            docs = self.docs[self.bounds[at] : self.bounds[at + 1]]
            if len(docs) > self.block:
                heads = docs[np.linspace(0, len(docs) - 1, -(-len(docs) // self.block)).astype(np.int64)]
                nearest = np.argmax(self.place[docs] @ self.place[heads].T, axis=1)
                docs = docs[np.argsort(nearest, kind="stable")]
            begins = np.arange(0, len(docs), self.block)
            where, _ = self.entries(docs)
            own = np.repeat(np.arange(len(docs)) // self.block, self.sizes[docs])
            key = own * (1 << 32) + self.terms[where]
            order = np.argsort(key, kind="stable")
            names, first = np.unique(key[order], return_index=True)
            most = np.maximum.reduceat(self.values[where][order], first)
            starts = np.searchsorted(names >> 32, np.arange(len(begins)))
            self.blocked[at] = (docs, begins, starts, (names & 0xFFFFFFFF).astype(np.int64), most)
        return self.blocked[at]


class Best:
    """The k best (score, doc_id) of a query so far."""

    def __init__(self, k: int, floor: int = 1):
        self.k, self.floor = k, max(1, floor)
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = scores >= self.floor
        if not fits.any():
            return
        scores, ids = np.concatenate([self.scores, scores[fits]]), np.concatenate([self.ids, ids[fits]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


def search(segment: Segment, terms: np.ndarray, weights: np.ndarray, best: Best, dense: np.ndarray, seen: np.ndarray) -> tuple[int, int]:
    """Search a segment for a query of distinct ``terms``; (blocks scored, blocks left out). ``dense`` (zeros a term) and ``seen``
    (False a document) are scratch space, given back as they were."""
    at = np.searchsorted(segment.known, terms)
    there = (at < len(segment.known)) & (weights > 0)
    there[there] = segment.known[at[there]] == terms[there]
    at, own = at[there], weights[there]
    if not len(at):
        return 0, 0
    order = np.lexsort((np.diff(segment.bounds)[at], -own))  # rarest first
    at, own = at[order], own[order]
    rest = np.cumsum((own * segment.top[at])[::-1])[::-1]
    dense[terms] = weights
    touched, scored, out = [], 0, 0
    for n in range(len(at)):
        if rest[n] < best.floor:  # documents of none of the lists so far cannot reach the kth score
            break
        docs, begins, starts, names, most = segment.blocks(int(at[n]))
        bounds = np.add.reduceat(most * dense[names], starts)
        line, done, step = np.argsort(-bounds, kind="stable"), 0, 4
        while done < len(line):
            some = line[done : done + step]
            some = some[bounds[some] >= best.floor]
            if not len(some):
                break
            scored += len(some)
            own_docs = np.concatenate([docs[begins[b] : begins[b] + segment.block] for b in some.tolist()])
            own_docs = own_docs[~seen[own_docs]]
            if len(own_docs):
                seen[own_docs] = True
                touched.append(own_docs)
                where, begin = segment.entries(own_docs)
                best.take(np.add.reduceat(segment.values[where] * dense[segment.terms[where]], begin), segment.ids[own_docs])
            done, step = done + step, step * 4
        out += max(0, len(line) - done)
    dense[terms] = 0
    for docs in touched:
        seen[docs] = False
    return scored, out


def _segments(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int, most: int, block: int) -> Iterator[Segment]:
    """The documents of a task, cut into segments."""
    held, docs, size = [], 0, 0

    def made() -> Segment:
        ids, n = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("doc_id", "n"))
        terms, tfs = (np.concatenate([b.column(c).flatten().to_numpy() for b in held]).astype(np.int64) for c in ("terms", "tfs"))
        sizes = np.concatenate([b.column("terms").value_lengths().to_numpy() for b in held])
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return Segment(ids, starts, terms, impacts(tfs, np.repeat(n, sizes), n_docs, n_terms), block)

    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            part = batch.slice(a, 512)
            held.append(part)
            docs, size = docs + part.num_rows, size + len(part.column("terms").flatten())
            if docs >= most or size >= POSTINGS:
                yield made()
                held, docs, size = [], 0, 0
    if held:
        yield made()


def _searched(documents: DataFrame, asked: Shared, k: int, segment: int, block: int) -> DataFrame:
    """(item, doc_id, score): of each query the k best documents of each task at most."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = asked.value
        best = [Best(k, f) for f in v["floors"]]
        dense = np.zeros(v["size"], np.int64)
        for own in _segments(batches, v["n_docs"], v["n_terms"], segment, block):
            seen = np.zeros(len(own.ids), bool)
            for n, (a, b) in enumerate(zip(v["starts"], v["starts"][1:])):
                search(own, v["terms"][a:b], v["weights"][a:b], best[n], dense, seen)
        for item, found in zip(v["items"].tolist(), best):
            if len(found.ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found.ids), item)), pa.array(found.ids), pa.array(found.scores)], names=["item", "doc_id", "score"])

    return documents.select("doc_id", "n", "terms", "tfs").mapInArrow(run, "item long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item, by shares first."""
    order = [F.desc("score"), "doc_id"]
    share = found.withColumn("_s", F.pmod(F.xxhash64("doc_id"), F.lit(32)))
    share = share.withColumn("_r", F.row_number().over(Window.partitionBy("item", "_s").orderBy(*order))).where(F.col("_r") <= k)
    return share.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def _forward_table(spark: SparkSession, docs: DataFrame, numbers: Shared, doc_id: str, text: str) -> DataFrame:
    """The forward vectors, in two folders by whether they are searched in the first wave."""
    path = scratch_path(spark, "forward")
    made = forward(docs, numbers, doc_id, text)
    made.withColumn("ahead", (F.pmod(F.xxhash64("doc_id", "n"), F.lit(AHEAD)) == 0).cast("int")).write.partitionBy("ahead").parquet(path)
    out = spark.read.schema("doc_id long, n long, terms array<int>, tfs array<long>, ahead int").parquet(path)
    out._scratch = path
    return out


def _batch(docs: DataFrame, items: DataFrame, k: int, doc_id: str, text: str, segment: int, block: int) -> DataFrame:
    """Rank the documents for a batch of counted items of bounded size."""
    spark = docs.sparkSession
    rows = items.select("item", "terms", "counts").orderBy("item").collect()  # bounded by the batch
    names = sorted({t for r in rows for t in r["terms"]})
    number = {t: n for n, t in enumerate(names)}
    table = _forward_table(spark, docs, Shared(spark, {t.encode(): n for t, n in number.items()}), doc_id, text)
    n_docs, n_terms = table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(names), np.int64)
    for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # the batch's terms at most
        df[r["term"]] = r["count"]
    scale = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    terms = [np.array([number[t] for t in r["terms"]], np.int64) for r in rows]
    weights = [scale[t] * np.array(r["counts"], np.int64) for t, r in zip(terms, rows)]
    given = {
        "items": np.array([r["item"] for r in rows], np.int64), "starts": np.cumsum([0, *map(len, terms)]).tolist(), "terms": np.concatenate([*terms, np.zeros(0, np.int64)]),
        "weights": np.concatenate([*weights, np.zeros(0, np.int64)]), "size": len(names), "n_docs": n_docs, "n_terms": n_terms,
    }
    first = written(_ranked(_searched(table.where("ahead = 1"), Shared(spark, given | {"floors": [1] * len(rows)}), k, segment, block), k), "ranked")
    kth = {r["item"]: r["score"] for r in first.where(F.col("rank") == k).collect()}  # a row an item of the batch
    floors = [kth.get(int(i), 1) for i in given["items"]]
    second = _searched(table.where("ahead = 0"), Shared(spark, given | {"floors": floors}), k, segment, block)
    out = written(_ranked(first.drop("rank").unionByName(second), k), "ranked")
    release(table, first)
    return out


def rank(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", batch: int = BATCH_BYTES, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the k documents of the highest scores above 0, equal ones by id."""
    asked = written(counted_items(items, item_id, text), "items")
    placed = written(running_total(asked, ["item"], "size", "_upto").withColumn("batch", F.floor((F.col("_upto") - F.col("size")) / float(batch)).cast("int")), "items")
    out = None
    for number in sorted(r["batch"] for r in placed.select("batch").distinct().collect()):  # as many as batches of items
        own = placed.where(F.col("batch") == number)
        found = _batch(docs, own, k, doc_id, text, segment, block).join(own.select("item", "item_id"), "item")
        out = found if out is None else out.unionByName(found)
    release(asked)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")
