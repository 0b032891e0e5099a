"""Operator 10: byte-level BPE encoding and decoding on length-bucketed numpy matrices.

The distinct pieces of a slice of texts are put into padded matrices of ids, one matrix for each width. In every round
each row merges its leftmost pair of the lowest rank; the rank of a pair comes from a hash table of id pairs, rows shrink
by compaction, and rows without a mergeable pair leave the matrix. A document's ids are its pieces' ids in order.

Defined cases: a null or empty text has no ids and decodes to nothing; any text round-trips, as all 256 bytes have an id;
special tokens do not exist; repeated rows are encoded each; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Shared, lean, pieces_of, renamed

NO_RANK = np.int32(2**31 - 1)
#: Rows wider than this keep their pairs in a heap: the same merges, without moving the whole row each round.
WIDEST = 2048
#: Pieces that a worker remembers between slices.
CACHE_PIECES = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairTable:
    """Open-addressing hash table from pairs of ids to the id of their concatenation."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs: dict[int, int] = {}
        self.width = max(ranks.values()) + 1
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = rank
        self.pairs = pairs
        bits = max(4, (4 * max(1, len(pairs)) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, dtype=np.int32)
        keys, values = np.fromiter(pairs.keys(), np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        self.probes, slot = 1, self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            put = first[free[first]]
            self.keys[slot[put]], self.ranks[slot[put]] = keys[put], values[put]
            rest = np.ones(len(keys), dtype=bool)
            rest[put] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & self.mask
            self.probes += bool(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NO_RANK for pairs that do not merge and for padding (-1)."""
        keys = left.astype(np.int64) * self.width + right
        keys[(left < 0) | (right < 0)] = -2
        slot = self._slot(keys)
        out = np.full(keys.shape, NO_RANK, dtype=np.int32)
        open_ = np.ones(keys.shape, dtype=bool)
        for _ in range(self.probes):
            at = self.keys[slot]
            hit = open_ & (at == keys)
            out[hit] = self.ranks[slot[hit]]
            open_ &= ~hit & (at != -1)
            if not open_.any():
                break
            slot = (slot + 1) & self.mask
        return out


class Vocabulary:
    """Ranks made ready for encoding and decoding."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.table = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.tokens: list[bytes] = [b""] * self.table.width
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def merge_matrix(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merge every row of a padded matrix to its end; yields (row numbers, their final ids, padded with -1)."""
        rows = np.arange(len(ids))
        ranks = self.table.look_up(ids[:, :-1], ids[:, 1:]) if ids.shape[1] > 1 else np.full((len(ids), 0), NO_RANK)
        while len(rows):
            if ranks.shape[1] == 0:
                yield rows, ids
                return
            at = ranks.argmin(axis=1)  # the first of the lowest: leftmost
            best = ranks[np.arange(len(rows)), at]
            done = best == NO_RANK
            if done.any():
                yield rows[done], ids[done]
                rows, ids, ranks, at, best = rows[~done], ids[~done], ranks[~done], at[~done], best[~done]
                if not len(rows):
                    return
            here = np.arange(len(rows))
            column = np.arange(ids.shape[1] - 1)
            after = column[None, :] > at[:, None]
            ids = np.where(after, ids[:, 1:], ids[:, :-1])
            ids[here, at] = best
            if ids.shape[1] == 1:
                ranks = ranks[:, :0]
                continue
            ranks = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
            right, left = np.minimum(at, ids.shape[1] - 2), np.maximum(at - 1, 0)
            ranks[here, right] = self.table.look_up(ids[here, right], ids[here, right + 1])
            ranks[here, left] = self.table.look_up(ids[here, left], ids[here, left + 1])

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges for one very long piece: a heap of (rank, position) over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n, pairs, width = len(ids), self.table.pairs, self.table.width
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pairs.get(ids[i] * width + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and (b := after[a]) < n and (r := pairs.get(ids[a] * width + ids[b])) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[k] = np.array([whole], dtype=np.int32)
            elif len(piece) > WIDEST:
                out[k] = np.array(self.merge_long(piece), dtype=np.int32)
            else:
                n = len(piece)
                buckets.setdefault(n if n <= 16 else 1 << (n - 1).bit_length(), []).append(k)
        for width, members in buckets.items():
            step = max(1, (1 << 20) // width)
            for a in range(0, len(members), step):
                part = members[a : a + step]
                ids = np.full((len(part), width), -1, dtype=np.int32)
                sizes = np.array([len(pieces[k]) for k in part])
                flat = self.byte_ids[np.frombuffer(b"".join([pieces[k] for k in part]), np.uint8)]
                ids[np.arange(width)[None, :] < sizes[:, None]] = flat
                for rows, final in self.merge_matrix(ids):
                    lengths = (final >= 0).sum(axis=1)
                    for r, row, n in zip(rows.tolist(), final, lengths.tolist()):
                        out[part[r]] = row[:n].copy()
        return out  # type: ignore[return-value]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Codes(dict):
    """Numbers new keys as they come."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class Encoder:
    """Encodes texts; the ids of pieces seen before are kept, up to CACHE_PIECES of them."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.find = vocabulary, regex.compile(pattern).findall
        self._reset()

    def _reset(self) -> None:
        self.codes, self.flat = _Codes(), np.zeros(0, np.int32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.codes) > CACHE_PIECES:
            self._reset()
        known, per_text = len(self.codes), []
        for text in texts:
            found = self.find(text)
            per_text.append(np.fromiter(map(self.codes.__getitem__, found), np.int32, len(found)))
        new = [p.encode() for p in list(self.codes)[known:]]
        ids = self.vocabulary.encode_pieces(new)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, *ids])
        for codes in per_text:
            n = self.sizes[codes]
            ends = np.cumsum(n)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[codes] - ends + n, n)
            yield self.flat[at]


_READY: dict[str, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """One per worker process and broadcast."""
    if shared.id not in _READY:
        _READY.clear()
        _READY[shared.id] = Vocabulary(shared.value)
    return _READY[shared.id]


def _mapped(
    df: DataFrame, text: str, ranks_path: str, pattern: str, columns: list[tuple[str, T.DataType, pa.DataType]],
    make: Callable[[Vocabulary, np.ndarray], tuple], slice_bytes: int,
) -> DataFrame:
    source = renamed(df, {name for name, _, _ in columns} - {text})
    shared = Shared(df.sparkSession, load_ranks(ranks_path))
    schema = T.StructType([*source.schema.fields, *(T.StructField(name, kind) for name, kind, _ in columns)])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        encoder = Encoder(vocabulary, pattern)
        for batch in batches:
            for part, texts in pieces_of(batch, text, slice_bytes):
                made = [make(vocabulary, ids) for ids in encoder.encode([t.decode("utf-8", "replace") for t in texts])]
                new = [pa.array([m[k] for m in made], kind) for k, (_, _, kind) in enumerate(columns)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.fieldNames())

    return source.mapInArrow(run, schema)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", into: str = "ids", slice_bytes: int = 3 << 20) -> DataFrame:
    """Add the ids of each whole text as ``into`` array<int>."""
    columns = [(into, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))]
    return _mapped(df, text, ranks_path, pattern, columns, lambda _, ids: (ids,), slice_bytes)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the bytes that ``ids`` stand for as ``into`` binary; a null array gives null."""
    source = renamed(df, {into})
    shared = Shared(df.sparkSession, load_ranks(ranks_path))
    schema = T.StructType([*source.schema.fields, T.StructField(into, T.BinaryType())])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _vocabulary(shared)
        for batch in batches:
            made = [None if x is None else tokens.decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=schema.fieldNames())

    return source.mapInArrow(run, schema)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", slice_bytes: int = 3 << 20) -> DataFrame:
    """Encode each whole text, decode its ids, and add n_tokens, ids_sha256 and decoded_sha256.

    The ids go from encoder to decoder inside the task, so they are never shuffled or written.
    """

    def make(vocabulary: Vocabulary, ids: np.ndarray) -> tuple[int, str, str]:
        listed = ids.tolist()
        spelled = ",".join(map(str, listed)).encode()
        return len(listed), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(vocabulary.decode(listed)).hexdigest()

    columns = [("n_tokens", T.LongType(), pa.int64()), ("ids_sha256", T.StringType(), pa.string()), ("decoded_sha256", T.StringType(), pa.string())]
    return _mapped(df, text, ranks_path, pattern, columns, make, slice_bytes)
