"""Operator 13: repair of the structure of conversations by depth-first branch and bound.

The rows of a conversation, in the order of their turns, are kept, given another role, deleted, or preceded by inserted rows,
so that the initials of the roles read ``(s?(ua)+)?`` at the least cost; of equal costs the audit (the edits' initials in
order) that comes first in ASCII wins. A search node is (row, state); the state says what the rows so far end with: nothing,
a system row, a user's or an assistant's. The search goes down a stack, cheapest child first. A prefix is given up if its
cost and the lower bound of what is left exceed the incumbent (cost, audit), if they are equal and its audit comes after the
incumbent's, or if the node's table of dominance holds a better prefix. What is on the stack when it runs empty has been
proved. The lower bound of a suffix sums what each row costs at least and half of what its adjacent equal roles cost, since
an edit mends two such places at most.

Conversations are laid in order by range partitions and cut into segments of at most ``rows`` rows and ``limit`` bytes, so
no task or row holds a long one. A conversation of one segment is settled at once. For the others the search gives, for each
state before a segment and each after it, the best (cost, audit); these small tables are chained in order, and the chosen
edits go back to the segments. Only a hash of a whole conversation has to read its segments one after the other, which
SHA-256 asks for; it streams them.

Defined cases: null ids and turns are null to the order (turns first) and one space to the fault draw; null roles and texts
are one space. A null id is a conversation of its own. Rows of one turn go by role, then text. An empty role has no initial,
so its row is never kept. Repeated rows are repeats. An empty table gives an empty table; further columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, release, written

#: The costs of the edits.
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
CUT_OFF = 3
#: Rows and bytes of a segment at most (one row at least).
SEGMENT_ROWS, SEGMENT_BYTES = 32, 4 << 20
#: Patterns of segments whose solutions a worker keeps.
PATTERNS = 1 << 14

#: States: what the rows so far end with.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a row of an initial; an absent entry is not allowed.
STEP = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The state after an inserted row, or one with a new role.
FREE = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
DONE = (NOTHING, ASSISTANT)


def symbol(initial: str, fault: str) -> str:
    """One letter for what matters of a row: 'x' if it must go, else its initial ('o' for others), a capital if cut off."""
    if fault in ("blank", "duplicate"):
        return "x"
    letter = initial if initial in STEP else "o"
    return letter.upper() if fault == "truncated" else letter


def suffix_bounds(pattern: str) -> list[int]:
    """A lower bound of the cost of the rows from each place on."""
    out, least, twice, after = [0] * (len(pattern) + 1), 0, 0, ""
    for k in range(len(pattern) - 1, -1, -1):
        row = pattern[k]
        low, cut = row.lower(), row.isupper()
        if row == "x":
            least += COST["D"]
        elif low == "o":
            least += min(COST["R"] + CUT_OFF * cut, COST["D"])
            after = ""
        else:
            least += CUT_OFF * cut
            if after.lower() == low:  # an edit of a cut-off row may be its deletion, for one more than it costs anyway
                twice += min(COST["R"], COST["D"] - CUT_OFF * (cut or after.isupper()))
            after = row
        out[k] = least + -(-twice // 2)
    return out


@functools.lru_cache(maxsize=PATTERNS)
def best_edits(pattern: str, entry: int = NOTHING, end: int | None = None) -> tuple[int, str] | None:
    """The least (cost, audit) from the state ``entry`` over all rows to the state ``end``, or to a whole conversation with
    the rows inserted after the last if ``end`` is None; None if there is none."""
    bound, n = suffix_bounds(pattern), len(pattern)
    best: tuple[int, str] | None = None
    tables: list[dict[int, tuple[int, str]]] = [{} for _ in range(n + 1)]  # the best prefix of each node
    stack = [(0, entry, 0, "")]
    while stack:
        k, state, cost, audit = stack.pop()
        if best is not None:
            low = cost + bound[k]
            if low > best[0] or (low == best[0] and audit > best[1][: len(audit)]):
                continue
        held = tables[k].get(state)
        if held is not None and held <= (cost, audit):
            continue
        tables[k][state] = (cost, audit)
        if k == n and (state in DONE if end is None else state == end):
            if best is None or (cost, audit) < best:
                best = (cost, audit)
            continue
        found = []
        if k < n or end is None:
            found.append((k, FREE[state], cost + COST["I"], audit + "I"))
        if k < n:
            row = pattern[k]
            found.append((k + 1, state, cost + COST["D"], audit + "D"))
            if row != "x":
                cut = CUT_OFF * row.isupper()
                after = STEP.get(row.lower(), {}).get(state)
                if after is not None:
                    found.append((k + 1, after, cost + COST["K"] + cut, audit + "K"))
                found.append((k + 1, FREE[state], cost + COST["R"] + cut, audit + "R"))
        found.sort(key=lambda c: (c[2] + bound[c[0]], c[3]), reverse=True)  # the most promising is taken from the top
        stack.extend(found)
    return best


def repaired(roles: list[str], texts: list[str], audit: str, state: int = NOTHING) -> tuple[list[str], int]:
    """The ``role:text`` of the repaired rows under an audit, and the state they end in."""
    out, k = [], 0
    for edit in audit:
        if edit == "K":
            state = STEP[roles[k][:1]][state]
            out.append(f"{roles[k]}:{texts[k]}")
        elif edit in "IR":
            state = FREE[state]
            out.append(("user:" if state == USER else "assistant:") + (texts[k] if edit == "R" else ""))
        k += edit != "I"
    return out, state


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of ``conv_id:turn`` draws for each row."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    out = rows.withColumn("_d", draw).where("_d != 0")
    out = out.select("conv_id", "turn", F.when(F.col("_d") == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.expr("if(_d = 3, 2, 1)").alias("_n"))
    return out.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "_n")).alias("_copy"))


def _solid(text: Column) -> Column:
    """``text`` without the white space at its end."""
    return F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))


def faulty(rows: DataFrame) -> DataFrame:
    """Add ``fault``: blank, duplicate (role and text were there before), truncated, or none; rows have a key ``_row``."""
    place = F.struct(F.col("turn").isNotNull().alias("told"), "turn", "_row")
    first = rows.groupBy("conv_id", "role", "text").agg(F.min(place).alias("_first"), F.count("*").alias("_many")).where("_many > 1")
    first = first.select("conv_id", "role", "text", F.col("_first._row").alias("_first"))
    same = F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("l.role") == F.col("r.role")) & (F.col("l.text") == F.col("r.text"))
    both = rows.alias("l").join(first.alias("r"), same, "left").select("l.*", "_first")
    solid = _solid(F.col("text"))
    fault = F.when(solid == "", "blank").when(F.col("_first") != F.col("_row"), "duplicate").when(~F.substring(solid, -1, 1).isin(".", "!", "?"), "truncated").otherwise("none")
    return both.withColumn("fault", fault).drop("_first")


SEGMENT = (
    "conv_id {id}, part int, seq long, n long, roles array<string>, texts array<string>, pattern string, first_turn long, last_turn long, turns long,"
    " blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string"
)


def segments(rows: DataFrame, most: int = SEGMENT_ROWS, limit: int = SEGMENT_BYTES) -> DataFrame:
    """Rows (conv_id, turn, role, text, fault) in order, packed by conversation into segments of bounded size."""
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "_row"]
    placed = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "fault", "_row").repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = SEGMENT.format(id=kind)

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size, made, conv_type = 0, [], None

        def pack() -> dict:
            turns = [r[1] for r in held if r[1] is not None]
            letters = [r[2][:1] for r in held]
            faults = [r[4] for r in held]
            return {
                "conv_id": held[0][0], "part": part, "seq": seq, "n": len(held), "roles": [r[2] for r in held], "texts": [r[3] for r in held],
                "pattern": "".join(map(symbol, letters, faults)), "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(set(turns)),
                **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")}, "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:])),
                "first_initial": letters[0], "last_initial": letters[-1],
            }

        def flushed(schema: pa.Schema) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(made, schema=schema)

        out_schema, waiting = None, 0
        for batch in batches:
            if out_schema is None:
                conv_type = batch.schema.field("conv_id").type
                whole, text = pa.int64(), pa.string()
                kinds = {"conv_id": conv_type, "part": pa.int32(), "roles": pa.list_(text), "texts": pa.list_(text), "pattern": text, "first_initial": text, "last_initial": text}
                names = [c.split()[0] for c in SEGMENT.split(", ")]
                out_schema = pa.schema([(c, kinds.get(c, whole)) for c in names])
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault"))):
                if held and (row[0] != held[0][0] or len(held) == most or size + len(row[3]) > limit):
                    made.append(pack())
                    seq, waiting, held, size = seq + 1, waiting + size, [], 0
                    if len(made) >= 2048 or waiting > limit:
                        yield flushed(out_schema)
                        made.clear()
                        waiting = 0
                held.append(row)
                size += len(row[3])
        if held:
            made.append(pack())
            yield flushed(out_schema)

    return placed.mapInArrow(cut, schema)


def _settled(single: DataFrame) -> DataFrame:
    """(part, seq, cost, audit, repaired_sha256) of conversations of one segment."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cost, audit, digest = [], [], []
            for roles, texts, pattern in zip(*(batch.column(c).to_pylist() for c in ("roles", "texts", "pattern"))):
                c, a = best_edits(pattern)
                cost.append(c)
                audit.append(a)
                digest.append(hashlib.sha256("\n".join(repaired(roles, texts, a)[0]).encode()).hexdigest())
            keys = [batch.column(c) for c in ("part", "seq")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(cost, pa.int64()), pa.array(audit, pa.string()), pa.array(digest, pa.string())], names=["part", "seq", "cost", "audit", "repaired_sha256"])

    return single.select("part", "seq", "roles", "texts", "pattern").mapInArrow(run, "part int, seq long, cost long, audit string, repaired_sha256 string")


def _tables(parts: DataFrame) -> DataFrame:
    """(conv_id, part, seq, options): for each segment the best (entry, end, cost, audit) of every pair of states."""
    options = "array<struct<entry: int, end: int, cost: bigint, audit: string>>"

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("entry", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
        for batch in batches:
            found = []
            for pattern in batch.column("pattern").to_pylist():
                every = ((e, x, best_edits(pattern, e, x)) for e in range(4) for x in range(4))
                found.append([{"entry": e, "end": x, "cost": b[0], "audit": b[1]} for e, x, b in every if b is not None])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "part", "seq")), pa.array(found, kind)], names=["conv_id", "part", "seq", "options"])

    kind = parts.schema["conv_id"].dataType.simpleString()
    return parts.select("conv_id", "part", "seq", "pattern").mapInArrow(run, f"conv_id {kind}, part int, seq long, options {options}")


def chained(options: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """The least (cost, audit) through the tables (entry, end, cost, audit) of a conversation's segments: the cost, and of
    each segment (entry, audit); the last one's has the rows inserted at the end."""
    now: dict[int, tuple[int, str]] = {NOTHING: (0, "")}
    back: list[dict[int, tuple[int, str]]] = []
    for table in options:
        after: dict[int, tuple[int, str]] = {}
        came: dict[int, tuple[int, str]] = {}
        for entry, end, cost, audit in table:
            if entry in now:
                made = (now[entry][0] + cost, now[entry][1] + audit)
                if end not in after or made < after[end]:
                    after[end], came[end] = made, (entry, audit)
        now = after
        back.append(came)
    tails = {NOTHING: "", ASSISTANT: "", SYSTEM: "II", USER: "I"}
    total, audit, state = min((c + COST["I"] * len(tails[s]), a + tails[s], s) for s, (c, a) in now.items())
    chosen, tail = [], tails[state]
    for came in reversed(back):
        entry, own = came[state]
        chosen.append((entry, own + tail))
        state, tail = entry, ""
    return total, chosen[::-1]


def _chained(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``_settled`` gives, for conversations of several segments, and the scratch table of edits that it reads."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    line = ["conv_id", "part", "seq"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tables, places = None, [], []

        def told() -> pa.RecordBatch:
            cost, chosen = chained(tables)
            rows = [{"part": p, "seq": s, "entry": e, "audit": a, "cost": cost if k == 0 else 0} for k, ((p, s), (e, a)) in enumerate(zip(places, chosen))]
            return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("entry", pa.int32()), ("audit", pa.string()), ("cost", pa.int64())]))

        for batch in batches:
            for conv, part, seq, options in zip(*(batch.column(c).to_pylist() for c in (*line, "options"))):
                if places and conv != key:
                    yield told()
                    tables, places = [], []
                key = conv
                tables.append([(o["entry"], o["end"], o["cost"], o["audit"]) for o in options])
                places.append((part, seq))
        if places:
            yield told()

    tables = _tables(parts).repartition("conv_id").sortWithinPartitions(*line)
    edits = written(tables.mapInArrow(run, "part int, seq long, entry int, audit string, cost long"), "edits")

    @lean
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, place, digest, empty, cost, audit = None, None, None, True, 0, []

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"part": place[0], "seq": place[1], "cost": cost, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], schema=pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]))

        for batch in batches:
            for conv, part, seq, roles, texts, entry, edits_, own in zip(*(batch.column(c).to_pylist() for c in (*line, "roles", "texts", "entry", "audit", "cost"))):
                if place is None or conv != key:
                    if place is not None:
                        yield told()
                    key, place, digest, empty, cost, audit = conv, (part, seq), hashlib.sha256(), True, 0, []
                lines, _ = repaired(roles, texts, edits_, entry)
                if lines:
                    digest.update((("" if empty else "\n") + "\n".join(lines)).encode())
                    empty = False
                cost += own
                audit.append(edits_)
        if place is not None:
            yield told()

    both = parts.select(*line, "roles", "texts").join(edits, ["part", "seq"]).select(*line, "roles", "texts", "entry", "audit", "cost")
    return both.repartition("conv_id").sortWithinPartitions(*line).mapInArrow(hashed, "part int, seq long, cost long, audit string, repaired_sha256 string"), edits


def repair(rows: DataFrame, most: int = SEGMENT_ROWS, limit: int = SEGMENT_BYTES) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text) that has any: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256."""
    keyed = written(rows.select("conv_id", "turn", "role", "text").withColumn("_row", F.monotonically_increasing_id()), "turns")
    packed = written(segments(faulty(keyed), most, limit), "segments")
    release(keyed)
    line = Window.partitionBy("conv_id").orderBy("part", "seq")  # segments of a conversation, without their texts
    light = packed.drop("roles", "texts", "pattern")
    lone = F.col("_segments") == 1
    known = F.last("last_turn", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    pair = F.concat(F.lag("last_initial").over(line), "first_initial")
    light = light.withColumns({"_again": (known == F.col("first_turn")).cast("long"), "_bad": (~pair.isin("su", "ua", "au")).cast("long")})
    told = light.groupBy("conv_id").agg(
        F.count("*").alias("_segments"), F.min(F.struct("part", "seq")).alias("_place"),
        F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - F.sum("turns") + F.coalesce(F.sum("_again"), F.lit(0)), F.lit(0)).alias("gaps"),
        *(F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")), (F.sum("illegal") + F.coalesce(F.sum("_bad"), F.lit(0))).alias("illegal"),
    )
    told = written(told.select("conv_id", F.col("_place.part").alias("part"), F.col("_place.seq").alias("seq"), "_segments", "gaps", "blank", "duplicate", "truncated", "illegal"), "told")
    single = packed.join(told.where(lone).select("part", "seq"), ["part", "seq"], "left_semi")
    long_ones = told.where(~lone).select(F.col("conv_id").alias("_id"))
    several = packed.join(long_ones, F.col("conv_id").eqNullSafe(F.col("_id")), "left_semi")
    done, edits = _chained(several)
    out = written(told.join(_settled(single).unionByName(done), ["part", "seq"]).drop("part", "seq", "_segments"), "repaired")
    release(packed, told, edits)
    return out


def report(conversations: DataFrame) -> DataFrame:
    """Every conversation of ``conversations``, damaged and repaired; zeros and the empty text's hash for those that lose all
    their rows."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    made = repair(damaged(rows))
    every = rows.select("conv_id").distinct().alias("e")
    both = every.join(made.alias("m"), F.col("e.conv_id").eqNullSafe(F.col("m.conv_id")), "left").select("e.conv_id", *(F.col(f"m.{c}") for c in made.columns if c != "conv_id"))
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return both.withColumns(zero | {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))})
