"""Operator 13 against exhaustive search, its SQL, and defined cases."""

import hashlib
import itertools
import random
import zlib

import duckdb
import pytest

from radiospark.llm import conversation_repair as cr
from radiospark.llm import conversation_sql

ROWS = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def exhaustive(pattern):
    """All edits with up to three inserted rows, by plain recursion over what the rules allow."""
    found = []

    def go(k, roles, cost, audit, left):
        if k == len(pattern):
            text = "".join(roles)
            body = text[1:] if text[:1] == "s" else text
            if not text or (body and len(body) % 2 == 0 and body == "ua" * (len(body) // 2)):
                found.append((cost, audit))
        if left:
            for r in "ua":
                go(k, [*roles, r], cost + 3, audit + "I", left - 1)
        if k < len(pattern):
            row, cut = pattern[k], 3 * pattern[k].isupper()
            go(k + 1, roles, cost + 4, audit + "D", left)
            if row != "x":
                go(k + 1, [*roles, row.lower()], cost + cut, audit + "K", left)
                for r in "ua":
                    go(k + 1, [*roles, r], cost + 3 + cut, audit + "R", left)

    go(0, [], 0, "", 3)
    return min(found)


def test_search_is_exact():
    rng = random.Random(3)
    for n in range(4):
        for pattern in itertools.product("suaUAox", repeat=n):
            assert cr.best_edits("".join(pattern)) == exhaustive(pattern), pattern
    for _ in range(60):
        pattern = "".join(rng.choice("suaSUAoOx") for _ in range(5))
        assert cr.best_edits(pattern) == exhaustive(pattern), pattern


def test_bounds_never_exceed_the_cost():
    rng = random.Random(4)
    for _ in range(300):
        pattern = "".join(rng.choice("suaSUAoOx") for _ in range(rng.randrange(30)))
        bounds = cr.suffix_bounds(pattern)
        for k in range(len(pattern) + 1):
            assert bounds[k] <= min(b[0] for e in range(4) if (b := cr.best_edits(pattern[k:], e)))


def test_segments_chain_to_the_whole():
    rng = random.Random(5)
    for _ in range(100):
        pattern = "".join(rng.choice("suuaaSUAox") for _ in range(rng.randrange(1, 40)))
        cuts = sorted(rng.sample(range(1, len(pattern)), min(len(pattern) - 1, 3))) if len(pattern) > 1 else []
        parts = [pattern[a:b] for a, b in zip([0, *cuts], [*cuts, len(pattern)])]
        tables = [[(e, x, *b) for e in range(4) for x in range(4) if (b := cr.best_edits(p, e, x))] for p in parts]
        cost, chosen = cr.chained(tables)
        assert (cost, "".join(a for _, a in chosen)) == cr.best_edits(pattern)


def by_sql(rows):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    if rows:
        con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    cursor = con.execute(conversation_sql.SQL)
    assert [c[0] for c in cursor.description] == NAMES
    return sorted(cursor.fetchall(), key=str)


@pytest.fixture(scope="module")
def odd():
    """Long conversations, null ids, turns, roles and texts, ties, repeated rows, other roles, white and very long texts."""
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "c!", "", " \t", "d?\n", "é…", f"{t}."])) for t in range(400)]
    rows += [(c, rng.choice([None, 0, 1, 2, 5]), rng.choice(["user", "assistant", None, "", "üser", "u"]), rng.choice([None, "x.", "y", "x.", "\x0b"])) for c in (2, 3, 4, None) for _ in range(30)]
    rows += [(5, 3, "user", "same.")] * 4 + [(6, None, "user", "w" * 300_000), (6, None, "assistant", " " * 300_000 + "."), (7, 2, "system", "only.")]
    return rows


def test_odd_rows_against_sql(spark, odd):
    df = spark.createDataFrame(odd, ROWS)
    want = by_sql(odd)
    got = sorted((tuple(r) for r in cr.report(df.selectExpr("*", "role as fault", "text as audit", "1 as _row")).select(*NAMES).collect()), key=str)
    assert got == want
    made = {r[0]: r for r in got}
    small = cr.repair(cr.damaged(df.repartition(5)), 3, 2000).select(*NAMES).collect()
    assert {tuple(r) for r in small} == {made[r[0]] for r in small} and len(small) > 4


def test_defined_cases(spark):
    assert cr.report(spark.createDataFrame([], ROWS)).collect() == []
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    whole = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 > 4 for t in (1, 2, 5)))
    rows = [(lost, 0, "user", "gone."), (whole, 1, "user", "Hi."), (whole, 2, "assistant", "Yes."), (whole, 5, "user", "And")]
    got = {r["conv_id"]: r for r in cr.report(spark.createDataFrame(rows, ROWS)).collect()}
    assert tuple(got[lost])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert (got[whole]["gaps"], got[whole]["truncated"], got[whole]["cost"], got[whole]["audit"]) == (2, 1, 4, "KKD")
    assert got[whole]["repaired_sha256"] == hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest()


def test_long_patterns_end_soon():
    rng = random.Random(7)
    for letters in ("ua", "uuua", "suaUAox", "U", "o", "s", "uUx"):
        pattern = "".join(rng.choice(letters) for _ in range(cr.SEGMENT_ROWS))
        assert cr.best_edits(pattern) is not None and any(cr.best_edits(pattern, 0, x) for x in range(4))
