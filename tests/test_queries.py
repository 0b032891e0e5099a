"""Every registered query against its SQL oracle."""

import datetime
import math

import duckdb
import pytest

from radiospark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, sf_dir, duck, name):
    df = registry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    cursor = duck.execute(registry.oracle_sql()[name])
    there = [x[0] for x in cursor.description]
    assert sorted(there) == columns
    want = sorted((tuple(plain(r[there.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all(a == b or isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 2e-5 * max(1, abs(a)) for a, b in zip(g, w)), (g, w)


def test_queries_without_sql_are_tested_elsewhere():
    assert set(registry.queries()) - set(registry.oracle_sql()) == {"r1_sum_threshold", "r4_high_pass", "r8_flag_schedule", "k2_schedule_chain"}  # test_interference.py, test_snapshots.py
