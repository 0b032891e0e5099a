import gzip
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiospark.llm import warc
from radiospark.llm.queries import OP5_SQL, op5_warc

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("digest", T.StringType())])
TRAP = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n0\r\n\r\n"


def brute(rows):
    first = {}
    for i, (p, _, h, _) in enumerate(rows):
        key = (p is None, p or 0, i)
        if (h or "") not in first or key < first[h or ""][0]:
            first[h or ""] = (key, p, i)
    out = []
    for i, (p, _, h, _) in enumerate(rows):
        data = (h or "").encode()
        again = len(data) >= 100 and first[h or ""][2] != i
        out.append((p, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[h or ""][1] if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    rng = random.Random(8)
    texts = [None, "", "x", TRAP, TRAP * 400, "é" * 50, "é" * 49 + "x", "日本🙂\r\n" * 4000] + ["".join(rng.choices("ab \r\n0", k=rng.choice([99, 100, 9000, 60_000]))) for _ in range(20)]
    rows = [(i, rng.choice([None, "http://a/\r\nX: y", "u"]), rng.choice(texts), "d") for i in range(150)] + [(7000, "u", TRAP * 400, "d")] * 2 + [(None, "u", "é" * 50, "d"), (None, "u", "z" * 300, "d")]
    got = warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert all(r["problem"] is None for r in got)
    assert sorted([tuple(r)[:5] for r in got], key=str) == brute(rows)
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_payloads_and_broken_records(spark, tmp_path):
    rows = [(i, "u", chr(97 + i) * 30_000, None) for i in range(6)]
    path = "file://" + str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame(rows, SCHEMA), path)
    segments = warc.read_segments(spark, path)
    whole = {r["name"]: r for r in warc.reassembled(segments).collect()}
    assert sorted(bytes(r["payload"]).decode() for r in whole.values()) == [r[2] for r in rows]
    assert segments.where("type = 'continuation'").count() >= 18
    lost = warc.reassembled(segments.where("number != 2")).collect()
    assert len(lost) == 6 and all("missing" in r["problem"] for r in lost)
    short = segments.withColumn("block", F.when(F.col("number") == 3, F.expr("substring(block, 1, 10)")).otherwise(F.col("block")))
    assert all("add up" in r["problem"] for r in warc.reassembled(short).collect())
    assert all("digest" in r["problem"] for r in warc.reassembled(segments.withColumn("digest", F.lit("sha256:00"))).collect())
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    assert sorted(map(str, (tuple(r) for r in op5_warc(spark, sf_dir).collect()))) == sorted(map(str, con.execute(OP5_SQL).fetchall()))


def test_archives_with_a_gzip_member_a_record(spark, tmp_path):
    records = [r for k in range(5) for r in warc.records_of(f"urn:page:{k}:{k}", None, b"body %d " % k * 900, None, 1000, 300)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r + warc.END) for r in records))
    got = warc.reassembled(warc.read_segments(spark, str(tmp_path))).collect()
    assert sorted((r["name"], bytes(r["payload"]), r["problem"]) for r in got) == [(f"urn:page:{k}:{k}", b"body %d " % k * 900, None) for k in range(5)]


def test_text_ids(spark):
    ids = ["a:b", "null", "~", "", "é%3A", None, "a:b"]
    got = warc.round_trip(spark.createDataFrame([(i, "u", "same " * 50) for i in ids], "page_id string, url string, html string")).collect()
    assert sorted((r["page_id"] for r in got), key=str) == sorted(ids, key=str)
    assert [r["page_id"] for r in got if r["record_type"] == "response"] == [""]
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {""} and all(r["problem"] is None for r in got)


def test_revisits_are_held_against_their_response(spark, tmp_path):
    path = "file://" + str(tmp_path / "archive")
    rows = [(i, "u", "a" * 30_000 if i < 4 else "b" * 200, None) for i in range(8)]
    warc.write_archive(spark.createDataFrame(rows, SCHEMA), path)
    segments = warc.read_segments(spark, path)

    def problems(df):
        return {int(r["name"].split(":")[2]): r["problem"] for r in warc.revisits_checked(warc.reassembled(df).drop("payload")).collect()}

    page = F.split_part("origin", F.lit(":"), F.lit(3))
    assert set(problems(segments).values()) == {None}
    without = problems(segments.where(page != "0"))
    assert {k for k, p in without.items() if p} == {1, 2, 3} and all("not there" in without[k] for k in (1, 2, 3))
    broken = problems(segments.where((page != "0") | (F.col("number") != 2)))
    assert {k for k, p in broken.items() if p} == {0, 1, 2, 3} and "missing" in broken[0] and "broken" in broken[1]
    claims = F.when(page == "5", F.concat(F.lit("sha256:"), F.sha2(F.lit(b"else"), 256))).otherwise(F.col("digest"))
    other = problems(segments.withColumn("digest", claims))
    assert {k for k, p in other.items() if p} == {5} and "another payload" in other[5]
    unnamed = problems(segments.withColumn("refers", F.when(page != "6", F.col("refers"))))
    assert {k for k, p in unnamed.items() if p} == {6}
