"""Operator 5: WARC archives with segmented records, written and read back.

Writing: every page is a response record whose HTTP block is framed by chunked transfer coding; a page whose payload, of
``least_bytes`` or more, equals that of a page with a smaller id is a revisit record instead. A block of more than
``segment_bytes`` is cut into a first record and continuation records (WARC-Segment-Number, -Origin-ID, -Total-Length).
The archives are gzipped files of a bounded number of records in the shared folder, written by Spark's text sink.

Reading: files are parsed by Content-Length record by record; segments are grouped by origin identifier in a shuffle,
ordered by number, checked for gaps and against the total length, and joined; then the chunks are decoded. A group is one
record, so no task holds more than a record's own payload; copies of one page shuffle as short revisit records.

A revisit holds its payload's length and digest in its own headers alone, so it is held against the response that it refers
to: the distinct claims of revisits meet the responses, one row each, and go back to the revisits where one is false.

Defined cases: a null payload is an empty one; a null id sorts after all others and is written as ``~``, which no id is, as
ids are percent-encoded; of rows with the same id and payload one is the response; line breaks in a URL become spaces; a broken
record (missing segment, wrong length, bad framing or digest; a revisit of what is absent, broken, no response or of other
length or digest) is returned with ``problem`` set; an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, release, scratch_path, written

LEAST_BYTES = 100
SEGMENT_BYTES = 8192
CHUNK_BYTES = 4096
RECORDS_PER_FILE = 2000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*headers, ("Content-Length", len(block))]]
    return "\r\n".join(["WARC/1.1", *lines]).encode() + END + block


def chunked(payload: bytes, size: int) -> bytes:
    parts = [payload[a : a + size] for a in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0" + END


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError for bad framing."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size
        if len(out[-1]) != size or body[at : at + 2] != b"\r\n":
            raise ValueError("chunk does not end where its size says")
        at += 2


def records_of(name: str, url: str | None, payload: bytes, first: str | None, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The WARC records of one page; ``first`` is the name of the page that it repeats."""
    digest = ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest())
    target = ("WARC-Target-URI", re.sub(r"[\r\n]+", " ", url or "about:blank"))
    rest = [("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response")]
    if first is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Length: %d" % len(payload) + END
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Refers-To", f"<{first}>"), ("WARC-Profile", PROFILE), target, digest, *rest], block)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + END + chunked(payload, chunk_bytes)
    parts = [block[a : a + segment_bytes] for a in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return [_record([("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), target, digest, *rest], block)]
    out = [_record([("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Segment-Number", 1), target, digest, *rest], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        total = [("WARC-Segment-Total-Length", len(block))] if k == len(parts) else []
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{k}>"), ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", k), *total, target, ("WARC-Date", DATE)], part))
    return out


def unzipped(data: bytes) -> bytes:
    """All members of a gzip file: archives often have one a record."""
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data.lstrip(b"\0")
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(END, at)
        head = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head[1:])}
        start = end + len(END)
        stop = start + int(headers["content-length"])
        yield headers, data[start:stop]
        at = stop + len(END)


def _prepared(pages: DataFrame, least_bytes: int) -> tuple[DataFrame, list[DataFrame]]:
    """Pages with ``name`` and, for revisits, ``first`` (the name of the response); the written tables behind them."""
    base = pages.withColumn("rid", F.monotonically_increasing_id())
    base = written(base.withColumn("digest", F.sha2("payload", 256)), "pages")
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "rid"))
    groups = base.where(F.length("payload") >= least_bytes).groupBy("digest").agg(F.count("*").alias("n"), first.alias("first")).where("n > 1")
    groups = written(groups, "groups")
    both = base.join(groups, "digest", "left")
    name = lambda i, r: F.concat(F.lit("urn:page:"), F.coalesce(F.url_encode(i.cast("string")), F.lit("~")), F.lit(":"), r.cast("string"))
    again = (F.length("payload") >= least_bytes) & F.col("n").isNotNull() & (F.col("rid") != F.col("first.rid"))
    out = both.select("url", "payload", name(F.col("page_id"), F.col("rid")).alias("name"), F.when(again, name(F.col("first.page_id"), F.col("first.rid"))).alias("first"))
    return out, [base, groups]


def write_archive(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    least_bytes: int = LEAST_BYTES, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
) -> None:
    """Write one record (or more, if segmented) a page to archives below ``path``."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    chosen = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), body.alias("payload"))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for row in range(batch.num_rows):
                link, body, name, first = (batch.column(c)[row].as_py() for c in ("url", "payload", "name", "first"))
                made = records_of(name, link, body, first, segment_bytes, chunk_bytes)
                out += made
                size += sum(map(len, made))
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    prepared, scratch = _prepared(chosen, least_bytes)
    records = prepared.mapInArrow(run, "record binary")
    lines = records.select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    release(*scratch)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The records as they stand in the archives, one row each."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["origin", "number", "total", "type", "refers", "digest", "block"]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = unzipped(data)
                for h, block in parse(data):
                    own = h["warc-record-id"].strip("<>")
                    total = h.get("warc-segment-total-length")
                    rows.append((h.get("warc-segment-origin-id", own).strip("<>"), int(h.get("warc-segment-number", 0)), int(total) if total else None, h["warc-type"], h.get("warc-refers-to", "").strip("<>") or None, h.get("warc-payload-digest"), block))
                    size += len(block)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    files = spark.read.format("binaryFile").load(path).select("content").where(F.length("content") > 0)
    return files.mapInArrow(run, "origin string, number int, total long, type string, refers string, digest string, block binary")


def _payload_of(parts: list[dict], total: int | None, kind: str, declared: str) -> tuple[bytes | None, int, str, str | None]:
    """(payload, its bytes, its digest, problem) of a reassembled record."""
    numbers = [p["number"] for p in parts]
    block = b"".join(p["block"] for p in parts)
    if numbers != [0] and (numbers != list(range(1, len(parts) + 1)) or total is None):
        return None, 0, "", "a segment is missing or doubled"
    if total is not None and total != len(block):
        return None, 0, "", "the segments do not add up to the total length"
    head, _, body = block.partition(END)
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    declared = (declared or "").removeprefix("sha256:")
    if kind == "revisit":
        return None, int(headers.get(b"content-length", b"0")), declared, None
    try:
        payload = dechunked(body) if headers.get(b"transfer-encoding", b"").lower() == b"chunked" else body
    except ValueError as problem:
        return None, 0, "", f"bad chunks: {problem}"
    digest = hashlib.sha256(payload).hexdigest()
    return payload, len(payload), digest, None if declared in ("", digest) else "the digest does not fit"


def reassembled(segments: DataFrame) -> DataFrame:
    """One row a record: name, record_type, refers (a name or null), payload (null for revisits), payload_bytes,
    payload_digest, problem (null if all is well)."""
    whole = segments.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"), F.max("total").alias("total"),
        F.max(F.when(F.col("number") <= 1, F.col("type"))).alias("type"), F.max("refers").alias("refers"), F.max("digest").alias("digest"),
    )

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in range(batch.num_rows):
                name, parts, total, kind, refers, digest = (batch.column(c)[r].as_py() for c in ("origin", "parts", "total", "type", "refers", "digest"))
                rows.append((name, kind, refers, *_payload_of(parts, total, kind, digest)))
            kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]
            names = ["name", "record_type", "refers", "payload", "payload_bytes", "payload_digest", "problem"]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], kind) for k, kind in enumerate(kinds)], names=names)

    return whole.mapInArrow(run, "name string, record_type string, refers string, payload binary, payload_bytes long, payload_digest string, problem string")


def revisits_checked(records: DataFrame) -> DataFrame:
    """The ``problem`` of revisits whose response is not there, has a problem itself, or has another length or digest.

    However many revisit one response, their equal claims are one row after a partial aggregation; false claims, none in a
    sound archive, are all that meets the revisits again.
    """
    claim = ["refers", "payload_bytes", "payload_digest"]
    claims = records.where("record_type = 'revisit' and problem is null").groupBy(*claim).agg(F.lit(1).alias("_n"))
    sound = records.where("record_type = 'response' and problem is null").select(
        F.col("name").alias("refers"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest")
    )
    told = claims.join(sound, "refers", "left")
    false = F.when(F.col("_bytes").isNull(), "the response is not there or broken").when((F.col("payload_bytes") != F.col("_bytes")) | (F.col("payload_digest") != F.col("_digest")), "the response has another payload")
    wrong = told.select(*(F.col(c).alias(f"_{c}") for c in claim), false.alias("_false")).where("_false is not null")
    met = (F.col("record_type") == "revisit") & F.col("problem").isNull()
    for c in claim:
        met = met & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return records.join(wrong, met, "left").withColumn("problem", F.coalesce("problem", "_false")).select(*records.columns)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write the archives to the shared folder, read them back, and report on each page: page_id, payload_bytes,
    payload_digest, record_type, refers_to, problem."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages, path, page_id, url, payload)
    found = revisits_checked(written(reassembled(read_segments(spark, path)).drop("payload"), "records"))
    number = lambda c: F.url_decode(F.nullif(F.split_part(F.col(c), F.lit(":"), F.lit(3)), F.lit("~"))).cast(pages.schema[page_id].dataType)
    return found.select(number("name").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers").alias("refers_to"), "problem")
