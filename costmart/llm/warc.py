"""Operator 5: WARC archives in which repeated payloads are revisit records.

Headers (id, address, length, SHA-256 of the payload) are aggregated by payload digest, with partial
sums before the shuffle; the record with the smallest id of each repeated payload is its response. The
decision is joined to the records by digest, and archives are written with fresh headers: a response
carries its payload, a revisit only the HTTP header and a reference to the response. Reading parses the
archives by Content-Length, takes length and digest of responses from the payload itself, and joins
revisits to the responses that they name.

Archives go through Spark's text writer, with the record separator as line separator: the commit
protocol gives recovery, and any file system Spark knows will do. Each file is one gzip member, and holds as
many records as the largest of them allows within FILE_BYTES, as a reader takes a file as one cell.

Defined results: NULL payloads are empty. Payloads under the limit are always responses. A NULL id counts
as the largest and has no page-id header. Rows that repeat id, address and payload are one response and
revisits of it. Control characters in an address are written as %20; a NULL address has no header. An
empty table gives no record. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm.frames import numbered, table
from costmart.session import scratch_path, stage_table

SEPARATOR = "\r\n\r\n"
MIN_REVISIT_BYTES = 100
RECORDS_PER_FILE = 20_000
FILE_BYTES = 1 << 30
# Header bytes of a record that are allowed for; addresses come on top.
_HEADER = 1 << 10
_READ = 1 << 20

RECORD_SCHEMA = (
    "record_id string, record_type string, page_id long, url string, refers_to_record string, "
    "payload_digest string, payload_bytes long, payload string"
)
_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("refers_to_record", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.string()),
    ]
)


def records_of(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest of every row."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    clean = F.regexp_replace(F.col(url).cast("string"), r"[\x00-\x20\x7f]", "%20")
    return pages.select(F.col(page_id).cast("long").alias("page_id"), clean.alias("url"), body.alias("payload")).select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2(F.encode("payload", "UTF-8"), 256).alias("payload_digest"),
    )


def originals(records: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """For each payload found more than once: the first record, and how many rows equal it."""
    first = F.struct(F.col("page_id").isNull().alias("absent"), "page_id", "url")
    headers = records.filter(F.col("payload_bytes") >= min_bytes).select("payload_digest", "page_id", "url")
    return (
        headers.groupBy("payload_digest", "page_id", "url")
        .agg(F.count("*").alias("rows"))
        .groupBy("payload_digest")
        .agg(F.min(first).alias("first"), F.sum("rows").alias("copies"), F.min_by("rows", first).alias("ties"))
        .filter("copies > 1")
    )


def _record_id(kind: Column, page_id: Column, url: Column, digest: Column) -> Column:
    """A name-based id: the same capture gets the same id, a revisit another one than its response."""
    name = F.md5(F.concat_ws("\n", kind, page_id.cast("string"), F.coalesce(url, F.lit("")), digest))
    parts = [F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def resolve(records: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Add record_type, record_id, refers_to_record and refers_to_url; drop the payload of revisits."""
    found = stage_table(originals(records, min_bytes), "warc-originals")
    joined = records.join(found.withColumnRenamed("payload_digest", "_digest"), F.col("payload_digest") == F.col("_digest"), "left")
    joined = joined.withColumn("_nth", F.lit(0).cast("long"))
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    repeats = F.col("_digest").isNotNull() & (F.col("payload_bytes") >= min_bytes)
    later = F.lit(False)
    if found.filter("ties > 1").head(1):
        # Rows that equal the response in all columns, any number of them: one stays the response. They are
        # numbered without their payload, which one row per digest brings back.
        same = F.coalesce(repeats & is_first & (F.col("ties") > 1), F.lit(False))
        tied = joined.filter(same)
        others = numbered(stage_table(tied.drop("payload", "_nth"), "warc-ties"), "payload_digest", ["payload_bytes"], "_nth")
        others = others.filter("_nth > 0").withColumn("payload", F.lit(""))
        joined = joined.filter(~same).unionByName(tied.dropDuplicates(["payload_digest"])).unionByName(others)
        later = F.col("_nth") > 0
    kind = F.when(repeats & (~is_first | later), F.lit("revisit")).otherwise(F.lit("response"))
    revisit = F.col("record_type") == "revisit"
    first_id = _record_id(F.lit("response"), F.col("first.page_id"), F.col("first.url"), F.col("payload_digest"))
    return joined.withColumn("record_type", kind).select(
        "page_id",
        "url",
        "record_type",
        _record_id(F.col("record_type"), F.col("page_id"), F.col("url"), F.col("payload_digest")).alias("record_id"),
        F.when(revisit, first_id).alias("refers_to_record"),
        F.when(revisit, F.col("first.url")).alias("refers_to_url"),
        "payload_bytes",
        "payload_digest",
        F.when(revisit, F.lit("")).otherwise(F.col("payload")).alias("payload"),
    )


def write_archives(resolved: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one WARC record per row as gzip-compressed archives under `path`."""

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.col("payload_bytes").cast("string")),
        F.lit("\r\n"),
    )
    block = F.concat(http, F.col("payload"))
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    revisit = F.col("record_type") == "revisit"
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("WARC-Profile", F.when(revisit, F.lit(profile))),
        line("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to_record"), F.lit(">"))),
        line("WARC-Refers-To-Target-URI", F.col("refers_to_url")),
        line("X-Page-Id", F.col("page_id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    # By the noted length, so that payloads are not moved for it; a revisit counts like its response.
    size = F.col("payload_bytes") + F.coalesce(F.octet_length("url"), F.lit(0)) * 2
    largest = _HEADER + (resolved.agg(F.max(size)).first()[0] or 0)
    (
        resolved.select(F.concat(header, block).alias("value"))
        .write.option("lineSep", SEPARATOR)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max(1, min(RECORDS_PER_FILE, FILE_BYTES // largest)))
        .text(path)
    )


class _Bytes:
    """Reads a gzip file's bytes in pieces, so that only the current record is held inflated."""

    def __init__(self, content: bytes):
        self.content, self.at, self.held = memoryview(content), 0, bytearray()
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.at >= len(self.content):
            return False
        piece = self.inflate.decompress(self.content[self.at : self.at + _READ])
        self.at += _READ
        while self.inflate.eof and self.inflate.unused_data:  # the next gzip member
            rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            piece += self.inflate.decompress(rest)
        self.held += piece
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (found := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self._more():
                if self.held.strip():
                    raise ValueError("an archive ends within a header")
                return None
        return self.take(found + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        if len(self.held) < n:
            raise ValueError("an archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def parse(content: bytes) -> Iterator[dict]:
    """The records of one archive. Length and digest of a response come from its payload."""
    source = _Bytes(content)
    while (head := source.until(b"\r\n\r\n")) is not None:
        version, *lines = head.decode().rstrip("\r\n").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        field = dict(x.split(": ", 1) for x in lines)
        block = source.take(int(field["Content-Length"]))
        if source.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        http, _, payload = block.partition(b"\r\n\r\n")
        kind, page = field["WARC-Type"], field.get("X-Page-Id")
        out = {
            "record_id": field["WARC-Record-ID"].strip("<>"),
            "record_type": kind,
            "page_id": None if page is None else int(page),
            "url": field.get("WARC-Target-URI"),
            "refers_to_record": field["WARC-Refers-To"].strip("<>") if kind == "revisit" else None,
            "payload_digest": None,
            "payload_bytes": None,
            "payload": None,
        }
        if kind == "response":
            digest = hashlib.sha256(payload).hexdigest()
            if field["WARC-Payload-Digest"] != f"sha256:{digest}":
                raise ValueError(f"{out['record_id']}: the payload does not match its digest")
            out |= {"payload_digest": digest, "payload_bytes": len(payload), "payload": payload.decode()}
        yield out


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records under `path`, revisits as they stand: their digest, length and payload are NULL."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for record in parse(content.as_py()):
                    size += record["payload_bytes"] or 0
                    held.append(record if payloads else record | {"payload": None})
                    if len(held) >= 2000 or size > 1 << 24:
                        yield pa.RecordBatch.from_pylist(held, _ARROW)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, _ARROW)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(rows, RECORD_SCHEMA)


def with_originals(records: DataFrame) -> DataFrame:
    """Revisits joined to the responses they name: page_id, payload_bytes, payload_digest, type, refers_to."""
    revisits = records.filter("record_type = 'revisit'")
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("_id"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("_bytes"),
        F.col("payload_digest").alias("_digest"),
    )
    named = revisits.select(F.col("refers_to_record").alias("_id")).distinct()
    responses = responses.join(named, "_id", "left_semi").dropDuplicates(["_id"])
    joined = revisits.join(responses, revisits["refers_to_record"] == responses["_id"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        records.filter("record_type = 'response'")
        .withColumn("refers_to", F.lit(None).cast("long"))
        .select(columns)
        .unionByName(
            joined.select(
                "page_id",
                F.col("_bytes").alias("payload_bytes"),
                F.col("_digest").alias("payload_digest"),
                "record_type",
                "refers_to",
            )
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(resolve(records_of(table(spark, sf_dir, "pages"))), path)
    return with_originals(stage_table(read_archives(spark, path, payloads=False).drop("payload"), "warc-records"))


ORACLE = f"""
with records as (
    select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest
    from pages
), firsts as (
    select *, min(page_id) over (partition by payload_digest) as first_id from records
)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= {MIN_REVISIT_BYTES} and page_id <> first_id then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= {MIN_REVISIT_BYTES} and page_id <> first_id then first_id end as refers_to
from firsts
"""
