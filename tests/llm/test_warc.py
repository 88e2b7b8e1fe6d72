import gzip

import pytest
from conftest import DATA
from oracle_check import compare, duck

from costmart.llm import warc as W
from costmart.session import scratch_path

BIG = "x" * 150 + "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
ROWS = [
    (3, "http://a", BIG), (1, "http://b\r\nX: y", BIG), (1, "http://b\r\nX: y", BIG), (None, None, BIG),
    (2, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
]


def archived(spark, pages):
    path = scratch_path(spark, "warc-test")
    W.write_archives(W.resolve(W.records_of(pages)), path)
    return W.read_archives(spark, path)


def test_odd_records(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "1 as copies", "2 as first", "3 as payload")
    records = archived(spark, pages)
    responses = {r.page_id: r.payload for r in records.where("record_type = 'response'").collect()}
    assert responses == {1: BIG, 2: "", 4: "", 5: "short", 6: "short"}
    found = W.with_originals(records).collect()
    assert len(found) == len(ROWS)
    assert sorted((r.page_id or 0, r.refers_to, r.payload_bytes) for r in found if r.record_type == "revisit") == [
        (0, 1, len(BIG.encode())), (1, 1, len(BIG.encode())), (3, 1, len(BIG.encode())),
    ]
    assert W.with_originals(archived(spark, pages.limit(0))).count() == 0


def test_archives_are_parsed_by_length_and_checked():
    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    digest = "2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824"
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Payload-Digest: sha256:{digest}\r\nContent-Length: {len(body)}\r\n\r\n"
    record = head.encode() + body + b"\r\n\r\n"
    two_members = gzip.compress(record) + gzip.compress(record)
    assert [r["payload"] for r in W.parse(two_members)] == ["hello", "hello"]
    with pytest.raises(ValueError, match="digest"):
        list(W.parse(gzip.compress(record.replace(b"hello", b"hallo"))))
    with pytest.raises(ValueError, match="ends within"):
        list(W.parse(gzip.compress(record[:-8])))


def test_matches_sql(spark):
    assert compare(W.query(spark, DATA), duck(DATA), W.ORACLE) == []


def test_equal_rows_of_a_hot_payload_are_one_response(spark):
    """A third of the rows repeat one record in all columns; their payload is not moved to number them."""
    rows = [(7, "http://hot", BIG)] * 400 + [(n, f"http://p/{n}", BIG if n % 10 == 0 else f"{n} " * 60) for n in range(8, 800)]
    rows += [(5, None, "tie " * 50)] * 3 + [(None, None, "none " * 50)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    resolved = W.resolve(W.records_of(pages))
    found = W.with_originals(archived(spark, pages)).collect()
    assert len(found) == len(rows) and resolved.count() == len(rows)
    hot = [r for r in found if r.page_id == 7]
    assert sorted(r.record_type for r in hot).count("response") == 1 and len(hot) == 400
    assert {r.refers_to for r in found if r.record_type == "revisit" and r.page_id not in (5, None)} == {7}
    assert [r.record_type for r in found if r.page_id == 5].count("response") == 1
    assert [r.record_type for r in found if r.page_id is None].count("response") == 1


def test_files_are_bounded_by_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(W, "FILE_BYTES", 100_000)
    monkeypatch.setattr(W, "_READ", 1 << 10)
    pages = spark.createDataFrame([(n, "u", str(n) * 5_000) for n in range(1, 40)], "page_id long, url string, html string").coalesce(1)
    W.write_archives(W.resolve(W.records_of(pages)), f"{tmp_path}/warc")
    sizes = [len(gzip.decompress(f.read_bytes())) for f in (tmp_path / "warc").glob("*.gz")]
    assert len(sizes) > 3 and max(sizes) <= 100_000
    assert W.read_archives(spark, f"{tmp_path}/warc").count() == 39
