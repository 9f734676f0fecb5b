import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from evenkeel.llm.warc import export_warc, read_archive, read_payloads, read_records, rebuilt, write_archive


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "archive")


def archive(spark, rows, path, columns="page_id long, url string, html string"):
    pages = spark.createDataFrame(rows, columns)
    write_archive(pages, path)
    return sorted((tuple(r) for r in read_archive(spark, path).collect()), key=repr)


def brute(rows):
    same = defaultdict(list)
    for page, _, html in rows:
        same[html or ""].append(page)
    result = []
    for page, url, html in rows:
        data = (html or "").encode()
        last = max(same[html or ""])
        revisit = len(data) >= 1000 and page != last
        result.append((page, "revisit" if revisit else "response", len(data), hashlib.sha1(data).hexdigest(), last if revisit else None, url))
    return sorted(result, key=repr)


def test_pages(spark, sf_dir, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    rows += [(p + 10**6, u, h) for p, u, h in rows[::3]]
    assert archive(spark, rows, folder) == brute(rows)
    stored = read_payloads(spark, folder)
    assert stored.count() == len({r[2] for r in rows}) == stored.select("sha256").distinct().count()


def test_records_are_rebuilt_byte_by_byte(spark, folder):
    big = "<p>é</p>" * 200
    archive(spark, [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (3, None, "small")], folder)
    records = sorted(bytes(r.record) for r in rebuilt(spark, folder).collect())
    size = len(big.encode())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    digest = hashlib.sha1(big.encode()).hexdigest()

    def head(kind, page, url, more, length):
        return (
            f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{page}>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"
            f"WARC-Target-URI: {url}\r\nWARC-Payload-Digest: sha1:{digest}\r\n{more}"
            f"Content-Type: application/http;msgtype=response\r\nContent-Length: {length}\r\n\r\n"
        )

    profile = "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"
    response = head("response", 2, "http://b/%0D%0AX: y", "", len(http) + size) + http + big + "\r\n\r\n"
    revisit = head("revisit", 1, "http://a/", "WARC-Refers-To: <urn:page:2>\r\n" + profile, len(http)) + http + "\r\n\r\n"
    assert response.encode() in records and revisit.encode() in records
    small = next(r for r in records if b"page:3" in r)
    assert b"Target-URI" not in small and small.endswith(b"\r\n\r\nsmall\r\n\r\n")

    export_warc(spark, folder, f"{folder}-warc")
    exported = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(f"{folder}-warc").collect())
    assert sorted(exported.split(b"WARC/1.1\r\n")[1:]) == sorted(r.split(b"WARC/1.1\r\n")[1] for r in records)


def test_a_wrong_payload_is_an_error(spark, folder):
    archive(spark, [(1, "u", "text"), (2, "u", "other")], folder)
    wrong = read_payloads(spark, folder).withColumn("payload", F.lit(b"changed"))
    wrong.write.parquet(f"{folder}-2/payloads")
    read_records(spark, folder).write.parquet(f"{folder}-2/records")
    with pytest.raises(Exception, match="payload differs from its digest"):
        read_archive(spark, f"{folder}-2").collect()


def test_a_lost_payload_is_an_error(spark, folder):
    archive(spark, [(1, "u", "text"), (2, "u", "other")], folder)
    read_payloads(spark, folder).limit(1).write.parquet(f"{folder}-2/payloads")
    read_records(spark, folder).write.parquet(f"{folder}-2/records")
    with pytest.raises(Exception, match="no payload fits"):
        read_archive(spark, f"{folder}-2").collect()


def test_odd_rows(spark, folder):
    big = "x" * 1000
    rows = [(None, None, None), (1, "", ""), (None, "u", big), (None, "u", big), (2, "u", "x" * 999), (3, "u", "x" * 999), (4, "u", "é" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "own", 1) for r in rows], "page_id long, url string, html string, sha256 string, keep int")
    write_archive(pages, folder)
    got = [(r.page_id, r.record_type, r.payload_bytes, r.refers_to) for r in read_archive(spark, folder).collect()]
    expected = [
        (None, "response", 0, None), (1, "response", 0, None), (None, "response", 1000, None), (None, "revisit", 1000, None),
        (2, "response", 999, None), (3, "response", 999, None), (4, "response", 6_000_000, None),
    ]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert read_payloads(spark, folder).count() == 4


def test_repeated_rows(spark, folder):
    big = "x" * 1000
    got = archive(spark, [(5, "u", big), (5, "u", big), (4, "u", big)], folder)
    assert [(r[0], r[1], r[4]) for r in got] == [(4, "revisit", 5), (5, "response", None), (5, "revisit", 5)]


def test_no_pages(spark, folder):
    assert archive(spark, [], folder) == []
