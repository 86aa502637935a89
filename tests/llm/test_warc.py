import gzip
import hashlib
import io

import pytest
from samples import staging  # noqa: F401

from tripledger.llm import warc

PAGES = [(5, "u5", "é" * 60), (3, "u3", "é" * 60), (9, "u9", "é" * 60), (3, "u3", "é" * 60), (1, "u1", "short"), (2, "u2", "short"),
         (4, None, None), (6, "u6\r\nX: y", ""), (None, "n", "n" * 200), (None, "n", "m" * 200), (7, "u7", "n" * 200),
         (8, "u8", "WARC/1.1\r\n\r\n" * 20), (10, "big", "z\x00" * 200_000)]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)


def test_a_round_trip(spark, staging, pages):
    warc.register(spark)
    path = staging.path("warc")
    warc.page_records(pages).write.format("warc").mode("append").option("maxFileBytes", "300").save(path)
    got = sorted((r.page_id is None, r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                 for r in warc.read_pages(spark, path).collect())
    want = []
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        same = [p[0] for p in PAGES if (p[2] or "").encode() == body]
        first = min((i for i in same if i is not None), default=None)
        again = len(body) >= 100 and page_id != first
        want.append((page_id is None, page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                     first if again else None))
    assert got == sorted(want)
    payloads = {r.page_id: r.payload for r in warc.read_pages(spark, path).where("record_type = 'response'").collect()}
    assert bytes(payloads[10]) == b"z\x00" * 200_000 and bytes(payloads[4]) == b""


def test_filters_and_columns_reach_the_source(spark, staging, pages):
    warc.register(spark)
    path = staging.path("warc")
    warc.page_records(pages).write.format("warc").mode("append").save(path)
    back = spark.read.format("warc").load(path)
    assert back.where("record_type = 'revisit'").count() == 3
    assert back.where("record_type IN ('response') AND target_uri LIKE 'u%'").count() == 7
    assert back.where("target_uri IS NULL").count() == 1
    reader = warc.WarcReader(back.schema, {"path": path})
    rest = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_length",), 3)]))
    assert [f.attribute for f in rest] == [("payload_length",)]
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 3
    assert spark.read.format("warc").schema("record_id string, payload_length long").load(path).count() == len(PAGES)


def test_uncommitted_files_are_not_read_and_overwriting_replaces(spark, staging, pages):
    warc.register(spark)
    path = staging.path("warc")
    for _ in range(2):
        warc.page_records(pages).write.format("warc").mode("append").save(path)
    assert spark.read.format("warc").load(path).count() == 2 * len(PAGES)
    system, root = warc._open(path)
    with system.open_output_stream(f"{root}/part-lost.warc.gz", compression=None) as out:
        out.write(b"half a record")
    assert spark.read.format("warc").load(path).count() == 2 * len(PAGES)
    warc.page_records(pages.limit(1)).write.format("warc").mode("overwrite").save(path)
    assert spark.read.format("warc").load(path).count() == 1


def test_an_empty_table_gives_an_empty_archive(spark, staging, pages):
    warc.register(spark)
    path = staging.path("warc")
    warc.page_records(pages.limit(0)).write.format("warc").mode("append").save(path)
    assert warc.read_pages(spark, path).count() == 0


@pytest.mark.parametrize("packed", [False, True])
def test_archives_of_others_are_read(packed):
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n\r\n"
    body = gzip.compress(b"hello world")
    chunked += b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in (body[:5], body[5:])) + b"0\r\n\r\n"

    def one(kind, block, *more):
        head = [b"WARC/1.0", b"WARC-Type: " + kind, *more, b"Content-Length: %d" % len(block)]
        data = b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"
        return gzip.compress(data) if packed else data
    data = (one(b"warcinfo", b"a: b\r\n") + one(b"response", chunked, b"content-type: application/http; msgtype=response")
            + one(b"resource", b"plain", b"Content-Type: text/plain"))
    found = list(warc.records(io.BufferedReader(io.BytesIO(data)), lambda row: True, True, True))
    assert [(r["record_type"], r.get("payload")) for r in found] == [
        ("warcinfo", b"a: b\r\n"), ("response", b"hello world"), ("resource", b"plain")]
    only = list(warc.records(io.BufferedReader(io.BytesIO(data)), lambda row: row["record_type"] == "resource", False, False))
    assert len(only) == 1 and "payload" not in only[0]
