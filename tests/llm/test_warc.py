import gzip
import hashlib
import io

import duckdb
import pytest
from pyspark.sql import functions as F

from fleethealth.llm import warc

BIG = "<p>" + "é" * 4000 + "</p>"
PAGES = [
    (1, "http://a/ b", BIG),
    (2, "http://b/", BIG),
    (2, "http://b/", BIG),
    (3, "http://c/", BIG),
    (None, "http://d/", BIG),
    (4, None, "x" * 999),
    (5, "http://e/", "x" * 999),
    (6, "http://f/", None),
    (7, "http://g/", ""),
    (8, "http://h/", "\r\n\r\nWARC/1.1\r\n\r\n" * 300),
    (9, "http://i/", "y" * 1000),
    (10, "http://j/", "y" * 1000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "c", "d") for p in PAGES], "page_id long, url string, html string, path string, sha1 string").repartition(3).cache()


def want():
    out = []
    for i, _, h in PAGES:
        data = (h or "").encode()
        same = [j for j, _, x in PAGES if (x or "") == (h or "") and j is not None]
        stays = max(same, default=None)
        again = len(data) >= 1000 and i != stays and stays is not None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", stays if again else None))
    return sorted(out, key=repr)


def test_odd_pages_come_back(spark, pages):
    assert sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=repr) == want()
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_against_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{small}/pages.parquet'")
    cur = con.execute(warc.SQL)
    columns = [x[0] for x in cur.description]
    assert sorted((tuple(r) for r in warc.query(spark, small).select(*columns).collect()), key=repr) == sorted(cur.fetchall(), key=repr)


def test_chunks_carry_running_digests(spark, pages):
    rows = [r for r in warc.chunk_rows(pages, chunk=1000).where("page_id = 1").orderBy("chunk_no").collect()]
    data = BIG.encode()
    assert b"".join(bytes(r.data) for r in rows) == data and [r.chunk_no for r in rows] == list(range(9)) and [r.last for r in rows] == [False] * 8 + [True]
    assert all(r.sha1 == hashlib.sha1(data[: r.bytes]).hexdigest() for r in rows)


def test_read_in_chunks_gives_the_payloads(spark, pages, tmp_path):
    index = warc.write_archives(pages, f"file://{tmp_path}/w", chunk=700)
    rows = warc.read_archives(index, data=True, chunk=700).collect()
    by = {}
    for r in sorted(rows, key=lambda r: r.chunk_no):
        assert len(r.data) <= 700
        by[r.record_id] = by.get(r.record_id, b"") + bytes(r.data)
    of = lambda page: [x for r, x in by.items() if r.startswith(f"<urn:x-page:{page}:")]
    assert of(1) == [b""] and of(3) == [BIG.encode()] and of(8) == [PAGES[9][2].encode()]
    assert len(by) == len(PAGES) and len(of(2)) == 2, "repeated rows are records of their own"
    heads = warc.read_archives(index).collect()
    response = {r.record_id for r in heads if r.record_type == "response"}
    assert warc.record_id(3, hashlib.sha1(BIG.encode()).hexdigest()) in response, "what revisits refer to is there"
    assert {r.url for r in heads if r.page_id == 1} == {"http://a/%20b"}
    one = index.first()
    with open(one.path.removeprefix("file://"), "rb") as f:
        f.seek(one.offset)
        record = gzip.decompress(f.read(one.length))
    assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")


def test_spans_are_read_by_a_task_each(spark, tmp_path):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("http://x/").alias("url"), F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(60)), lambda k: F.sha2((F.col("id") * 100 + k).cast("string"), 256))).alias("html"))
    index = warc.write_archives(pages.repartition(2), f"file://{tmp_path}/w")
    few = warc.spans(index, 1 << 16)
    assert few.rdd.getNumPartitions() == few.count() > index.select("path").distinct().count()
    assert sum(1 for n in few.rdd.glom().map(len).collect() if n) > 0.7 * few.count()
    got = {(r.page_id, r.payload_digest) for r in warc.read_archives(index, span=1 << 16).collect()}
    assert got == {(r.page_id, hashlib.sha1(r.html.encode()).hexdigest()) for r in pages.collect()}


def test_damaged_archives_are_noticed():
    head = warc.header("<urn:x>", "u", "response", hashlib.sha1(b"abc").hexdigest(), len(warc.http_header(3)) + 3, None) + warc.http_header(3)
    good = gzip.compress(head + b"abc\r\n\r\n")
    assert [(k, p, last) for _, k, p, last, _, _ in warc.records(warc.inflated(io.BytesIO(good), 10), 2)] == [(0, b"ab", False), (1, b"c", True)]
    for bad in (head + b"abd\r\n\r\n", head + b"ab", head + b"abcd\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.records(warc.inflated(io.BytesIO(gzip.compress(bad)), 10), 2))
