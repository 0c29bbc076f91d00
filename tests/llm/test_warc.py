import gzip
import hashlib
import os

from pyspark.sql import functions as F

from llm.helpers import rows
from riskloom.llm import warc


def frame(spark, pages):
    return spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("digest", "size", "salt", "keeper", "payload")})


def brute(pages):
    keeper = {}
    for i, _, html in pages:
        b = (html or "").encode()
        if len(b) >= 1000 and i is not None:
            keeper[b] = max(keeper.get(b, i), i)
    out = []
    for i, _, html in pages:
        b = (html or "").encode()
        k = keeper.get(b)
        kind = "response" if k is None or k == i else "revisit"
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), kind, k if kind == "revisit" else None))
    return sorted(out, key=str)


def test_small_table(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    index, folder = warc.write_archives(pages)
    got = warc.read_records(index, folder)
    assert rows(got.drop("url", "payload")) == brute([(r.page_id, r.url, r.html) for r in pages.collect()])
    assert sorted((r.page_id, r.url, bytes(r.payload).decode()) for r in got.collect()) == sorted((r.page_id, r.url, r.html) for r in pages.collect())


def test_copies_nulls_and_hot_payload(spark):
    same, short, edge = "é" * 600, "x" * 999, "y" * 1000
    pages = [(i, f"http://a/{i}", same) for i in range(40)] + [(50, None, None), (51, "u", ""), (None, "http://n", same), (None, "v", "z" * 2000)]
    pages += [(60, "a\r\nb", short), (61, "c", short), (62, "d", edge), (63, "e", edge), (63, "e", edge), (70, "f", "\r\n\r\nWARC/1.1\r\n" * 200), (71, "g", "long " * 500_000)]
    index, folder = warc.write_archives(frame(spark, pages))
    got = warc.read_records(index, folder)
    assert rows(got.drop("url", "payload")) == brute(pages)
    urls = {r.page_id: r.url for r in got.collect()}
    assert urls[50] is None and urls[60] == "a%0D%0Ab"


def test_files_are_gzip_members_and_selection_reads_part(spark):
    pages = [(i, f"http://a/{i}", f"page {i} " * 200) for i in range(30)]
    index, folder = warc.write_archives(frame(spark, pages))
    some = index.where("page_id in (3, 17)")
    assert sorted(r.page_id for r in warc.read_records(some, folder).collect()) == [3, 17]
    text = b"".join(gzip.open(os.path.join(folder, f)).read() for f in os.listdir(folder))
    assert text.count(b"WARC/1.1\r\n") == 30 and b"WARC-Target-URI: http://a/7\r\n" in text


def test_ranges_merge_near_neighbours():
    found = list(warc.ranges([("a", 0, 10), ("a", 10, 5), ("a", 40, 5), ("b", 0, 7)], gap=20, most=100))
    assert found == [("a", 0, 15, [(0, 10), (10, 5)]), ("a", 40, 45, [(40, 5)]), ("b", 0, 7, [(0, 7)])]


def test_empty_table(spark):
    index, folder = warc.write_archives(frame(spark, [(1, "u", "h")]).limit(0))
    assert warc.read_records(index, folder).collect() == []


def test_index_rows_that_are_null_or_given_twice(spark):
    index, folder = warc.write_archives(frame(spark, [(1, "u", "h"), (2, "v", "w")]))
    odd = index.withColumn("file", F.when(F.col("page_id") == 1, F.col("file")))
    assert [r.page_id for r in warc.read_records(odd.unionByName(odd), folder).collect()] == [1, 1]
