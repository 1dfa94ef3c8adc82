import base64
import hashlib
import struct

import pytest
import zstandard

from lendwatch.llm import warc as W
from lendwatch.storage import new_path

PAGES = "page_id long, url string, html string"


def expected(rows, least=0):
    best = {}
    for i, _, html in rows:
        b = (html or "").encode()
        if len(b) >= least and i is not None:
            best[b] = max(best.get(b, i), i)
    out = []
    for i, _, html in rows:
        b = (html or "").encode()
        to = best.get(b) if best.get(b) != i else None
        sha = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((i, len(b), sha, "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()], key=str)


def test_whole_small_table(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert got(W.round_trip(spark, pages)) == expected(rows)


def test_edges(spark):
    rows = [(1, "u", "é" * 10), (2, None, "é" * 10), (3, "a\r\nb", None), (4, "x", ""), (-5, "n", "é" * 10), (None, "z", "q")]
    rows += [(10 + i, "hot", "same page") for i in range(200)] + [(9, "long", "word " * 300_000)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as sha1", "2 as response")
    assert got(W.round_trip(spark, df)) == expected(rows)
    assert got(W.round_trip(spark, df, min_bytes=9)) == expected(rows, 9)
    assert W.round_trip(spark, df.limit(0)).collect() == []


def test_payloads_and_archives(spark, monkeypatch):
    rows = [(i, f"http://h/{i}", f"<p>{'text ' * (i % 50)}{i}</p>") for i in range(500)]
    folder = new_path(spark, "warc-test")
    written = W.write_archives(spark.createDataFrame(rows, PAGES).repartition(2), folder)
    assert sum(r.records for r in written.collect()) == 500
    back = W.read_archives(spark, folder).collect()
    assert sorted((r.page_id, r.url, r.payload.decode()) for r in back) == rows
    name = written.first().archive
    content = open(name, "rb").read()
    assert struct.unpack_from("<I", content)[0] == W.SKIPPABLE and struct.unpack_from("<I", content, 4)[0] > 0
    for bad in (content[:-3], content[:40], content[: len(content) // 2] + b"x" + content[len(content) // 2 + 1 :]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(W.read_archive(bad))


def test_records_are_validated():
    good = W.encode_record(7, "u", b"abc", W.digest(b"abc"), None)
    assert W.decode_record(good)[0] == 7
    for bad in (good.replace(b"abc", b"abd"), good[:-1], good.replace(b"WARC/1.1", b"WARK/1.1"), good + b"x"):
        with pytest.raises((ValueError, KeyError)):
            W.decode_record(bad)

