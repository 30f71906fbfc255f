import hashlib

import pytest

from capstream.llm import queries, warc_index
from capstream.llm.warc_index import archive, fetch, lookup, parse_record, record, surt

BIG = "<p>é " * 300


def brute(rows):
    groups = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and p is not None:
            groups.setdefault(b, []).append(p)
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        n = sum(1 for _, _, x in rows if (x or "").encode() == b)
        keep = max(groups[b]) if b in groups and n > 1 else None
        refers = keep if keep is not None and p != keep else None
        out.append((str(p), len(b), hashlib.sha1(b).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_keys():
    assert surt("https://User@B.Example.com:443/x y?q=1#f") == "com,example,b)/x%20y?q=1"
    assert surt("http://a.org:8080") == "org,a:8080)/" and surt(None) == "-" and surt("http://[bad") and " " not in surt("a b\n c")
    keys = [warc_index.capture_key("http://a.b", i) for i in (None, -5, 0, 7, 10**12)]
    assert keys == sorted(keys)


def test_record():
    r = parse_record(record(7, "http://a/\r\n x", b"ab\r\n\r\ncd", 8, hashlib.sha1(b"ab\r\n\r\ncd").hexdigest(), None, None, "f#1"))
    assert (r["type"], r["page_id"], r["payload"], r["payload_bytes"], r["refers_to"]) == ("response", 7, b"ab\r\n\r\ncd", 8, None)
    r = parse_record(record(None, None, None, 5000, "00" * 20, -3, "http://b", "f#2"))
    assert (r["type"], r["page_id"], r["payload"], r["payload_bytes"], r["refers_to"]) == ("revisit", None, None, 5000, -3)


@pytest.mark.parametrize("lines", [3, 2048])
def test_archive(spark, lines, monkeypatch):
    monkeypatch.setattr(warc_index, "LINES", lines)
    rows = [(1, "http://a.com/x", BIG), (2, "http://a.com/x", BIG), (9, "http://b.a.com", BIG), (9, "http://b.a.com", BIG), (3, None, None),
            (4, "http://a.com/x", ""), (None, "http://c.d", BIG), (None, None, "y" * 2000), (None, "u", "y" * 2000), (5, "bad url\n", "z" * 999),
            (6, "bad url\n", "z" * 999), (-7, "http://a.com/x", "q" * 200000)] + [(100 + i, "http://hot.com/", f"p{i}") for i in range(40)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")
    top = archive(df)
    assert rows_of(queries.read_back(spark, top, df)) == brute(rows)
    ids = [r.id for r in fetch(lookup(spark, top, df), lambda r: {"id": r["record_id"]}, "id string").collect()]
    assert len(ids) == len(set(ids)) == len(rows)
    # all captures of one URL, over block borders, with their whole payloads
    urls = spark.createDataFrame([("http://hot.com/",), ("https://a.com/x",), ("http://none.com",)], "url string")
    got = fetch(lookup(spark, top, urls, by_page=False), lambda r: {"p": r["page_id"], "h": None if r["payload"] is None else r["payload"].decode()},
                "p long, h string").collect()
    want = [(p, h) for p, u, h in rows if u in ("http://hot.com/", "http://a.com/x")]
    assert sorted(p for p, _ in got) == sorted(p for p, _ in want)
    assert {(p, h) for p, h in got if h is not None} == {(p, h) for p, h in want if p not in (1, 2)}


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert queries.read_back(spark, archive(df), df).count() == 0
