import pytest

from ragtide.llm import warc

ODD = [(9001, None, None), (9002, "", ""), (9003, "http://a.b/", None), (9004, "http://a.b/", "x"),
       (9005, "http://a.b/", "x"), (9006, "http://[bad", "é"), (9007, "u\n v", "é"), (None, "http://n/", "x"),
       (9004, "http://a.b/", "x"), (9008, "http://long/", "<p>" * 200000)]


def brute(rows):
    first = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if i is not None:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        kind = "revisit" if h in first and i != first[h] else "response"
        out.append((str(i), len(h), warc.base32_sha1(h), kind, first[h] if kind == "revisit" else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("lines", [256, 2])
def test_archives_read_back(spark, sf, with_clashes, lines):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").unionByName(
        spark.createDataFrame(ODD, "page_id bigint, url string, html string"))
    rows = [tuple(r) for r in pages.collect()]
    archive = warc.write_archives(with_clashes(pages), file_bytes=40_000)
    index = warc.build_index(archive, block_lines=lines)
    got = warc.read_records(warc.lookup(index, archive.select("key"))).collect()
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got),
                  key=str) == brute(rows)
    texts = {i: (h or "").encode() for i, _, h in rows}
    assert all(bytes(r.payload) == texts[r.page_id] for r in got if r.record_type == "response")
    some = spark.createDataFrame([("b,a)/",), ("zzz",), ("b,a)/",), ("",)], "key string")
    found = sorted((r.key, str(r.page_id)) for r in warc.lookup(index, some).collect())
    assert found == sorted((warc.url_key(u), str(i)) for i, u, _ in rows if warc.url_key(u) in ("b,a)/", ""))


def test_small_payloads_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "v", "long enough"), (4, "w", "long enough")],
                                  "page_id bigint, url string, html string")
    archive = warc.write_archives(pages, min_bytes=5)
    got = warc.read_records(archive).collect()
    assert {r.page_id: r.refers_to for r in got} == {1: None, 2: None, 3: None, 4: 3}
    none = warc.write_archives(pages.limit(0))
    assert warc.read_records(warc.lookup(warc.build_index(none), none.select("key"))).count() == 0


def test_url_keys():
    assert warc.url_key("HTTP://User@WWW.Example.com:80/A/b?q=1#f") == "com,example,www:80)/A/b?q=1"
    assert warc.url_key("http://example.com") == "com,example)/"
    assert warc.url_key(None) == "" and warc.url_key("no host") == "no host"
