import base64
import gzip
import hashlib
from collections import defaultdict

from llm_cases import SF_DIR, texts_of

from limitlens.llm import queries, warc

SCHEMA = "page_id long, url string, html string, record_type string"


def expected(rows):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    largest = {h: max((p for p in ids if p is not None), default=None) for h, ids in groups.items()}
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        first = largest[html or ""]
        revisit = first is not None and page_id != first
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(str, out))


def found(df):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(str(tuple(r)) for r in df.select(*names).collect())


def test_query(spark):
    rows = texts_of(SF_DIR, "pages", "page_id, url, html")
    assert found(queries.QUERIES["op3_arc_to_warc"](spark, SF_DIR)) == expected(rows)


def odd_pages():
    return [
        (1, "http://a.example/x y#top", "<p>é\r\n\r\nWARC/1.0\n\n</p>"), (2, None, None), (3, "http://b/", ""),
        (4, "http://c/", "same"), (5, "http://d/", "same"), (5, "http://d/", "same"), (None, None, "same"),
        (None, "http://e/", "alone"), (6, "http://f/", "x" * 300_000), (7, "http://g/\n", "\n1 2 3\n"),
    ]


def test_odd_pages(spark):
    rows = odd_pages()
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    for parts in (1, 4):
        out = warc.pages_through_archives(df.repartition(parts))
        assert found(out) == expected(rows)
    assert {r["url"] for r in out.where("page_id in (1, 7)").collect()} == {"http://a.example/x y#top", "http://g/\n"}
    ids = [r["record_id"] for r in out.collect()]
    assert len(set(ids)) == len(ids)
    assert warc.pages_through_archives(df.limit(0)).collect() == []


def test_files_are_archives(spark, tmp_path):
    df = spark.createDataFrame([(*r, "clash") for r in odd_pages()], SCHEMA).repartition(2)
    warc.write_arc(df, f"file://{tmp_path}/arc")
    warc.convert(spark, f"file://{tmp_path}/arc", f"file://{tmp_path}/warc")
    heads = set()
    for file in (tmp_path / "arc").glob("*.gz"):
        heads.add(gzip.decompress(file.read_bytes()).split(b"\n")[1])
    assert heads == {b"1 0 limitlens", b"2 0 limitlens"}
    for file in (tmp_path / "warc").glob("*.gz"):
        for head, block in warc.warc_records(file.read_bytes()):
            assert head["WARC-Date"] == "2024-01-01T00:00:00Z"
            if head["WARC-Type"] == "response":
                assert "sha1:" + warc.payload_digest(block) == head["WARC-Payload-Digest"]
            if head["WARC-Type"] == "revisit":
                assert not block and head["WARC-Profile"] == warc.REVISIT_PROFILE


def test_old_lines_with_blanks_and_declared_fields():
    body = b"2 0 Old\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    block = b"filedesc://x.arc 0.0.0.0 19960923142103 text/plain 200 - - 0 x.arc %d\n" % len(body) + body
    record = b"\nhttp://a b/c d 1.2.3.4 19960923142104 text/html 200 abc - 99 x.arc 5\nh\nllo\n"
    (_, head, found_body), = warc.arc_records(block + record)
    assert head["URL"] == "http://a b/c d" and head["Result-code"] == "200" and found_body == b"h\nllo"


def test_a_body_shorter_than_declared_is_an_error():
    import pytest

    with pytest.raises(ValueError, match="declares 50 bytes"):
        list(warc.arc_records(b"http://a 0 19960923142104 text/html 50\nshort"))


def test_addresses_come_back_as_they_were(spark, tmp_path):
    urls = [
        "http://h/a%2Fb?q=%23x", "http://h/%E4", "http://h/%20 %20", "http://h/é?漢#page_id=9", "http://h/100%", "a\tb\r\n%0A",
        "http://h/#escaped_page_id=3", "http://h/a+b|c\"<>\\^`{}", "\u2028\x85", "%",
    ]
    df = spark.createDataFrame([(i, u, "x", "clash") for i, u in enumerate(urls)], SCHEMA)
    out = warc.pages_through_archives(df)
    assert {r["page_id"]: r["url"] for r in out.collect()} == dict(enumerate(urls))
    # Another archive's address has no mark and stays as it is.
    assert warc._page_of("http://h/a%20b") == ("http://h/a%20b", None)
    assert warc._page_of("http://h/#page_id=x") == ("http://h/#page_id=x", None)
