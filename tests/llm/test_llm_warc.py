"""ARC files to WARC files and back."""

import gzip

import pytest

from marquee.llm import warc
from marquee.session import new_folder

PAGES = [
    (1, "http://a.org/x y", "<p>same</p>", "t", 5),
    (2, "http://b.org/é", "<p>same</p>", "t", 5),
    (3, None, None, "t", 5),
    (4, "http://c.org/", "", "t", 5),
    (5, "http://d.org/", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\nhttp://x 0 0 0 5\n\n\n", "t", 5),
    (6, "http://e.org/", "<p>é\r\n\r\n</p>\n" * 3000, "t", 5),
    (7, "http://e.org/", "alone", "t", 5),
    (7, "http://e.org/", "alone", "t", 5),
    (None, "http://f.org/", "<p>same</p>", "t", 5),
    (None, "http://f.org/", "without any id", "t", 5),
]


def converted(spark, pages):
    arc, made = new_folder(spark, "arc"), new_folder(spark, "warc")
    warc.write_arc(pages, arc)
    warc.arc_to_warc(spark, arc, made)
    return arc, made


def pages_table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, type string, digest int")


def test_odd_pages(spark):
    _, made = converted(spark, pages_table(spark, PAGES).repartition(3))
    records = warc.read_warc(spark, made, payloads=True).collect()
    assert len(records) == len(PAGES)
    payloads = {r.page_id: r.payload.decode() for r in records if r.type == "response" and r.page_id}
    assert payloads == {2: PAGES[1][2], 4: "", 5: PAGES[4][2], 6: PAGES[5][2], 7: "alone"}
    assert {r.date for r in records} == {"2024-01-01T00:00:00Z"}
    assert {r.uri for r in records if r.page_id in (1, 3)} == {"http://a.org/x%20y", "unknown:"}
    rows = sorted((tuple(r) for r in warc.resolved(warc.read_warc(spark, made)).collect()), key=str)
    sha = lambda t: warc.base32_sha1(t.encode())
    same, empty = PAGES[0][2], ""
    want = [
        (1, 11, sha(same), "revisit", 2),
        (2, 11, sha(same), "response", None),
        (3, 0, sha(empty), "revisit", 4),
        (4, 0, sha(empty), "response", None),
        (5, len(PAGES[4][2]), sha(PAGES[4][2]), "response", None),
        (6, len(PAGES[5][2].encode()), sha(PAGES[5][2]), "response", None),
        (7, 5, sha("alone"), "response", None),
        (7, 5, sha("alone"), "response", None),
        (None, 11, sha(same), "revisit", 2),
        (None, 14, sha("without any id"), "response", None),
    ]
    assert rows == sorted(want, key=str)


def test_an_empty_table(spark):
    _, made = converted(spark, pages_table(spark, []))
    assert warc.resolved(warc.read_warc(spark, made)).collect() == []


def test_files_hold_a_bounded_number_of_records(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 4)
    arc, made = converted(spark, pages_table(spark, [(i, "http://h/", f"page {i % 9}", "t", 1) for i in range(30)]).repartition(2))
    for path in spark.read.format("binaryFile").load(arc).select("content").collect():
        assert gzip.decompress(path.content).startswith(b"filedesc://")
        assert len(list(warc.arc_records(bytes(path.content)))) <= 4
    rows = warc.resolved(warc.read_warc(spark, made)).collect()
    assert len(rows) == 30
    assert all(r.refers_to == 27 + r.page_id % 9 - (9 if r.page_id % 9 > 2 else 0) for r in rows if r.record_type == "revisit")


def test_both_header_versions():
    body = b"<p>\nx 1 2 3 4\n</p>"
    for version, line in (
        (1, b"http://h/a b 1.2.3.4 20010203040506 text/html %d\n"),
        (2, b"http://h/a b 1.2.3.4 20010203040506 text/html 200 sum - 17 f.arc %d\n"),
    ):
        data = warc.arc_version_block(version, "f.arc") + b"\n" + line % len(body) + body + b"\n\n" + line % 0 + b"\n"
        for packed in (data, gzip.compress(data), gzip.compress(data[:50]) + gzip.compress(data[50:])):
            (fields, content), (_, empty) = warc.arc_records(packed)
            assert (fields["URL"], fields["Archive-date"], content, empty) == ("http://h/a b", "20010203040506", body, b"")


def test_bytes_that_are_no_text_and_short_dates():
    fields = {"URL": "http://h/", "IP-address": "1.2.3.4", "Archive-date": "19990102", "Archive-length": "9"}
    made = warc.converted(fields, b"HTTP/1.0 200 OK\r\n\r\n\xff\xfe\x00", None)
    ((header, block),) = warc.warc_records(made + b"\r\n\r\n")
    assert header["warc-date"] == "1999-01-02T00:00:00Z"
    assert block.endswith(b"\xff\xfe\x00") and header["warc-payload-digest"] == f"sha1:{warc.base32_sha1(b'\xff\xfe\x00')}"


def test_a_record_that_is_cut_off():
    data = warc.arc_version_block(1, "f") + b"\nhttp://h/ 1.2.3.4 20010203040506 text/html 99\nshort"
    with pytest.raises(ValueError, match="cut off"):
        list(warc.arc_records(data))
    with pytest.raises(ValueError, match="ARC version: 3"):
        list(warc.arc_records(b"filedesc://f 0.0.0.0 1 text/plain 10\n3 0 marque\n"))
