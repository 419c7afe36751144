"""Records as the format asks for them, round trips through archives, and coalesced reads."""

import gzip
import hashlib
import random

import pytest

from hostvane.llm import warc

COLUMNS = "page_id long, url string, html string, offset string, digest string"


def pages(n=300):
    rng = random.Random(1)
    bodies = ["", "<p>é ünï</p>", "x" * 200_000, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"] + [f"<html>{rng.random()}</html>" for _ in range(80)]
    rows = [(k * 7 % n - 5, f"http://h/{k} a\r\nb", rng.choice(bodies)) for k in range(n)]
    return rows + [(1000, None, None), (None, "u", "only without id"), (None, "u", bodies[5]), (2000, "", "same"), (2000, "", "same")]


def expected(rows, least=0):
    first = {}
    for key, _, html in rows:
        if key is not None:
            first[html or ""] = min(first.get(html or "", key), key)
    out = []
    for key, _, html in rows:
        payload = (html or "").encode()
        revisit = len(payload) >= least and (html or "") in first and first[html or ""] != key
        out.append((key, len(payload), warc.digest_text(hashlib.sha1(payload).digest()), "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 1000])
def test_round_trip(spark, least):
    rows = pages()
    table = spark.createDataFrame([(*r, "o", "d") for r in rows], COLUMNS).repartition(5)
    index = warc.write_archives(table, least_bytes=least)
    got = warc.read_records(index).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows, least)
    assert all(r.intact for r in got)
    html = {(key, (html or "").encode()) for key, _, html in rows}
    assert all((r.page_id, bytes(r.payload)) in html for r in got if r.record_type == "response")
    assert all("\r" not in r.url and "\n" not in r.url for r in got if r.url)


def test_only_selected_records_are_read(spark):
    index = warc.write_archives(spark.createDataFrame([(*r, "o", "d") for r in pages()], COLUMNS))
    chosen = index.where("page_id % 11 = 0")
    got = warc.read_records(chosen, payloads=False)
    assert "payload" not in got.columns
    assert sorted(r.page_id for r in got.collect()) == sorted(r.page_id for r in chosen.collect())


def test_archives_are_plain_gzip_members(spark):
    index = warc.write_archives(spark.createDataFrame([(1, "http://a/", "hello", "", ""), (2, "http://b/", "hello", "", "")], COLUMNS))
    for row in index.collect():
        data = open(row.archive.removeprefix("file://"), "rb").read()
        text = gzip.decompress(data[row.offset : row.offset + row.length])
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: " + row.record_type.encode()) and text.endswith(b"\r\n\r\n")
        head, rest = text.split(b"\r\n\r\n", 1)
        assert f"Content-Length: {len(rest) - 4}".encode() in head
        assert (b"hello" in rest) == (row.record_type == "response")


def test_ranges_join_neighbours():
    places = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 10), ("b", 110, 10), ("b", 120, 500), ("b", 620, 5)]
    runs = list(warc.ranges(iter(places), gap=5, span=50))
    assert runs == [places[:3], places[3:4], places[4:5], places[5:6], places[6:]]


def test_ids():
    for key in (0, 1, -1, 2**63 - 1, -(2**63), None):
        assert warc._page_id(warc._record_id(key)) == key


def test_empty(spark):
    index = warc.write_archives(spark.createDataFrame([], COLUMNS))
    assert index.collect() == [] and warc.read_records(index).collect() == []
