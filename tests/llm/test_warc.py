"""WARC archives: SQL, records read by other means, and edge cases."""

import gzip
import hashlib
import base64
import json
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHES, rows
from tests.oracle import connect, difference
from wardflow.llm import queries, warc

COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
CASES = [
    (1, "http://a/1", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://a/3\r\nX: y", None), (4, "", ""), (None, "http://é/ ü%41", "<p>x</p>"),
    (5, "u", "né\r\n\r\nWARC/1.1\r\n"), (5, "u", "né\r\n\r\nWARC/1.1\r\n"), (6, "v", "long " * 100000), (7, "v", "y\x00z"), (None, "w", "only null"),
]


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def wanted(cases, least=0):
    out, taken = [], set()
    for k, (key, _, html) in enumerate(cases):
        same = [(-1 if c[0] is None else c[0], -j) for j, c in enumerate(cases) if (c[2] or "") == (html or "")]
        size = len((html or "").encode())
        best = max(same)
        response = size < least or (-1 if key is None else key, -k) == best
        keeper = cases[-best[1]][0]
        out.append((key, size, b32(html), "response" if response else "revisit", None if response else keeper))
    return sorted(out, key=repr)


@pytest.fixture
def pages(spark):
    def make(cases):
        made = spark.createDataFrame(cases, "page_id long, url string, html string")
        return made.withColumns({c: F.lit("x") for c in CLASHES})

    return make


def test_oracle(spark, sf_dir):
    assert difference(connect(sf_dir), queries.op13_warc(spark, sf_dir), queries.ORACLES["op13_warc"]) is None


@pytest.mark.parametrize("least", [0, 9])
def test_cases(pages, least):
    assert rows(warc.round_trip(pages(CASES), least=least), *COLUMNS) == wanted(CASES, least)


def test_hot_payload(pages, monkeypatch):
    cases = [(k, "u", "hot" if k % 3 else f"p{k % 60}") for k in range(400)]
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 7)
    for share in (4096, 2, 0):
        monkeypatch.setattr(warc.decided, "__defaults__", (0, share))
        assert rows(warc.round_trip(pages(cases)), *COLUMNS) == wanted(cases)


def members(raw):
    """(offset, length, content) of every gzip member of a file."""
    at = 0
    while at < len(raw):
        one = zlib.decompressobj(31)
        text = one.decompress(raw[at:]) + one.flush()
        size = len(raw) - at - len(one.unused_data)
        yield at, size, text
        at += size


def test_files(pages, tmp_path):
    made = warc.archived(pages(CASES).coalesce(1), f"file://{tmp_path}")
    ((name, count),) = [tuple(r) for r in made.collect()]
    (crawl,) = (tmp_path / "crawl").glob("*.warc.gz")
    assert len(list(members(crawl.read_bytes()))) == 1
    path = name.removeprefix("file://")
    held = list(members(open(path, "rb").read()))
    index = [json.loads(line) for line in open(f"{path}.idx")]
    assert count == len(held) == len(index) == len(CASES)
    assert [(o, n) for o, n, _ in held] == [(e["offset"], e["length"]) for e in index]
    whole = gzip.decompress(crawl.read_bytes())
    for (_, _, text), (_, _, html), entry in zip(held, CASES, index):
        block = (html or "").encode()
        assert entry["id"].encode() in text and text.endswith(b"\r\n\r\n")
        if entry["type"] == "response":
            assert text in whole and text.endswith(b"\r\n\r\n" + block + b"\r\n\r\n")
        else:
            assert b"WARC-Refers-To: <urn:uuid:" in text and text.count(b"\r\n\r\n") == 3
    ids = [e["id"] for e in index]
    assert len(set(ids)) == len(ids)


def test_payloads_and_urls_come_back(pages):
    index = warc.entries(warc.archived(pages(CASES)))
    back = warc.read_records(index).filter("record_type = 'response'").collect()
    assert {bytes(r["payload"]).decode() for r in back} == {h or "" for _, _, h in CASES}
    urls = {r["page_id"]: r["url"] for r in back}
    assert urls["6"] == "v" and urls["2"] is None and urls["4"] == ""
    assert warc.entries(warc.archived(pages(CASES))).filter("type = 'revisit'").count() == 4


def test_damage_is_found(pages, tmp_path):
    records = warc.crawled(pages([(1, "u", "abc")]), f"file://{tmp_path}/crawl")
    (crawl,) = (tmp_path / "crawl").glob("*.warc.gz")
    crawl.write_bytes(gzip.compress(gzip.decompress(crawl.read_bytes()).replace(b"abc", b"abd")))
    with pytest.raises(Exception, match="not what its digest says"):
        warc.normalised(warc.decided(records, "long"), f"file://{tmp_path}/records")


def test_empty(pages):
    assert warc.round_trip(pages([])).collect() == []
