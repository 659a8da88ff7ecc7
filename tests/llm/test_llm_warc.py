"""WARC round trip, header push-down and skipped payloads."""

from __future__ import annotations

import gzip
import hashlib
import io

import pytest
from pyarrow import fs

from ledgerloom.llm import warc

BIG = "é<html>\r\n\r\nWARC/1.1\r\n" + "x" * 1200


def pages(spark):
    rows = [(1, "http://a/1", BIG), (5, "http://a/5", BIG), (3, None, BIG), (7, "http://b/\r\nX: y", "small"),
            (8, "http://b/8", "small"), (9, "u", None), (10, "u", ""), (None, "u", BIG), (11, "http://c", "z" * 999),
            (12, "http://c", "z" * 999), (7, "http://b/7", "small")]
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string")


def test_round_trip(spark):
    got = {(r.page_id, r.payload_digest, r.payload_bytes): r for r in warc.archive_round_trip(pages(spark)).collect()}
    for r in pages(spark).collect():
        raw = (r.html or "").encode()
        out = got[(r.page_id, hashlib.sha1(raw).hexdigest(), len(raw))]
        again = r.html == BIG and r.page_id != 5
        assert (out.record_type, out.refers_to) == (("revisit", 5) if again else ("response", None))
    assert warc.archive_round_trip(pages(spark)).count() == 11
    assert warc.archive_round_trip(pages(spark).filter("false")).count() == 0


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_push_down_skips_payloads(spark, tmp_path, compression):
    path = f"file://{tmp_path}/w"
    warc.write_warc(pages(spark), path, compression=compression)
    found = warc.read_warc(spark, path).filter("record_type = 'response' and target_uri like 'http://a/%'")
    assert [bytes(r.payload).decode() for r in found.collect()] == [BIG]
    # the reader has taken the predicates: Spark has no filter of its own left
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "Filter " not in plan
    heads = warc.read_warc(spark, path, "record_id string, content_length long, headers map<string,string>")
    assert heads.count() == 11 and heads.filter("content_length > 1200").count() == 1
    assert heads.filter(heads["headers"]["warc-type"] == "revisit").count() == 3
    assert warc.read_warc(spark, path).filter("record_type in ('metadata')").count() == 0


def test_reader_against_a_hand_made_file(tmp_path):
    body = b"hello\r\n\r\n"
    raw = b"".join(
        b"WARC/1.0\r\nWARC-Type: %s\r\nContent-Type: text/plain\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (k, len(body), body)
        for k in (b"warcinfo", b"resource"))
    (tmp_path / "a.warc").write_bytes(raw)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(raw))
    for name in ("a.warc", "b.warc.gz"):
        got = list(warc.records(fs.LocalFileSystem(), str(tmp_path / name), [("record_type", lambda x: x == "resource")]))
        assert [(r["record_type"], r["payload"], r["http_length"]) for r in got] == [("resource", body, len(body))]
    (tmp_path / "cut.warc").write_bytes(raw[:100])
    with pytest.raises(ValueError, match="cut off|no record"):
        list(warc.records(fs.LocalFileSystem(), str(tmp_path / "cut.warc"), []))


class Counted(io.RawIOBase):
    """A file that counts the bytes read from it."""

    def __init__(self, data: bytes):
        self.data, self.at, self.n = data, 0, 0

    def readable(self):
        return True

    seekable = readable

    def readinto(self, b):
        part = self.data[self.at:self.at + len(b)]
        b[:len(part)] = part
        self.at += len(part)
        self.n += len(part)
        return len(part)

    def seek(self, offset, whence=0):
        self.at = offset + (0, self.at, len(self.data))[whence]
        return self.at

    def tell(self):
        return self.at


class OneFile:
    def __init__(self, data: bytes):
        self.file = Counted(data)

    def open_input_file(self, path):
        return self.file


def test_reader_skips_the_bytes_of_unwanted_payloads():
    body = b"x" * 8_000_000
    raw = b"".join(b"WARC/1.1\r\nWARC-Type: %s\r\nWARC-Target-URI:  http://a/\xff \r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (k, len(body), body)
                   for k in (b"response", b"resource", b"response", b"metadata"))
    few = [("record_type", lambda x: x == "metadata")]
    for tests, payload, least, most in ((few, True, 8, 14), (few, False, 0, 6), ([], False, 0, 6), ([], True, 32, 34)):
        store = OneFile(raw)
        got = list(warc.records(store, "a.warc", tests, payload, payload))
        assert len(got) == (1 if tests else 4) and all((r.get("payload") == body) == payload for r in got)
        assert got[0]["target_uri"] == " http://a/\\xff "
        assert least * 10 ** 6 <= store.file.n <= most * 10 ** 6
