"""WARC bundles: exact round trip, revisits, seekable frames."""

import hashlib

import pytest
import zstandard

from ledgerloom.llm import warc
from ledgerloom.llm.common import scratch

BIG = "<p>" + "é text " * 300 + "</p>"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "d") for i, u, h in rows], "page_id bigint, url string, html string, digest string")


@pytest.fixture(scope="module")
def written(spark):
    rows = [(1, "http://a/x", BIG), (2, "http://a/y", BIG), (9, None, BIG), (3, "http://a/\r\nInjected: 1", "short"), (4, "u", "short"),
            (5, "u", None), (6, "u", ""), (7, "u", "WARC/1.1\r\n\r\nbody\r\n\r\n" * 100), (None, "u", BIG), (8, "u", "x" * 400_000),
            *((100 + k, f"http://b/{k}", f"<p>page {k}</p>" * 200) for k in range(60))]
    path = scratch(spark, "warc")
    warc.write(pages(spark, rows).repartition(3), path, frame_bytes=5_000, bundle_bytes=300)
    return rows, path, warc.read_records(spark, path).cache()


def test_round_trip(written):
    rows, _, records = written
    got = {r["id"]: r for r in records.collect()}
    assert len(got) == len(rows) == records.count()
    for i, url, html in rows:
        r, body = got[None if i is None else str(i)], (html or "").encode()
        revisit = i in (1, 2)
        assert (r["record_type"], r["refers_to"]) == (("revisit", "9") if revisit else ("response", None))
        assert bytes(r["payload"]) == (b"" if revisit else body)
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha1(body).hexdigest())
        assert r["url"] == " ".join((url or "").splitlines())


def test_bundles_are_seekable(spark, written):
    _, path, records = written
    files = {r["path"].rsplit("/", 1)[1]: bytes(r["content"]) for r in spark.read.format("binaryFile").load(f"{path}/bundles").collect()}
    assert len(files) > 3
    for archive in files.values():
        table = warc.seek_table(archive)
        whole = zstandard.ZstdDecompressor().stream_reader(archive, read_across_frames=True).read()
        assert whole == b"".join(warc.read_frame(archive, *entry) for entry in table)
    entries = warc.index(spark, path).collect()
    assert len(entries) == records.count()
    for r in entries:
        head, _ = warc.lookup(files[r["bundle"]], r["frame"], r["offset"])
        assert head["X-Page-ID"] == (r["id"] or "")


def test_a_broken_archive_is_reported():
    bundle = warc.Bundle()
    bundle.add(b"data")
    archive = bundle.close()
    assert warc.seek_table(archive) == [(0, len(bundle.frames[0]), 4)]
    with pytest.raises(ValueError):
        warc.seek_table(archive[:-1])
    with pytest.raises(ValueError):
        list(warc.parse(b"no record\r\n\r\n"))


def test_empty_table(spark):
    path = scratch(spark, "warc")
    warc.write(pages(spark, []), path)
    assert warc.read_records(spark, path).collect() == []


def test_an_id_with_two_payloads_keeps_both(spark):
    other, copied = "<p>other</p>" * 200, "<p>copied</p>" * 200
    rows = [(1, "u", BIG), (1, "v", other), (9, "w", BIG), (2, "u", BIG), (2, "v", copied), (8, "w", copied), (3, "u", BIG), (3, "u", BIG)]
    path = scratch(spark, "warc")
    warc.write(pages(spark, rows), path)
    got = warc.read_records(spark, path).collect()
    sha = lambda html: hashlib.sha1(html.encode()).hexdigest()
    assert sorted((r["id"], r["payload_digest"], r["refers_to"] or "", bytes(r["payload"]).decode()) for r in got) == sorted([
        ("1", sha(BIG), "9", ""), ("1", sha(other), "", other), ("9", sha(BIG), "", BIG), ("2", sha(BIG), "9", ""),
        ("2", sha(copied), "8", ""), ("8", sha(copied), "", copied), ("3", sha(BIG), "9", ""), ("3", sha(BIG), "9", "")])


def test_records_are_found_by_id(spark, written):
    rows, path, records = written
    ids = spark.createDataFrame([("102",), ("1",), (None,), ("nowhere",), ("102",)], "id string")
    got = {r["id"]: bytes(r["payload"]) for r in warc.read_records(spark, path, ids=ids).collect()}
    assert got == {"102": b"<p>page 2</p>" * 200, "1": b"", None: BIG.encode()}
    assert warc.read_records(spark, path, ids=ids.where("id = 'nowhere'")).collect() == []
    everything = warc.read_records(spark, path, ids=records.select("id"))
    assert everything.count() == len(rows)
    opened = {r["bundle"] for r in warc.read_records(spark, path, ids=ids.where("id = '102'")).collect()}
    assert len(opened) == 1


def test_a_look_up_over_many_bundles_joins_them_all(spark, written, monkeypatch):
    rows, path, records = written
    monkeypatch.setattr(warc, "MOST_NAMED", 1)
    assert warc.read_records(spark, path, ids=records.select("id")).count() == len(rows)


def test_a_payload_of_another_digest_is_reported():
    good = warc.record("response", "1", "u", b"body", hashlib.sha1(b"body").hexdigest(), 4)
    assert [p for _, _, p in warc.parse(good)] == [b"body"]
    with pytest.raises(ValueError, match="another digest"):
        list(warc.parse(good.replace(b"body", b"bodY")))
    assert list(warc.parse(warc.record("revisit", "1", "u", b"", hashlib.sha1(b"body").hexdigest(), 4, "2")))
