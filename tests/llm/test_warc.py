import gzip

import pytest

from tallywork.llm import warc

DATE = "2024-01-01T00:00:00Z"
SCHEMA = "page_id bigint, url string, html string, record string, error string, _kept string"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def _response(head, payload, **named):
    block = (head + "\r\n\r\n").encode() + payload
    return warc.make_record(
        "response", block, "application/http; msgtype=response", record_id="<urn:uuid:1>", date=DATE, **named
    )


def test_records_survive_a_round_trip():
    record = _response("HTTP/1.1 200 OK", b"a\r\n\r\nb\x00\xff", target_uri="http://x/ é")
    assert warc.parse_record(record.to_bytes()) == record
    assert record.get("content-length") == str(len(record.block))
    assert record.get("WARC-Block-Digest") == warc.digest(record.block)
    folded = b"WARC/1.0\r\nWARC-Type: response\r\nX: a\r\n  b\r\nContent-Length: 0\r\n\r\n"
    assert warc.parse_record(folded).get("x") == "a b"
    for broken in (b"", b"HTTP/1.1 200\r\n\r\n", record.to_bytes()[:-10], b"WARC/1.1\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.parse_record(broken)


def test_digest_is_base32_sha1():
    assert warc.digest(b"") == "sha1:3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_derived_records_of_pages(spark):
    page = "<title>T &amp; t</title><nav>menu</nav><p>One\n two<p>three <a href='/l?a=1&amp;b'>link</a>"
    rows = [(1, "https://a.example/1", page), (2, None, None), (1, "https://a.example/1", page)]
    responses = warc.page_responses(_pages(spark, rows), date=DATE)
    found = warc.derive_records(responses, keep=["page_id"]).collect()
    assert len(found) == 6
    by = {(r.page_id, r.record_type): r for r in found}
    source = warc.parse_record(responses.filter("page_id = 1").first().record)
    meta, text = by[1, "metadata"], by[1, "conversion"]
    assert meta.refers_to == text.refers_to == source.get("WARC-Record-ID")
    assert meta.target_uri == text.target_uri == "https://a.example/1" and text.date == DATE
    assert text.block == "menu\nOne two\nthree link"
    assert text.source_payload_digest == warc.digest(page.encode())
    assert text.source_headers["content-type"] == "text/html; charset=utf-8"
    for r in found:
        assert r.content_length == len(r.block.encode()) and r.block_digest == warc.digest(r.block.encode())
        assert r.error is None
    lines = meta.block.split("\r\n")
    assert "source-status: HTTP/1.1 200 OK" in lines and "title: T & t" in lines
    assert "digests-agree: true" in lines and "outlink: /l?a=1&b" in lines
    assert f"source-warc-payload-digest: {warc.digest(page.encode())}" in lines
    assert by[2, "conversion"].block == "" and by[2, "conversion"].target_uri is None
    assert len({r.record_id for r in found}) == 4  # repeated rows give equal identifiers
    again = warc.parse_record(warc.to_bytes(text.asDict()))
    assert again.get("WARC-Refers-To") == source.get("WARC-Record-ID")
    assert again.get("WARC-Refers-To-Target-URI") == "https://a.example/1"
    assert again.get("WARC-Refers-To-Date") == DATE
    assert again.block.decode() == text.block


def test_bodies_and_digests():
    page = "<p>é</p>"
    chunked = b"3\r\n<p>\r\n2;x=1\r\n\xc3\xa9\r\n4\r\n</p>\r\n0\r\n\r\n"
    cases = {
        "Content-Type: text/html; charset=latin-1": page.encode("latin-1"),
        "Content-Type: text/html; charset=nonsense": page.encode(),
        "Content-Type: text/html; charset=idna": page.encode(),
        "Content-Type: text/html; charset=undefined": page.encode(),
        "Transfer-Encoding: chunked": chunked,
        "Content-Encoding: gzip": gzip.compress(page.encode()),
    }
    for header, payload in cases.items():
        made = warc.derive(_response(f"HTTP/1.1 200 OK\r\n{header}", payload))
        assert made[1].block.decode() == "é", header
    broken = warc.derive(_response("HTTP/1.1 200 OK\r\nContent-Encoding: gzip", b"not gzip"))
    assert broken[1].block == b"not gzip"
    wrong = warc.derive(_response("HTTP/1.1 200 OK", b"x", payload_digest="sha1:WRONG"))
    assert b"digests-agree: false" in wrong[0].block
    image = warc.derive(_response("HTTP/1.1 200 OK\r\nContent-Type: image/png", b"\x89"))
    assert [r.get("WARC-Type") for r in image] == ["metadata"]
    request = warc.make_record("request", b"GET /", "application/http", record_id="<urn:uuid:2>")
    assert warc.derive(request) == []


def test_unreadable_records_are_reported(spark):
    df = spark.createDataFrame([(1, None), (2, b"junk"), (3, b"")], "k int, record binary")
    found = warc.derive_records(df, keep=["k"]).collect()
    assert sorted(r.k for r in found) == [1, 2, 3] and all(r.error for r in found)
    assert warc.derive_records(df.filter("false"), keep=["k"]).collect() == []
    with pytest.raises(ValueError, match="error"):
        warc.derive_records(df.withColumnRenamed("k", "error"), keep=["error"])


def test_files(spark, tmp_path):
    records = [_response("HTTP/1.1 200 OK", b"<p>%d</p>" % i).to_bytes() for i in range(3)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "c.warc").write_bytes(b"".join(records)[:-40])
    found = warc.read_warc(spark, str(tmp_path)).collect()
    by_file = {n: [r.record for r in found if r.path.endswith(n)] for n in ("a.warc", "b.warc.gz", "c.warc")}
    assert [bytes(r) for r in by_file["a.warc"]] == records
    assert [bytes(r) for r in by_file["b.warc.gz"]] == records
    assert [bytes(r) for r in by_file["c.warc"]] == [*records[:2], b""]


def test_damaged_files_lose_only_what_is_damaged():
    records = [_response("HTTP/1.1 200 OK", b"<p>%d</p>" % i).to_bytes() for i in range(4)]
    whole = b"".join(records)
    assert list(warc.split_records(whole)) == records
    wrong = records[1].replace(b"Content-Length: ", b"Content-Length: 9")
    short = records[1].replace(b"Content-Length: 2", b"Content-Length: 1")
    for bad in (wrong, short, b"junk\r\n\r\n", records[1][: records[1].index(b"WARC-Date")]):
        assert list(warc.split_records(records[0] + bad + records[2] + records[3])) == [
            records[0], b"", records[2], records[3]
        ], bad
    members = [gzip.compress(r) for r in records]
    assert list(warc.split_records(b"".join(members))) == records
    cut = b"".join(members)[:-25]
    assert list(warc.split_records(cut)) == [*records[:3], b""]
    damaged = bytearray(members[1])
    damaged[40:60] = bytes(20)
    assert list(warc.split_records(members[0] + bytes(damaged) + members[2])) == [records[0], b"", records[2]]
    assert list(warc.split_records(gzip.compress(whole))) == records  # one member for all
    spread = gzip.compress(whole[:500]) + gzip.compress(whole[500:])
    assert list(warc.split_records(spread)) == records
    assert list(warc.split_records(members[0] + members[1][:30] + members[2])) == [records[0], b"", records[2]]
    assert list(warc.split_records(b"")) == []


def test_written_files_come_back(spark, tmp_path):
    records = [_response("HTTP/1.1 200 OK", b"<p>%d</p>" % i).to_bytes() for i in range(40)]
    df = spark.createDataFrame([(r,) for r in [*records, None]], "record binary").repartition(3)
    place = f"file://{tmp_path}/out"
    assert warc.write_warc(df, place) == 40
    assert warc.write_warc(df, place) == 40  # again: the same files
    assert warc.write_warc(df.coalesce(1), place) == 40  # fewer files: none stays from before
    found = warc.read_warc(spark, place)
    assert sorted(bytes(r.record) for r in found.collect()) == sorted(records)
    assert all(r.path.endswith(".warc.gz") for r in found.collect())
    texts = warc.derive_records(found, keep=["path"]).filter("record_type = 'conversion'")
    assert sorted(r.block for r in texts.collect()) == sorted(str(i) for i in range(40))
    assert warc.write_warc(df.filter("false"), f"file://{tmp_path}/none") == 0
