import struct

import pytest
import zstandard

from tidemark.llm import warc


def raw(payload=b"hello", **change):
    import base64
    import hashlib

    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return warc.record(1, "http://a/", payload, change.get("digest", digest), change.get("size", len(payload)), change.get("refers"))


def archive(records, words=b""):
    shared = zstandard.ZstdCompressionDict(words) if words else None
    press = zstandard.ZstdCompressor(dict_data=shared)
    return warc.frames(b"".join(press.compress(r) for r in records), words)


def test_frames_are_read_with_the_leading_dictionary():
    words = zstandard.train_dictionary(2000, [raw(bytes([i % 250]) * 40 + b"common text of pages") for i in range(400)]).as_bytes()
    records = [raw(b"x" * n) for n in (0, 1, 200_000)]
    data = archive(records, words) + warc.EMPTY_FRAME.encode()
    assert [r for _, r in warc.read_frames(data)] == records
    packed = zstandard.ZstdCompressor().compress(words)
    data = struct.pack("<II", warc.DICTIONARY_FRAME, len(packed)) + packed + data[8 + len(words):]
    assert [r for _, r in warc.read_frames(data)] == records
    with pytest.raises(warc.BadRecord):
        list(warc.read_frames(data[8 + len(packed):]))


def test_what_does_not_hold_is_refused():
    assert warc.checked(raw())[:3] == ("1", "http://a/", "response")
    good = raw()
    bad = [
        raw(digest="A" * 32), raw(size=4), good[:-1], good + b"x", good.replace(b"WARC/1.1", b"HTTP/1.1"),
        good.replace(b"Content-Length: 5", b"Content-Length: 6"), good.replace(b"Content-Length: 5", b"Content-Length: -5"),
        good.replace(b"WARC-Type: response\r\n", b""), good.replace(b"WARC-Type: response", b"WARC-Type: revisit"), b"",
        good.replace(b"WARC-Date", b"WARC-Type"),
    ]
    for b in bad:
        with pytest.raises(warc.BadRecord):
            warc.checked(b)
    for cut in (3, 12, 40):
        with pytest.raises(warc.BadRecord):
            list(warc.read_frames(archive([good])[:-cut]))


def test_lenient_reading_tells_the_problem(spark, tmp_path):
    (tmp_path / "a.warc.zst").write_bytes(archive([raw(), raw(size=9), raw()]))
    (tmp_path / "b.warc.zst").write_bytes(archive([raw()])[:-4])
    rows = warc.read_archives(spark, str(tmp_path), strict=False).collect()
    assert sorted((r.record_id, r.problem is None) for r in rows if r.record_id) == [("1", True)] * 2
    assert sum(r.problem is not None for r in rows) == 2


def test_payloads_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    rows = [(i, f"http://h/{i}\r\nX: y%", f"<p>é{i % 7}</p>" * (i % 7)) for i in range(40)]
    back = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), least=20).collect()
    html = {i: h for i, _, h in rows}
    assert {r.record_id: r.url for r in back} == {i: u for i, u, _ in rows}
    for r in back:
        whole = html[r.record_id].encode()
        first = r.record_id if len(whole) < 20 else min(i for i, h in html.items() if h.encode() == whole)
        assert (r.record_type, r.refers_to) == (("response", None) if first == r.record_id else ("revisit", first))
        assert r.payload == (whole if r.record_type == "response" else b"") and r.payload_bytes == len(whole)
