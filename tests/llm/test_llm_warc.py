import gzip
import io
import os

import pytest

from inkstream.llm import warc as W
from inkstream.session import fresh_path

ROWS = [(3, "http://a/ b", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "http://c\r\nX: y", None), (4, "http://d", ""), (5, "http://e", "x" * 300000),
        (None, "http://f", "only nameless"), (None, "http://g", "<p>é</p>"), (1, "http://h", "<p>é</p>"), (6, "http://i", "a\r\n\r\nb")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, record_type string")


def back(spark, rows, **how):
    folder = fresh_path(spark, "warc")
    manifest = W.write(pages(spark, rows), folder, **how)
    return folder, manifest, W.read_archives(manifest, folder)


@pytest.mark.parametrize("file_bytes", [1 << 27, 200])
def test_round_trip(spark, file_bytes):
    folder, manifest, rows = back(spark, ROWS, file_bytes=file_bytes)
    got = rows.collect()
    assert len(got) == len(ROWS) == sum(m.records for m in manifest.collect())
    first = {}
    for i, _, h in ROWS:
        first.setdefault(h or "", []).append(i)
    first = {h: min((i for i in ids if i is not None), default=None) for h, ids in first.items()}
    want = []
    for i, _, h in ROWS:
        raw, rev = (h or "").encode(), i != first[h or ""]
        want.append((str(i), len(raw), W.base32_sha1(raw), "revisit" if rev else "response", str(first[h or ""] if rev else None),
                     b"" if rev else raw))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to), bytes(r.payload)) for r in got) == sorted(want)
    assert W.unresolved(rows).count() == 0
    assert all("\n" not in (r.target_uri or "") for r in got)
    for m in manifest.collect():       # any gzip reader sees the same records
        data = gzip.open(os.path.join(folder.replace("file:", ""), m.archive)).read()
        assert data.count(b"WARC/1.1\r\nWARC-Type:") == m.records


def test_least_and_empty(spark):
    _, _, rows = back(spark, ROWS, least=9)
    assert {r.record_type for r in rows.collect() if r.payload_bytes < 9} == {"response"}
    _, manifest, rows = back(spark, ROWS[:1], least=0)
    assert rows.count() == 1
    folder = fresh_path(spark, "warc")
    manifest = W.write(pages(spark).limit(0), folder)
    assert manifest.count() == 0 and W.read_archives(manifest, folder).count() == 0


def stream(*records):
    return io.BytesIO(b"".join(records))


def test_sequential_reader_checks():
    one = W.page_record(1, "http://a", b"payload" * 50000, None, False)
    two = W.page_record(2, None, b"payload" * 50000, 1, True)
    got = list(W.records(stream(one, two)))
    assert [g["payload_bytes"] for g in got] == [350000, 0] and got[1]["offset"] == len(one)
    assert W.page_row(got[1], "x")[3] == 350000
    for bad in (one[:-5], one[:60], bytes(b ^ 255 * (len(one) // 2 <= k < len(one) // 2 + 9) for k, b in enumerate(one)), b"junk" + one):
        with pytest.raises(W.WarcError):
            list(W.records(stream(two, bad)))
    wrong = [("WARC-Type", "response"), ("Content-Type", "text/html"), ("Content-Length", "3")]
    with pytest.raises(W.WarcError):   # digest of something else
        list(W.records(stream(W.record([*wrong, ("WARC-Payload-Digest", "sha1:" + W.base32_sha1(b"abd"))], [b"abc"]))))
    for text in (b"ab", b"abcd"):      # content length differs
        with pytest.raises(W.WarcError):
            list(W.records(stream(W.record(wrong, [text]))))
    with pytest.raises(W.WarcError):
        list(W.records(stream(W.record(wrong[:2], [b"abc"]))))


def test_pieces_are_small(monkeypatch):
    monkeypatch.setattr(W, "PIECE", 7)
    rec = W.page_record(9, "http://x", "ü\r\n\r\n".encode() * 500, None, False)
    assert [r["payload"] for r in W.records(stream(rec, rec))] == ["ü\r\n\r\n".encode() * 500] * 2
