import gzip
import hashlib
import zlib

import pytest
from llm_fixtures import rows, table  # noqa: F401

from stratalake.llm import warc as m

PAGES = "page_id long, url string, html string"


def run(pages, folder):
    archives = m.write_archives(m.record_types(pages), f"file://{folder}/crawl")
    index = m.normalise(archives, f"file://{folder}/records")
    return archives, index, m.read_records(index)


def test_records(table, tmp_path, monkeypatch):
    """Equal payloads, small ones, nulls, line breaks, blank lines within payloads, several archives."""
    monkeypatch.setattr(m, "ARCHIVE_BYTES", 4000)
    big, odd = "x" * 100, "é\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 9
    given = [(7, "u", big), (3, "u", big), (9, None, big), (3, "v", big), (1, "u", "x" * 99), (2, "u", "x" * 99)]
    given += [(20, "a\r\nb: c", odd), (21, "u", odd), (30, "u", None), (31, "u", ""), (None, "u", big), (None, "u", "alone" * 40)]
    given += [(100 + i, "u", f"{i} " + "page " * 300) for i in range(20)]
    pages = table([(*r, 1) for r in given], f"{PAGES}, digest int").repartition(3)
    archives, index, found = run(pages, tmp_path)
    first = {}
    for page, _, html in given:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(page, first.get(html, page))
    expected = []
    for page, _, html in given:
        data = (html or "").encode()
        revisit = html in first and first[html] != page
        kind = ("revisit", first[html]) if revisit else ("response", None)
        expected.append((page, len(data), hashlib.sha256(data).hexdigest(), *kind, True))
    assert sorted(rows(found), key=repr) == sorted(expected, key=repr)
    assert archives.count() > 3

    for name, in rows(index.select("archive").distinct()):
        raw = (tmp_path / name).read_bytes()
        members = sorted(rows(index.where(index.archive == name), "offset", "length", "record_id", "record_type"))
        assert members[0][0] == 0 and sum(r[1] for r in members) == len(raw)
        assert all(gzip.decompress(raw[o : o + n]).startswith(b"WARC/1.1\r\n") for o, n, *_ in members)
        lines = (tmp_path / f"{name}.idx").read_text().splitlines()
        assert sorted(x.split() for x in lines) == sorted([i, t, str(o), str(n)] for o, n, i, t in members)


def test_archives_are_one_stream(table, tmp_path):
    archives, _, _ = run(table([(i, "u", f"{i}" * 500) for i in range(50)], PAGES).coalesce(1), tmp_path)
    data = open(archives.first()["archive"], "rb").read()
    stream = zlib.decompressobj(31)
    text = stream.decompress(data)
    assert stream.eof and not stream.unused_data
    assert text.count(b"WARC-Type: response") == 50


def test_no_pages(table, tmp_path):
    archives, index, found = run(table([], PAGES), tmp_path)
    assert archives.count() == index.count() == found.count() == 0


@pytest.mark.parametrize("piece", [1, 7, 1000])
def test_streams_of_any_pieces(piece):
    """Records come whole from pieces of any size, one member or several, and long ones don't need more memory than their own."""
    records = [m.record(i, "http://x/é", f"\r\n\r\n{i}".encode() * (i * 40), "00" * 32, None if i % 2 else 4) for i in range(8)]
    for data in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        pieces = (data[i : i + piece] for i in range(0, len(data), piece))
        assert [r + b"\r\n\r\n" for r in m.split_records(m.inflate(pieces))] == records


def test_a_cut_archive_is_an_error():
    record = m.record(1, None, b"x" * 1000, "00" * 32, None)
    with pytest.raises(ValueError, match="within a record"):
        list(m.split_records([record[:500]]))


def test_a_stream_that_is_cut_between_records_is_an_error():
    record = m.record(1, None, b"x" * 1000, "00" * 32, None)
    maker = zlib.compressobj(wbits=31)
    cut = maker.compress(record) + maker.flush(zlib.Z_FULL_FLUSH)
    for stream in (cut, gzip.compress(record) + cut):
        with pytest.raises(ValueError, match="within a member"):
            list(m.split_records(m.inflate(iter([stream]))))
    assert list(m.inflate(iter([]))) == []


def test_a_changed_payload_is_seen():
    data = m.record(1, None, b"x" * 10, hashlib.sha256(b"x" * 10).hexdigest(), None)
    assert m.parse(data)[-1] is True
    assert m.parse(data.replace(b"xxxx", b"xyxx"))[-1] is False
