"""Archives: round trips, dictionaries, revisits and odd rows."""

import io
import struct

import pytest
import zstandard

from tillwise.llm import warc

PAGES = "page_id long, url string, html string"
BIG = "<p>" + "lorem ipsum " * 120 + "</p>"


def archive(records, sample=1 << 20):
    out = io.BytesIO()
    out.close = lambda: None
    writer = warc.ArchiveWriter(out, "2024-01-01T00:00:00Z", sample=sample)
    for item in records:
        writer.add(item)
    writer.close()
    return writer, out.getvalue()


def many(n):
    return [warc.record(i, f"http://h/{i}", f"<html><title>page {i}</title>{BIG}{i * 7}</html>".encode(), None, "d") for i in range(n)]


@pytest.mark.parametrize("sample", [1, 3000, 1 << 20])
def test_archive_round_trip(sample):
    items = many(300)
    writer, data = archive(items, sample)
    back = list(warc.read_records(io.BytesIO(data)))
    assert [f["WARC-Type"] for f, _ in back] == ["warcinfo"] + ["response"] * 300
    assert [warc.page_of(*x)[0] for x in back[1:]] == list(range(300))
    assert [warc._block({k: v for k, v in f.items() if k != "Content-Length"}, b) for f, b in back[1:]] == items
    assert (writer.records, writer.bytes) == (300, len(data))


def test_dictionary_leads_and_every_record_is_a_frame_of_its_own():
    items = many(300)
    writer, data = archive(items)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and size == writer.dictionary_bytes > 0
    held = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    assert held.dict_id()
    left, found = data[8 + size :], []
    while left:
        one = zstandard.ZstdDecompressor(dict_data=held).decompressobj()
        found.append(one.decompress(left))
        left = one.unused_data
    assert found[1:] == items
    alone = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(x)) for x in items)
    assert len(data) < alone / 2


def test_few_records_have_no_dictionary():
    writer, data = archive(many(1))
    assert writer.dictionary_bytes == 0 and data[:4] == zstandard.FRAME_HEADER
    assert len(list(warc.read_records(io.BytesIO(data)))) == 2


def test_damage_is_noticed():
    item = warc.record(1, "u", b"payload", None, "d").replace(b"payload", b"paymoad")
    fields, body = list(warc.read_records(io.BytesIO(archive([item])[1])))[1]
    with pytest.raises(ValueError, match="digest"):
        warc.page_of(fields, body)


def plain(rows):
    """The contract, row by row."""
    import hashlib

    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        revisit = len(data) >= 1000 and same and page != max(same)
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=repr)


def test_odd_rows(spark):
    rows = [
        (1, "http://a/", BIG), (9, None, BIG), (3, "http://a/b c\r\nX: y", BIG), (9, None, BIG), (None, "u", BIG),
        (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (None, None, None),
        (8, "é", "ß漢" * 400), (2, "é", "ß漢" * 400), (-5, "n", "x" * 999), (-4, "n", "x" * 999),
        (10, "long", "y" * 3_000_000), (None, "o", "z" * 1200), (None, "o", "z" * 1200), (11, "r", "\r\n\r\nWARC/1.1\r\n" * 90),
    ]
    docs = spark.createDataFrame([(*r, "x", 1, b"") for r in rows], PAGES + ", path string, refers_to int, _hash binary")
    got = warc.read(warc.write(docs, sample=2000, archive_bytes=4000))
    cut = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in cut.collect()), key=repr) == plain(rows)
    texts = {(r.page_id, bytes(r.payload).decode()) for r in got.where("payload IS NOT NULL").collect()}
    assert texts == {(p, h or "") for (p, _, h) in rows if not (h == BIG and p != 9) and (p, h) != (2, "ß漢" * 400)}
    assert {r.url for r in got.where("page_id = 3").collect()} == {"http://a/b%20c%0D%0AX:%20y"}
    assert warc.read(warc.write(docs.limit(0))).count() == 0


def test_tasks_write_several_archives(spark):
    rows = [(i, f"http://h/{i}", f"{BIG}{i % 40}") for i in range(400)]
    archives = warc.write(spark.createDataFrame(rows, PAGES).repartition(3), archive_bytes=20_000).collect()
    assert len(archives) > 3 and sum(a.records for a in archives) == 400
    assert len({a.path for a in archives}) == len(archives)
