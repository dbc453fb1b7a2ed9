import hashlib
import io
import random
import struct

import pytest
import zstandard

from cellhours.llm.queries import op12_warc
from cellhours.llm.warc import (
    DICTIONARY_MAGIC,
    archive_and_read,
    leading_frame,
    parse_record,
    read_archives,
    read_frames,
    record,
    train_dictionary,
    write_archives,
)
from tests.llm.helpers import HAVE_TABLES, SF

PAGES = "page_id bigint, url string, html string"
SIZE_OF_BLOCK = 100


def plain(rows):
    """(id, bytes, digest, type, refers) of each row, with the least id of equal payloads first."""
    payloads = [(r[2] or "").encode() for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] or ""))
    head, out = {}, []
    for i in order:
        data, digest = payloads[i], hashlib.sha256(payloads[i]).hexdigest()
        if len(data) < SIZE_OF_BLOCK or digest not in head:
            head.setdefault(digest, rows[i][0])
            out.append((rows[i][0], len(data), digest, "response", None))
        else:
            out.append((rows[i][0], len(data), digest, "revisit", head[digest]))
    return out


def found(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
def test_query_equals_the_plain_table(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    want = plain([(r.page_id, r.url, r.html) for r in rows])
    assert found(op12_warc(spark, SF)) == sorted(want, key=repr)


ROWS = [
    (5, "http://a.example/x y", "e" * 99), (6, "http://a.example/", "e" * 99),
    (9, None, "f" * 100), (8, "http://ü.example/\r\n", "f" * 100), (7, "u", "f" * 100),
    (1, "u", None), (2, "u", ""), (3, "u", None),
    (None, "u", "g" * 200), (None, "v", "g" * 200), (None, "u", "h" * 300), (11, "u", "h" * 300),
    (20, "u", "same" * 50), (20, "u", "same" * 50), (20, "u", "same" * 50), (21, "u", "same" * 50),
    (22, "u", "same" * 50), (30, "u", "é🙂\r\n\r\n\x00 WARC/1.1\r\n" * 40), (31, "u", "long " * 200_000),
    (40, "u", "tiny"), (40, "u", "tiny"),
]


def test_copies_ties_and_odd_pages(spark):
    pages = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "1 AS payload", "'x' AS digest")
    assert found(archive_and_read(pages)) == sorted(plain(ROWS), key=repr)
    assert archive_and_read(pages.limit(0)).count() == 0


def test_archives_hold_what_the_manifest_says(spark, tmp_path):
    pick = random.Random(2)
    words = [f"<p class='w{i}'>text {i}</p>" for i in range(400)]
    rows = [(i, f"http://h{i % 9}.example/{i}", " ".join(pick.choices(words, k=60))) for i in range(400)]
    folder = str(tmp_path / "archives")
    manifest = write_archives(spark.createDataFrame(rows, PAGES), folder, archive_bytes=20_000)
    files = manifest.collect()
    assert len(files) > 8 and sum(f.records for f in files) == 400
    for f in files:
        with open(f.path, "rb") as source:
            data = source.read()
        assert len(data) == f.archive_bytes
        assert struct.unpack("<I", data[:4])[0] == DICTIONARY_MAGIC
        frames = list(read_frames(io.BytesIO(data)))
        assert len(frames) == f.records and sum(map(len, frames)) == f.content_bytes
        with pytest.raises(zstandard.ZstdError):  # no frame can be read without the dictionary
            size = struct.unpack("<I", data[4:8])[0]
            zstandard.ZstdDecompressor().decompress(data[8 + size :])
    assert found(read_archives(manifest, folder)) == sorted(plain(rows), key=repr)


def test_records_compress_better_with_the_dictionary():
    pick = random.Random(3)
    words = [f"<li><a href='/topic/{i}'>entry {i}</a></li>" for i in range(300)]
    pages = ["".join(pick.choices(words, k=20)).encode() for _ in range(600)]
    dictionary = train_dictionary(pages[:300], 16 << 10)
    frame = leading_frame(dictionary)
    assert struct.unpack("<II", frame[:8]) == (DICTIONARY_MAGIC, len(frame) - 8)
    known = zstandard.ZstdCompressionDict(dictionary)
    with_it = zstandard.ZstdCompressor(level=3, dict_data=known)
    without = zstandard.ZstdCompressor(level=3)
    sizes = [sum(len(c.compress(p)) for p in pages[300:]) for c in (with_it, without)]
    assert sizes[0] < 0.8 * sizes[1]
    assert train_dictionary([b"a"], 1 << 10) == b"" and leading_frame(b"") == b""


def test_damaged_and_cut_records_are_errors():
    payload = b"<html>" * 30
    digest = hashlib.sha256(payload).hexdigest()
    data = record(4, "http://x.example", len(payload), digest, payload, None, "2024-05-06T07:08:09Z")
    assert parse_record(data)[0] == 4
    with pytest.raises(ValueError, match="damaged"):
        parse_record(data.replace(b"<html><html>", b"<html><HTML>", 1))
    frames = zstandard.ZstdCompressor().compress(data)
    assert list(read_frames(io.BytesIO(frames + frames))) == [data, data]
    with pytest.raises(ValueError, match="within a record"):
        list(read_frames(io.BytesIO(frames + frames[:-5])))
