"""WARC archives whose records are compressed one by one with a dictionary in the leading frame."""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from datetime import UTC, datetime
from functools import cache
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhours.sources.scratch import materialise, run_folder

DICTIONARY_MAGIC = 0x184D2A5D  # the skippable frame that holds a dictionary
LEVEL = 3
CHUNK = 64 << 10  # bytes of an archive that are decompressed at a time
RECORD_PREFIX = "urn:page:"
URI_SAFE = "%/:=&?~#+!$,;'@()*[]"  # characters of an address that stay as they are
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, records bigint, archive_bytes bigint, content_bytes bigint"
RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, archive string, record bigint"
)


def _header(lines: dict[str, str], first: str) -> bytes:
    rows = "".join(f"{name}: {value}\r\n" for name, value in lines.items())
    return f"{first}\r\n{rows}\r\n".encode()


def _identifier(page_id: int | None, digest: str) -> str:
    return f"<{RECORD_PREFIX}{'' if page_id is None else page_id}:sha256:{digest}>"


def record(
    page_id: int | None, url: str | None, size: int, digest: str, payload: bytes | None,
    refers_to: int | None, date: str,
) -> bytes:
    """One WARC record; without a payload it is a revisit of equal content.

    The block of either is an HTTP answer, that of a revisit its head alone, whose length still
    tells the size of the payload.
    """
    block = _header(
        {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(size)},
        "HTTP/1.1 200 OK",
    ) + (payload or b"")
    lines = {"WARC-Type": "revisit" if payload is None else "response"}
    if url is not None:
        lines["WARC-Target-URI"] = quote(url, safe=URI_SAFE)
    lines |= {
        "WARC-Date": date,
        "WARC-Record-ID": _identifier(page_id, digest),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if payload is None:
        lines["WARC-Profile"] = REVISIT_PROFILE
        lines["WARC-Refers-To"] = _identifier(refers_to, digest)
    lines["Content-Length"] = str(len(block))
    return _header(lines, "WARC/1.1") + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def _named_page(identifier: str) -> int | None:
    name = identifier.removeprefix(f"<{RECORD_PREFIX}").split(":")[0]
    return int(name) if name else None


def parse_record(data: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to; checks the digest."""
    head_end = data.index(b"\r\n\r\n") + 4
    head = _fields(data[:head_end])
    block = data[head_end : head_end + int(head["Content-Length"])]
    body_at = block.index(b"\r\n\r\n") + 4
    size = int(_fields(block[:body_at])["Content-Length"])
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    if head["WARC-Type"] == "response":
        payload = block[body_at:]
        found = hashlib.sha256(payload).hexdigest()
        if (found, len(payload)) != (digest, size):
            raise ValueError(f"record {head['WARC-Record-ID']} is damaged")
        refers_to = None
    else:
        refers_to = _named_page(head["WARC-Refers-To"])
    return (
        _named_page(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), size, digest,
        head["WARC-Type"], refers_to,
    )


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A Zstandard dictionary of the samples; empty if they are too few to train one."""
    try:
        return zstandard.train_dictionary(size, samples, k=1024, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


@cache
def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    if not data:
        return None
    found = zstandard.ZstdCompressionDict(data)
    found.precompute_compress(level=LEVEL)
    return found


def leading_frame(dictionary: bytes) -> bytes:
    """The skippable frame with the dictionary, itself compressed."""
    if not dictionary:
        return b""
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body


def read_frames(source) -> Iterator[bytes]:  # noqa: ANN001 - any binary file object
    """The content of each frame of an archive, by the dictionary in its leading frame."""
    head = source.read(8)
    dictionary = None
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_MAGIC:
        body = source.read(struct.unpack("<I", head[4:])[0])
        if body[:4] == b"\x28\xb5\x2f\xfd":
            body = zstandard.ZstdDecompressor().decompress(body)
        dictionary = zstandard.ZstdCompressionDict(body)
        head = b""
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    rest = head
    while rest or (rest := source.read(CHUNK)):
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(rest))
            rest = frame.unused_data
            if frame.eof:
                break
            rest = source.read(CHUNK)
            if not rest:
                raise ValueError("an archive ends within a record")
        yield b"".join(parts)


def _open_folder(path: str):  # noqa: ANN202 - a file system and the path in it
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def _archive_rows(
    rows: DataFrame, folder: str, dictionary: bytes, archive_bytes: int, date: str
) -> DataFrame:
    """Write the records of every partition to archives of its own; a manifest row for each.

    A file's name holds the task attempt: what a lost or doubled attempt left is in no manifest.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, root = _open_folder(folder)
        system.create_dir(root, recursive=True)
        known = _dictionary(dictionary)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        opening = leading_frame(dictionary)
        out, path, made, records, written, content = None, "", 0, 0, 0, 0
        done: list[tuple[str, int, int, int]] = []
        for part in parts:
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                data = record(*row, date)
                if out is None:
                    name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{made}"
                    path = f"{root}/{name}.warc.zst"
                    made, records, content, written = made + 1, 0, 0, len(opening)
                    out = system.open_output_stream(path, compression=None)
                    out.write(opening)
                frame = packer.compress(data)
                out.write(frame)
                records, written, content = records + 1, written + len(frame), content + len(data)
                if written >= archive_bytes:
                    out.close()
                    out = None
                    done.append((path, records, written, content))
        if out is not None:
            out.close()
            done.append((path, records, written, content))
        columns = [pa.array([d[0] for d in done], pa.string())]
        columns += [pa.array([d[i] for d in done], pa.int64()) for i in (1, 2, 3)]
        yield pa.RecordBatch.from_arrays(
            columns, ["path", "records", "archive_bytes", "content_bytes"]
        )

    return rows.select(
        "page_id", "url", "payload_bytes", "digest", "payload", "refers_to"
    ).mapInArrow(batches, MANIFEST)


def read_archives(manifest: DataFrame, folder: str, task_bytes: int = 32 << 20) -> DataFrame:
    """All records of the archives of a manifest, decoded anew from the files."""
    total, files = manifest.agg(F.sum("content_bytes"), F.count(F.lit(1))).first()
    tasks = max(1, min(files, math.ceil((total or 0) / task_bytes)))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _open_folder(folder)
        for part in parts:
            for path in part.column(0).to_pylist():
                with system.open_input_stream(path, compression=None) as source:
                    rows: list[tuple] = []
                    for number, data in enumerate(read_frames(source)):
                        rows.append((*parse_record(data), path, number))
                        if len(rows) == 5000:
                            yield _record_batch(rows)
                            rows = []
                    yield _record_batch(rows)

    return manifest.select("path").repartition(tasks).mapInArrow(batches, RECORDS)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(field.split(" ") for field in RECORDS.split(", ")), strict=True)
    types = {"bigint": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], types[k]) for i, k in enumerate(kinds)], list(names)
    )


def sample_payloads(rows: DataFrame, total_bytes: int, most_bytes: int) -> list[bytes]:
    """About `most_bytes` of whole payloads of at most 64 KB, picked by the hash of their row."""
    share = math.ceil(min(1.0, most_bytes / max(1, total_bytes)) * 1_000_000)
    draw = F.pmod(F.xxhash64("page_id", "url", F.lit("dictionary")), F.lit(1_000_000))
    picked = rows.where((draw < share) & F.octet_length("payload").between(1, 64 << 10))
    found = picked.select("payload").limit(most_bytes // 256).collect()  # tiny ones need no more
    return sorted({bytes(r.payload) for r in found})


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_revisit: int = 100,
    archive_bytes: int = 256 << 20,
    dictionary_bytes: int = 64 << 10,
    sample_bytes: int = 4 << 20,
) -> DataFrame:
    """Write a record per row of `pages` to archives in `folder`; returns the manifest.

    Of rows with equal payloads of `least_revisit` bytes or more, the one with the smallest
    `page_id` (NULL after all others, then the smallest URL) is a response, the others revisit
    it: their records hold no payload. All smaller ones are responses. A NULL `html` is an empty
    payload. Of several rows equal in id, URL and payload one is the response, and all have one
    record id. Addresses are percent-encoded where a URI has to be. Other columns are not read;
    an empty table makes no archive.

    The dictionary is trained on about `sample_bytes` of payloads, picked by hash from the whole
    table, and stands in the leading skippable frame of every archive. A table too small to train
    one has archives without. `folder` has to be one that all executors reach by pyarrow.
    """
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    sized = rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    known = sized.withColumn("digest", F.sha2("payload", 256))
    counted = materialise(
        known.groupBy("digest", "payload_bytes", "page_id", "url").agg(
            F.count(F.lit(1)).alias("n")
        ),
        "warc-counted",
    )
    first = F.min(F.struct(F.isnull("page_id").alias("no_id"), "page_id", "url", "n")).alias("h")
    heads = (
        counted.where(F.col("payload_bytes") >= least_revisit)
        .groupBy("digest", "payload_bytes")
        .agg(first, F.sum("n").alias("total"))
        .where("total > 1")
        .selectExpr(
            "digest AS d", "payload_bytes AS size", "h.page_id AS head_id", "h.url AS head_url",
            "h.n AS same",
        )
    )
    heads = materialise(heads, "warc-heads")
    total = counted.agg(F.sum(F.expr("payload_bytes * n"))).first()[0] or 0
    dictionary = train_dictionary(sample_payloads(rows, total, sample_bytes), dictionary_bytes)
    joined = known.join(heads, F.col("digest") == F.col("d"), "left").withColumn(
        "is_head", F.expr("page_id <=> head_id AND url <=> head_url")
    )
    copy = "d IS NOT NULL AND NOT is_head"
    written = joined.where("d IS NULL OR NOT is_head OR same = 1").selectExpr(
        "page_id", "url", "payload_bytes", "digest",
        f"if({copy}, NULL, payload) AS payload", f"if({copy}, head_id, NULL) AS refers_to",
    )
    several = heads.where("same > 1")
    if not several.isEmpty():  # rows alike in all they archive: one response, and revisits of it
        one = (
            joined.where("is_head AND same > 1")
            .groupBy("page_id", "url", "payload_bytes", "digest")
            .agg(F.any_value("payload").alias("payload"))
        )
        again = several.withColumn("nth", F.explode(F.expr("sequence(2L, same)")))
        written = written.unionAll(
            one.selectExpr(*one.columns, "CAST(NULL AS bigint)")
        ).unionAll(
            again.selectExpr("head_id", "head_url", "size", "d", "CAST(NULL AS binary)", "head_id")
        )
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    return materialise(
        _archive_rows(written, folder, dictionary, archive_bytes, date), "warc-manifest"
    )


def archive_and_read(pages: DataFrame, folder: str | None = None, **options: object) -> DataFrame:
    """Archive all pages, then decode the archives: a row per record, with its place.

    Columns: page_id, url, payload_bytes, payload_digest (SHA-256), record_type, refers_to,
    archive, record (its number in the archive). Sizes and digests of responses are those of the
    decoded payloads, checked against their headers. Without `folder` the archives go to a fresh
    one in the session's shared folder.
    """
    folder = folder or run_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **options), folder)
