"""WARC archives of pages: parallel writer, and a reader that splits compressed files at byte ranges.

Writing: one gzip member per record, one or more files per task. A page whose payload (at least ``LEAST_BYTES`` long)
equals that of a page with a larger id is written as a revisit of the one with the largest id, without the payload. Files
carry random names and count only if the task that wrote them succeeded: the manifest names them, so a retried task
leaves no double records.

Reading: the files of the manifest are cut into byte ranges. A task looks for the gzip magic from the start of its range,
takes a candidate only if its first bytes inflate to a WARC header, and owns the records that start inside the range; it
reads past the end to finish its last one. After garbage it searches on.

Defined cases: null html is an empty payload; a null url is left out of the record and read as null; a null page_id is
read back as null and is smaller than any other; rows that repeat a page_id with the same payload are of the same type; an
empty table gives no records; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premisa.llm.common import ready, written
from premisa.session import scratch_path

LEAST_BYTES = 1000
FILE_BYTES = 1 << 30
SPLIT_BYTES = 8 << 20
CHUNK = 1 << 16
MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:premisa:page:"

RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "path string, member_offset long"
)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    name = lambda x: f"<{ID}{'none' if x is None else x}>"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    block = http + (payload if refers_to is None else b"")
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(data) + packer.flush()


def _opened(location: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(location)


def write_archives(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write every page; the stored manifest of the files: path, bytes, records."""
    ready(pages.sparkSession)
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    data = F.encode("html", "utf-8")
    rows = rows.withColumn("digest", F.when(F.length(data) >= LEAST_BYTES, F.sha1(data)))
    # one row per payload that occurs again; the partial counts keep a hot payload to a row per task
    again = rows.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    again = again.where("n > 1").select("digest", "first")
    marked = rows.join(again, "digest", "left").select(
        "page_id", "url", "html", F.expr("if(page_id <=> first, null, first)").alias("refers_to")
    )

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _opened(folder)
        fs.create_dir(base, recursive=True)
        done, out, size, records, name = [], None, 0, 0, ""
        for frame in frames:
            columns = (frame[c].astype(object).where(frame[c].notna(), None) for c in ("page_id", "url", "html", "refers_to"))
            for page_id, url, html, refers in zip(*columns, strict=True):
                if out is None:
                    name, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                whole = lambda x: None if x is None else int(x)
                member = record(whole(page_id), url, html.encode(), whole(refers))
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", size, records))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, records))
        yield pd.DataFrame(done, columns=["path", "bytes", "records"])

    return written(marked.mapInPandas(write, "path string, bytes long, records long"), "warc-manifest")


class _Source:
    """Bytes of a file from a place on, read in chunks."""

    def __init__(self, file, at: int):
        self.file, self.at, self.held = file, at, b""
        file.seek(at)

    def more(self) -> bool:
        data = self.file.read(CHUNK)
        self.held += data
        return bool(data)

    def skip(self, n: int) -> None:
        self.held = self.held[n:]
        self.at += n


def _looks_like_record(data: bytes) -> bool:
    try:
        return zlib.decompressobj(31).decompress(data, 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def members(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, inflated bytes) of the members that begin in [start, end)."""
    source = _Source(file, start)
    while source.at < end:
        while (found := source.held.find(MAGIC)) < 0 or len(source.held) < found + 256:
            if found < 0:
                source.skip(max(0, len(source.held) - 2))  # the magic may straddle chunks
            else:
                source.skip(found)
                found = 0
            if source.at >= end or not source.more():
                break
        found = source.held.find(MAGIC)
        if found < 0 or source.at + found >= end:
            return
        source.skip(found)
        if not _looks_like_record(source.held):
            source.skip(1)
            continue
        place, unpacker, parts, used = source.at, zlib.decompressobj(31), [], 0
        try:
            while not unpacker.eof:
                if not source.held and not source.more():
                    break
                parts.append(unpacker.decompress(source.held))
                used += len(source.held) - len(unpacker.unused_data)
                source.skip(len(source.held) - len(unpacker.unused_data))
        except zlib.error:
            unpacker = None
        if unpacker is None or not unpacker.eof:  # only looked like a member: search on behind its first byte
            source = _Source(file, place + 1)
            continue
        yield place, b"".join(parts)


def parsed(data: bytes) -> tuple[int | None, str | None, int, str, str, int | None, bytes]:
    """page_id, url, payload bytes and digest, type, refers_to, payload of an inflated record; raises on damage."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    whole = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    number = lambda x: None if x is None or "none" in x else int(x.removeprefix(f"<{ID}").rstrip(">"))
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != whole or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return (number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), whole, digest, kind,
            number(fields.get("WARC-Refers-To")), payload)


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = False) -> DataFrame:
    """One row per record of the files in ``manifest`` (path, bytes); with the payload if wanted."""
    ready(manifest.sparkSession)
    splits = manifest.where("bytes > 0").select(
        "path", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("first")
    )
    tasks = int(manifest.agg(F.sum(F.expr(f"bytes div {split_bytes} + 1"))).first()[0] or 1)
    splits = splits.repartition(tasks, "path", "first")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORD.split(", ")] + ["payload"] * payloads
        for frame in frames:
            for path, first in zip(frame["path"], frame["first"], strict=True):
                fs, place = _opened(path)
                rows, held = [], 0
                with fs.open_input_file(place) as file:
                    for at, data in members(file, int(first), int(first) + split_bytes):
                        *row, payload = parsed(data)
                        rows.append((*row, path, at, *[payload] * payloads))
                        held += len(payload) * payloads + 200
                        if held > 32 << 20:
                            yield _frame(rows, names)
                            rows, held = [], 0
                yield _frame(rows, names)

    return splits.mapInPandas(read, RECORD + ", payload binary" * payloads)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    made = pd.DataFrame(rows, columns=names, dtype=object)
    for c in ("page_id", "refers_to", "payload_bytes", "member_offset"):
        made[c] = made[c].astype("Int64")
    return made


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives and read them back."""
    return read_archives(write_archives(pages))
