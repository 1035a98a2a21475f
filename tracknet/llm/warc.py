"""WARC archives as seekable Zstandard bundles.

Pages become WARC records (``response``, or ``revisit`` for a payload that
another record holds). Each task writes its rows as bundles: records are
grouped into frames, each an independent Zstandard frame; a bundle ends with
a seek table in a skippable frame (compressed and plain size of each frame).
An index maps record identifiers to bundle, frame and the place in the
unpacked frame, so one record is read by unpacking one frame.

Files go to the shared folder through ``pyarrow.fs``. A file's name is drawn
when it is opened and is only known to the index rows of the attempt that
wrote it; as Spark commits the rows of one attempt per task, a lost executor
or a repeated task leaves an unused file, never a wrong or missing record.

Defined results: a null html is an empty payload. Of records with equal
payloads of at least ``min_payload`` bytes, those with the smallest id are
responses and the others revisit it; null ids come last. Repeated rows are
records of their own. Extra columns are not read. An empty table writes nothing.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracknet.llm import words as W
from tracknet.plans.iterate import cut
from tracknet.plans.session import scratch_path

FRAME_BYTES = 1 << 18        # plain bytes from which a frame is closed
BUNDLE_BYTES = 1 << 28       # plain bytes from which a bundle is closed
LEVEL = 3
#: Of the seekable format: magic number of the skippable frame and of the seek table's footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"     # the pages have no crawl time
INDEX = "page_id bigint, bundle string, frame int, at bigint, length bigint"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a URI or a local path."""
    if "://" not in path:
        path = "file:///" + re.sub(r"^(file:)?/*", "", path)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit keeps the response's headers but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.insert(4, "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at a place, and where it ends."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} has no end")
    return headers, data[start:stop], stop + 4


class BundleWriter:
    """A seekable bundle; ``add`` says where a record will be found."""

    def __init__(self, files: fs.FileSystem, path: str):
        self.out = files.open_output_stream(path, compression=None)
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size = self.total = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        place = (len(self.frames), self.size, len(record))
        self.held.append(record)
        self.size += len(record)
        self.total += len(record)
        if self.size >= FRAME_BYTES:
            self._close_frame()
        return place

    def _close_frame(self) -> None:
        if not self.held:
            return
        plain = b"".join(self.held)
        packed = self.pack.compress(plain)
        self.out.write(packed)
        self.frames.append((len(packed), len(plain)))
        self.held, self.size = [], 0

    def close(self) -> None:
        self._close_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Frames of a bundle by number, found through the seek table at its end."""

    def __init__(self, files: fs.FileSystem, path: str):
        self.file = files.open_input_file(path)
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        table = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.frames, at = [], 0
        for k in range(count):
            packed, plain = struct.unpack_from("<II", table, 8 * k)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=plain)

    def record(self, frame: int, at: int) -> tuple[dict[str, str], bytes]:
        return parse_record(self.frame(frame), at)[:2]


def plan_records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_payload: int = 0) -> DataFrame:
    """``(page_id, url, html, sha1, low, revisit)``: ``low`` is the smallest id
    with an equal payload. Ids meet by digest with a pre-aggregated ``min``;
    a payload many pages share is split by the join's skew handling."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    p = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
                     F.sha1(html.cast("binary")).alias("sha1"), F.octet_length(html).alias("size"))
    low = p.groupBy("sha1", "size").agg(F.min("page_id").alias("low"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    out = p.join(low, ["sha1", "size"], "left")
    revisit = F.col("low").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("low")) & (F.col("size") >= min_payload)
    return out.select("page_id", "url", "html", "sha1", "low", revisit.alias("revisit"))


def write_bundles(records: DataFrame, folder: str) -> DataFrame:
    """Writes planned records under ``folder`` and gives the index, which has been written too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        writer, name, rows = None, "", []
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]

        def placed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                              ["page_id", "bundle", "frame", "at", "length"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("page_id", "url", "sha1", "low", "revisit")]
            for page_id, url, sha1, low, revisit, raw in zip(*cols, W.text_bytes(batch.column("html")), strict=True):
                if writer is None:
                    files.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(files, f"{root}/{name}")
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                rows.append((page_id, name, *writer.add(make_record(page_id, url, raw.tobytes(), digest, low, revisit))))
                if writer.total >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
                    yield placed()
                    rows = []
        if writer is not None:
            writer.close()
            yield placed()

    return cut(records.mapInArrow(run, INDEX))


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """``(page_id, url, record_type, refers_to, payload_digest, payload_bytes,
    payload)`` of every record of the bundles in the index, read frame by
    frame; a revisit's payload is null. Each record must stand where the index says."""
    # a task for each bundle: the index's rows are small, the bundles behind them are not
    tasks = max(1, index.select("bundle").distinct().count())
    bundles = index.groupBy("bundle").agg(F.collect_list(F.struct("frame", "at", "length", "page_id")).alias("places")).repartition(tasks, "bundle")

    def number(urn: str | None) -> int | None:
        found = re.fullmatch(r"<urn:x-page:(-?\d+)>", urn or "")
        return int(found[1]) if found else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        for batch in batches:
            for name, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = BundleReader(files, f"{root}/{name}")
                expected = {(p["frame"], p["at"]): p for p in places}
                for k in range(len(reader.frames)):
                    data, at, out = reader.frame(k), 0, []
                    while at < len(data):
                        headers, block, end = parse_record(data, at)
                        want = expected.pop((k, at))
                        page_id = number(headers["WARC-Record-ID"])
                        if (want["page_id"], want["length"]) != (page_id, end - at):
                            raise ValueError(f"{name}: frame {k} at {at} is not what the index says")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest, full = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"] == "response"
                        if full and (len(payload) != size or base32_sha1(payload) != digest):
                            raise ValueError(f"{name}: payload of {page_id} is damaged")
                        out.append((page_id, headers.get("WARC-Target-URI"), headers["WARC-Type"], number(headers.get("WARC-Refers-To")), digest, size,
                                    payload.decode() if full else None))
                        at = end
                    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                                     ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"])
                if expected:
                    raise ValueError(f"{name}: {len(expected)} records of the index are missing")

    return bundles.mapInArrow(run, "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload string")


def archive_pages(pages: DataFrame, *, folder: str | None = None, min_payload: int = 0, **columns: str) -> tuple[str, DataFrame]:
    """Writes all pages; the bundles' folder and the index."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return folder, write_bundles(plan_records(pages, min_payload=min_payload, **columns), folder)
