"""WARC archives as seekable Zstandard bundles, and an index into them.

A record is written for each page: a response, or a revisit if an equal payload is kept elsewhere. Records are
grouped into frames that are compressed on their own; a bundle is frames and, as a skippable frame at its end, a
seek table of their sizes (the public seekable format). The index maps a record to its bundle, frame and offset in
the frame, so one record costs one read of the footer and one of a frame.

Tasks write to files of their own names in a shared folder and the index is what they return, so what a lost or
repeated task has written is never read. Any store that Arrow's file systems reach will do.

Defined results: a null page has an empty payload; among rows of equal payload and equal largest id, each is a
response; a null id counts as the smallest, and if all ids of a payload are null, all are responses; an empty
table gives no bundle; extra columns are ignored, whatever their names. A record is named by its page id, so names
are as unique as page ids are: where a table repeats ids, number its pages first, as the format forbids equal names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, scratch, staged

SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:loom:page:{'' if page_id is None else page_id}>"


def page_of(text: str) -> str | None:
    return text.rpartition(":")[2].rstrip(">") or None


def one_line(text: str) -> str:
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def plain(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id, url: str | None, payload: bytes, refers_to: str | None, is_revisit: bool) -> bytes:
    http = END.join((b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload), b"", b""))
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {one_line(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest_of(payload)}")
    if is_revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + END + END


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of the record at the start of data."""
    end = data.index(b"\r\n\r\n")
    first, *lines = data[:end].decode("utf-8", "surrogatepass").split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a record: {first[:40]!r}")
    warc = dict(line.split(": ", 1) for line in lines)
    block = data[end + 4 : end + 4 + int(warc["Content-Length"])]
    cut = block.index(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in block[:cut].decode().split("\r\n")[1:])
    return warc, http, block[cut + 4 :]


class Bundle:
    """Writes records into frames; place() is where the next record goes."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        self.sink, self.frame_bytes, self.zstd = sink, frame_bytes, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.written = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """The frame and the offset in it."""
        place = (len(self.sizes), self.filled)
        self.open.append(data)
        self.filled += len(data)
        if self.filled >= self.frame_bytes:
            self.end_frame()
        return place

    def end_frame(self) -> None:
        if self.open:
            packed = self.zstd.compress(b"".join(self.open))
            self.sink.write(packed)
            self.sizes.append((len(packed), self.filled))
            self.written += len(packed)
            self.open, self.filled = [], 0

    def close(self) -> None:
        self.end_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.sink.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame, from the footer of a random-access file."""
    size = source.size()
    source.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    source.seek(size - 9 - 8 * n)
    out, at = [], 0
    for packed, plain_size in struct.iter_unpack("<II", source.read(8 * n)):
        out.append((at, packed, plain_size))
        at += packed
    return out


def read_frame(source, table: list[tuple[int, int, int]], frame: int) -> bytes:
    import zstandard

    offset, packed, size = table[frame]
    source.seek(offset)
    return zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=max(1, size))


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


INDEX = "file string, frame int, offset long, bytes long"


def write_bundles(pages: DataFrame, folder: str, min_payload: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes bundles into folder and returns the index: id, file, frame, offset, bytes. Payloads that occur once are
    not shuffled for the comparison; only (id, digest) of all pages is."""
    spark = pages.sparkSession
    id_type = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(column(id_col).alias("id"), column(url_col).cast("string").alias("url"), F.coalesce(column(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.when(F.octet_length("html") >= min_payload, F.sha1(F.encode("html", "utf-8"))))
    kept = rows.filter("sha IS NOT NULL").groupBy("sha").agg(F.max("id").alias("kept"), F.count("*").alias("n")).filter("n > 1 AND kept IS NOT NULL").select("sha", "kept")
    rows = rows.join(kept, "sha", "left").select("id", "url", "html", F.when(F.col("kept").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept")), F.col("kept")).alias("refers_to"))

    def run(batches):
        store, base = file_system(folder)
        store.create_dir(base, recursive=True)
        bundle = name = None
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [])
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bundle is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    bundle = Bundle(store.open_output_stream(f"{base}/{name}", compression=None), frame_bytes)
                data = record(page_id, url, html.encode("utf-8", "surrogatepass"), refers_to, refers_to is not None)
                frame, offset = bundle.add(data)
                for c, v in zip(columns, (name, frame, offset, len(data)), strict=True):
                    c.append(v)
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    bundle = None
            name_, frame_, offset_, bytes_ = columns
            yield pa.record_batch([batch.column(0), pa.array(name_), pa.array(frame_, pa.int32()), pa.array(offset_, pa.int64()), pa.array(bytes_, pa.int64())], ["id", "file", "frame", "offset", "bytes"])
        if bundle is not None:
            bundle.close()

    return staged(rows.mapInArrow(run, f"id {id_type}, {INDEX}"), "warc-index")


def read_bundles(spark: SparkSession, index: DataFrame, folder: str) -> DataFrame:
    """A row for each record of the index, read from its frame: page_id as string, url, record_type, refers_to as
    string, digest, payload_bytes and, for responses, the payload, whose digest is checked. A group of rows is one
    frame; a task opens each bundle once."""
    frames = index.repartition("file").groupBy("file", "frame").agg(F.array_sort(F.collect_list("offset")).alias("offsets"))

    def run(batches):
        store, base = file_system(folder)
        name, source, table = None, None, []
        for batch in batches:
            for file, frame, offsets in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, store.open_input_file(f"{base}/{file}")
                    table = seek_table(source)
                data = read_frame(source, table, frame)
                columns: list[list] = [[] for _ in range(7)]
                for offset, end in zip(offsets, [*offsets[1:], len(data)], strict=True):
                    warc, http, payload = parse(data[offset:end])
                    digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = warc["WARC-Type"] == "response"
                    if response and (digest_of(payload) != digest or len(payload) != int(http["Content-Length"])):
                        raise ValueError(f"payload of {warc['WARC-Record-ID']} does not fit its digest")
                    url = warc.get("WARC-Target-URI")
                    refers = warc.get("WARC-Refers-To")
                    for c, v in zip(columns, (page_of(warc["WARC-Record-ID"]), plain(url) if url is not None else None, warc["WARC-Type"], page_of(refers) if refers else None, digest, int(http["Content-Length"]), payload if response else None), strict=True):
                        c.append(v)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (*[pa.string()] * 5, pa.int64(), pa.binary()), strict=True)], ["page_id", "url", "record_type", "refers_to", "digest", "payload_bytes", "payload"])
        if source is not None:
            source.close()

    return frames.sortWithinPartitions("file", "frame").mapInArrow(run, "page_id string, url string, record_type string, refers_to string, digest string, payload_bytes long, payload binary")


def archive(pages: DataFrame, folder: str | None = None, min_payload: int = 0, id_col: str = "page_id") -> DataFrame:
    """Writes the archives, reads them back and returns what they say of each page."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    id_type = pages.schema[id_col].dataType.simpleString()
    back = read_bundles(spark, write_bundles(pages, folder, min_payload, id_col), folder)
    return back.select(F.col("page_id").cast(id_type).alias(id_col), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", F.col("refers_to").cast(id_type).alias("refers_to"), "url")
