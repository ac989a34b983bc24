"""WARC archives as seekable Zstandard bundles.

Each task writes its records into bundles of about ``bundle_bytes``. A bundle is a
row of independent Zstandard frames of about ``frame_bytes`` of records, followed
by the seek table of the seekable format in a skippable frame, so that any frame
can be read alone. The index has one row per frame: its place in the bundle and,
for each record in it, the id, the offset within the decompressed frame and the
length.

Pages with equal payloads of at least ``min_bytes`` bytes have one response, that
with the smallest page_id; the others are revisits that refer to it. Rows that
repeat the response's own page_id are responses too. A null html is the empty
payload, a null page_id comes last and may be referred to as null. Other columns
of the table are neither read nor kept. Files of broken-off attempts stay out of
the index, as each attempt names its own file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemsync.llm.common import fresh_folder, map_rows, prepared, utf8, written

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
LEVEL = 3
#: Bytes of records that one task reads back.
READ_BYTES = 16 << 20

#: Of the seekable format (fixed values).
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"

INDEX = (
    "bundle string, frame bigint, begin bigint, size bigint, raw_size bigint,"
    " page_id array<bigint>, at array<bigint>, length array<bigint>"
)
RECORDS = (
    "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string,"
    " record_type string, refers_to bigint"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _id(uri: str) -> int | None:
    number = uri[len("<urn:page:") : -1]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has no payload but keeps its digest and length."""
    block = b"" if revisit else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_uri(page_id)}",
        f"WARC-Date: {DATE}",
        *([] if url is None else [f"WARC-Target-URI: {' '.join(url.split())}"]),
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [
            f"WARC-Refers-To: {_uri(refers_to)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}", "", ""]
    return utf8("\r\n".join(lines)) + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record as ``record`` writes them; a response's are checked against its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    payload = rest[: int(fields["Content-Length"])]
    revisit = fields["WARC-Type"] == "revisit"
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and digest_of(payload) != stated:
        raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": _id(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload": None if revisit else payload,
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": stated,
        "record_type": fields["WARC-Type"],
        "refers_to": _id(fields["WARC-Refers-To"]) if revisit else None,
    }


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle: (compressed, raw) sizes of its frames."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file) -> list[tuple[int, int, int, int]]:
    """(begin, compressed size, raw begin, raw size) of each frame of an open bundle."""
    file.seek(0, io.SEEK_END)
    end = file.tell()
    file.seek(end - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(end - 9 - 8 * n)
    table, out, at, raw_at = file.read(8 * n), [], 0, 0
    for size, raw in struct.iter_unpack("<II", table):
        out.append((at, size, raw_at, raw))
        at, raw_at = at + size, raw_at + raw
    return out


def storage(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder named by URI or by a plain path."""
    if "://" not in folder and not folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(folder)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: a plain path lies in the session's default file system, not on each machine."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


class Bundle:
    """Writes frames to one file, collecting their index rows."""

    def __init__(self, fs: pyarrow.fs.FileSystem, path: str):
        self.path, self.out = path, fs.open_output_stream(path, compression=None)
        self.frames: list[tuple[int, int]] = []
        self.rows: list[dict] = []
        self.at = 0
        self._clear()

    def _clear(self) -> None:
        self.parts, self.size = [], 0
        self.index: dict[str, list] = {"page_id": [], "at": [], "length": []}

    def add(self, page_id: int | None, data: bytes) -> None:
        for name, value in (("page_id", page_id), ("at", self.size), ("length", len(data))):
            self.index[name].append(value)
        self.parts.append(data)
        self.size += len(data)

    def flush(self) -> None:
        if self.parts:
            packed = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(b"".join(self.parts))
            place = {"bundle": self.path, "frame": len(self.frames), "begin": self.at, "size": len(packed)}
            self.rows.append(place | {"raw_size": self.size} | self.index)
            self.frames.append((len(packed), self.size))
            self.out.write(packed)
            self.at += len(packed)
            self._clear()

    def close(self) -> list[dict]:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return self.rows


def _columns(rows: list[dict]) -> dict[str, list]:
    return {name: [r[name] for r in rows] for name in rows[0]}


def resolved(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, and for pages with copies the id of the response."""
    html = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select("page_id", "url", html.alias("html")).withColumn("_digest", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= min_bytes
    order = F.struct(F.col("page_id").isNull(), "page_id")
    firsts = (
        own.where(large)
        .groupBy("_digest")
        .agg(F.min(order).getField("page_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    # stored, so that the join can split a page that very many addresses have
    firsts = written(firsts.withColumn("_copies", F.lit(True)), "firsts")
    marked = own.join(firsts, "_digest", "left")
    revisit = F.coalesce(F.col("_copies"), F.lit(False)) & large & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return marked.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("_first")).alias("_first"))


def write(
    pages: DataFrame,
    folder: str | None = None,
    min_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write all pages to bundles in ``folder`` (default: in the shared folder); returns the stored index."""
    spark = prepared(pages.sparkSession)
    target = qualified(spark, folder or fresh_folder(spark, "warc"))

    def run(batches) -> Iterator[dict]:
        fs, path = storage(target)
        fs.create_dir(path)
        bundle = None
        for batch in batches:
            for page_id, url, html, revisit, first in zip(*(batch[c] for c in ("page_id", "url", "html", "revisit", "_first"))):
                bundle = bundle or Bundle(fs, f"{path}/{uuid.uuid4().hex}.warc.zst")
                bundle.add(page_id, record(page_id, url, utf8(html), revisit, first))
                if bundle.size >= frame_bytes:
                    bundle.flush()
                    if bundle.at >= bundle_bytes:
                        yield _columns(bundle.close())
                        bundle = None
        if bundle:
            yield _columns(bundle.close())

    return written(map_rows(resolved(pages, min_bytes), run, INDEX), "warc-index")


def read(index: DataFrame, folder: str | None = None, payloads: bool = True) -> DataFrame:
    """The records of an index, each found by its frame's place and its offset in the frame.

    ``folder`` names the file system (default: that of the shared folder).
    """
    spark = prepared(index.sparkSession)
    where = qualified(spark, folder or fresh_folder(spark, "warc"))
    total = index.agg(F.sum("raw_size")).first()[0] or 0
    parts = max(1, -(-total // READ_BYTES))

    def run(batches) -> Iterator[dict]:
        fs, _ = storage(where)
        for batch in batches:
            for n, (path, frame) in enumerate(zip(batch["bundle"], batch["frame"])):
                with fs.open_input_file(path) as file:
                    begin, size, _, raw = read_seek_table(file)[frame]
                    file.seek(begin)
                    data = zstandard.ZstdDecompressor().decompress(file.read(size), max_output_size=raw)
                records = [parse(data[at : at + length]) for at, length in zip(batch["at"][n], batch["length"][n])]
                if not payloads:
                    records = [r | {"payload": None} for r in records]
                yield _columns(records)

    return map_rows(index.repartition(parts), run, RECORDS)


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages, read every record back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    records = read(write(pages, min_bytes=min_bytes), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
