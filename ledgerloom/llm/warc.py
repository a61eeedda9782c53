"""WARC archives as seekable Zstandard bundles.

Method: records are grouped into independent Zstandard frames, frames into
bundles of bounded size. A bundle ends with the seek table of the seekable
Zstandard format: a skippable frame that lists every frame's compressed and
decompressed size. A record's place is its frame and the offset inside the
decompressed frame, so one record needs one frame. An index of these places,
by record identifier, lies beside the bundles, and records are read through it.

Bundles are files that Spark writes and commits, in any file system it knows:
a bundle is a row of the text writer, one row to a file, and the "line
separator" is the four closing bytes of the seek table. They are read back
with the binaryFile source.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import pick

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = b"\xb1\xea\x92\x8f"
FOOTER = struct.Struct("<IB")  # frames, descriptor; SEEKABLE_MAGIC follows
ENTRY = struct.Struct("<II")  # compressed, decompressed size

#: Decompressed bytes at which a frame ends, and compressed bytes at which a
#: bundle does (a single longer record makes a longer frame and bundle).
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 8 << 20
#: Payloads of fewer bytes are always stored in full.
LEAST_REVISIT_BYTES = 1_000
#: A look-up whose records lie in at most so many bundles opens those alone.
MOST_NAMED = 10_000
EPOCH = "1970-01-01T00:00:00Z"


def record(kind: str, record_id: str, url: str, payload: bytes, digest: str, payload_bytes: int,
           refers_to: str | None = None, page_id: str = "") -> bytes:
    """One WARC/1.1 record with its two closing line ends."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{record_id}>", f"WARC-Date: {EPOCH}",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {payload_bytes}",
            f"X-Page-ID: {page_id}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and payload of each record of a decompressed frame, from
    offset ``at`` on. A response whose payload has another digest than it
    states is an error."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at offset {at}")
        head = dict(line.split(": ", 1) for line in lines)
        body = end + 4
        stop = body + int(head["Content-Length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at offset {at} has another length than it states")
        found = data[body:stop]
        if head["WARC-Type"] == "response" and hashlib.sha1(found).hexdigest() != head["WARC-Payload-Digest"].removeprefix("sha1:"):
            raise ValueError(f"payload of {head['WARC-Record-ID']} has another digest than it states")
        yield at, head, found
        at = stop + 4


@dataclass
class Bundle:
    """Frames of one archive, in the order they are added."""

    level: int = 3
    frames: list[bytes] = field(default_factory=list)
    sizes: list[tuple[int, int]] = field(default_factory=list)
    bytes: int = 0

    def add(self, plain: bytes) -> None:
        packed = zstandard.ZstdCompressor(level=self.level, write_checksum=True).compress(plain)
        self.frames.append(packed)
        self.sizes.append((len(packed), len(plain)))
        self.bytes += len(packed)

    def close(self) -> bytes:
        """The archive with its seek table."""
        table = b"".join(ENTRY.pack(*s) for s in self.sizes) + FOOTER.pack(len(self.sizes), 0) + SEEKABLE_MAGIC
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table


def seek_table(archive: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame, by the footer."""
    if archive[-4:] != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the archive")
    frames, descriptor = FOOTER.unpack(archive[-9:-4])
    entry = ENTRY.size + (4 if descriptor & 0x80 else 0)  # checksums, if the writer kept them
    begin = len(archive) - 9 - frames * entry
    magic, length = struct.unpack("<II", archive[begin - 8:begin])
    if magic != SKIPPABLE_MAGIC or length != frames * entry + 9:
        raise ValueError("broken seek table")
    out, offset = [], 0
    for k in range(frames):
        packed, plain = ENTRY.unpack_from(archive, begin + k * entry)
        out.append((offset, packed, plain))
        offset += packed
    return out


def read_frame(archive: bytes, offset: int, packed: int, plain: int) -> bytes:
    data = zstandard.ZstdDecompressor().decompress(archive[offset:offset + packed], max_output_size=plain or 1)
    if len(data) != plain:
        raise ValueError(f"frame at {offset} has another size than the seek table states")
    return data


def payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def with_revisits(pages: DataFrame) -> DataFrame:
    """``pages`` (id, url, html) with digest, payload_bytes and refers_to: of
    equal payloads that are long enough, all but the largest id refer to it.

    Only digests and ids meet in the grouping; the pages are then joined by
    their own id and digest, so that rows which repeat an id with other
    payloads are judged by their own. Rows with a null id are never referred
    to and never revisit.
    """
    digest, size = F.sha1(payload(F.col("html"))), F.octet_length(payload(F.col("html"))).cast("long")
    narrow = (pages.select("id", digest.alias("digest"), size.alias("payload_bytes"))
              .where((F.col("payload_bytes") >= LEAST_REVISIT_BYTES) & F.col("id").isNotNull()))
    first = (narrow.groupBy("digest").agg(F.max("id").alias("first"), F.min("id").alias("least"))
             .where("first > least").select("digest", "first"))
    revisits = narrow.join(first, "digest").where("id < first").select("id", "digest", F.col("first").alias("refers_to")).distinct()
    # the narrow side is hashed: the pages themselves are not sorted
    return pages.withColumns({"digest": digest, "payload_bytes": size}).join(revisits.hint("shuffle_hash"), ["id", "digest"], "left")


def write(pages: DataFrame, path: str, level: int = 3, id_column: str = "page_id", url_column: str = "url",
          html_column: str = "html", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> None:
    """Write every row as a record, in ``path``/bundles, and the index of their
    places in ``path``/index.

    The payload is the html in UTF-8 (null: empty). Of records with equal
    payloads of at least ``LEAST_REVISIT_BYTES`` bytes the one with the
    largest id is the response and the others are revisits without payload
    (rows that repeat an id with it are responses too); all other records are
    responses. A null id is kept as an empty identifier, a null url as an
    empty target. Line ends in a url become spaces. Long pages make long
    frames. No rows give no bundle. The index is taken from the bundles as
    written, so writing fails if one does not read back. Its columns: id,
    bundle (file name), frame, frame_offset, frame_bytes and offset (inside the
    decompressed frame); an id stands once for each of its records.
    """
    rows = with_revisits(pick(pages, id=id_column, url=url_column, html=html_column))
    rows = rows.select(F.col("id").cast("string").alias("id"), "url", "digest", "payload_bytes",
                       F.col("refers_to").cast("string").alias("refers_to"),
                       F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = lambda b: pa.RecordBatch.from_arrays([pa.array([b.close()[:-4]], pa.binary())], names=["archive"])
        bundle, held, size = Bundle(level), [], 0
        for batch in batches:
            for r in range(batch.num_rows):
                row = {k: batch.column(k)[r].as_py() for k in ("id", "url", "digest", "payload_bytes", "refers_to", "html")}
                url = " ".join((row["url"] or "").splitlines())
                revisit = row["refers_to"] is not None
                body = b"" if revisit else (row["html"] or "").encode()
                held.append(record("revisit" if revisit else "response", row["id"] or "", url, body, row["digest"],
                                   row["payload_bytes"], row["refers_to"], row["id"] or ""))
                size += len(held[-1])
                if size >= frame_bytes:
                    bundle.add(b"".join(held))
                    held, size = [], 0
                    if bundle.bytes >= bundle_bytes:
                        yield out(bundle)
                        bundle = Bundle(level)
        if held:
            bundle.add(b"".join(held))
        if bundle.frames:
            yield out(bundle)

    # the text writer adds the separator to each row: here the seek table's last four bytes
    (rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", SEEKABLE_MAGIC.decode("ISO-8859-1"))
     .option("compression", "none").option("maxRecordsPerFile", 1).mode("errorifexists").text(f"{path}/bundles"))
    spark = pages.sparkSession
    _places(_bundles(spark, f"{path}/bundles")).write.mode("errorifexists").parquet(f"{path}/index")


INDEX = "id string, bundle string, frame int, frame_offset bigint, frame_bytes bigint, offset bigint"


def _bundles(spark: SparkSession, *paths: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select(F.substring_index("path", "/", -1).alias("bundle"), "content")


def _places(bundles: DataFrame) -> DataFrame:
    """Where each record of the bundles lies (``INDEX``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                file, archive = batch.column("bundle")[r].as_py(), batch.column("content")[r].as_py()
                for k, (offset, packed, plain) in enumerate(seek_table(archive)):
                    places = [(head["X-Page-ID"] or None, at) for at, head, _ in parse(read_frame(archive, offset, packed, plain))]
                    n = len(places)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p[0] for p in places], pa.string()), pa.array([file] * n), pa.array([k] * n, pa.int32()),
                         pa.array([offset] * n, pa.int64()), pa.array([packed] * n, pa.int64()), pa.array([p[1] for p in places], pa.int64())],
                        names=["id", "bundle", "frame", "frame_offset", "frame_bytes", "offset"])

    return bundles.mapInArrow(run, INDEX)


def index(spark: SparkSession, path: str) -> DataFrame:
    """Where each identifier lies: bundle, frame and the offset inside it."""
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def read_records(spark: SparkSession, path: str, with_payload: bool = True, ids: DataFrame | None = None) -> DataFrame:
    """The records below ``path`` by their index entries: all, or those whose
    id is in ``ids`` (its first column; null finds records without an id).

    Only frames that hold a wanted record are decompressed, each once, and for
    records in few bundles only those are opened. Returns id, url, record_type,
    refers_to, payload_digest and payload_bytes as the record states them,
    payload (binary; null without ``with_payload``), sha1 (of the payload
    read), bundle, frame and offset. A damaged frame or payload fails the job.
    """
    entries, opened = index(spark, path), [f"{path}/bundles"]
    if ids is not None:
        wanted = ids.select(F.col(ids.columns[0]).cast("string").alias("_id")).distinct()
        entries = entries.join(wanted, F.col("id").eqNullSafe(F.col("_id")), "left_semi")
        named = [r["bundle"] for r in entries.select("bundle").distinct().limit(MOST_NAMED + 1).collect()]
        if len(named) <= MOST_NAMED:
            opened = [f"{path}/bundles/{n}" for n in named] or opened
    # no more than one bundle's records to a row
    places = entries.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("frame", "offset"))).alias("places"))
    names = ["id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload", "sha1", "bundle", "frame", "offset"]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary(), pa.string(), pa.string(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                file, archive = batch.column("bundle")[r].as_py(), batch.column("content")[r].as_py()
                table, wanted = seek_table(archive), batch.column("places")[r].values
                for k, group in groupby(zip(wanted.field("frame").to_pylist(), wanted.field("offset").to_pylist()), key=lambda p: p[0]):
                    plain, rows = read_frame(archive, *table[k]), []
                    for _, at in group:
                        _, head, body = next(parse(plain, at))
                        refers = head.get("WARC-Refers-To")
                        rows.append((head["X-Page-ID"] or None, head["WARC-Target-URI"], head["WARC-Type"],
                                     refers[len("<urn:page:"):-1] if refers else None,
                                     head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"]),
                                     body if with_payload else None, hashlib.sha1(body).hexdigest(), file, k, at))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    # the places are hashed: the bundles are not sorted
    held = _bundles(spark, *opened).join(places.hint("shuffle_hash"), "bundle").select("bundle", "content", "places")
    return held.mapInArrow(run, "id string, url string, record_type string, refers_to string, payload_digest string, "
                                "payload_bytes bigint, payload binary, sha1 string, bundle string, frame int, offset bigint")


def lookup(archive: bytes, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record of a bundle, by its index entry; only
    the record's frame is decompressed."""
    plain = read_frame(archive, *seek_table(archive)[frame])
    _, head, body = next(parse(plain, offset))
    return head, body
