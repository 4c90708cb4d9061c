"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole
records, and a seek table in a skippable frame at the end: the sizes of every
frame before and after compression, in the public seekable format. An index row
maps a record to its bundle, its frame and its offset in the frame, so one record
is read by one range request and the decoding of one frame.

Files are written and read by the executors through `pyarrow.fs`, which opens
the same addresses as Spark (local paths, HDFS, S3, GCS); the folder must be one
that all of them reach. A try of a task that was lost leaves a file that no
index row names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from silvermill.llm.text import whole_text
from silvermill.scratch import stored

#: Fixed values of the seekable format: skippable frame, seek table footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, bundle string, frame int, offset long, length long"
RECORD = (
    "record_id string, record_type string, refers_to string, target_uri string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def digest_text(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def format_record(
    record_id: str, kind: str, uri: str, date: str, digest: str, payload_bytes: int,
    payload: bytes, refers_to: str | None,
) -> bytes:
    """One record: an HTTP response whose body is there or, in a revisit, left out."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {payload_bytes}\r\n\r\n"
    ).encode()
    body = http + (payload if kind == RESPONSE else b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {header_text(uri)}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    if kind == REVISIT:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def header_text(value: str) -> str:
    """A header's value on one line: line ends and control characters percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def parse_record(data: bytes) -> tuple:
    """The fields of `RECORD` from the bytes of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(
        int(line.split(b":")[1])
        for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")
    )
    kind = fields["WARC-Type"]
    if kind == RESPONSE and len(payload) != size:
        raise ValueError("a payload is cut short")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == RESPONSE and payload_digest(payload) != digest:
        raise ValueError("a payload does not match its digest")
    refers = fields.get("WARC-Refers-To")
    return (
        fields["WARC-Record-ID"].strip("<>"), kind, refers.strip("<>") if refers else None,
        fields["WARC-Target-URI"], size, digest,
        payload if kind == RESPONSE else None,
    )


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle, from (compressed, plain) sizes."""
    entries = b"".join(struct.pack("<II", *pair) for pair in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame of an open bundle."""
    end = file.size()
    count, flags, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    width = 12 if flags & 0x80 else 8
    table = file.read_at(count * width, end - 9 - count * width)
    frames, start = [], 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", table, i * width)
        frames.append((start, packed, plain))
        start += packed
    return frames


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder
    )


def split_records(plain: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the records in a decoded frame."""
    at = 0
    while at < len(plain):
        head = plain.index(b"\r\n\r\n", at)
        size = next(
            int(line.split(b": ")[1]) for line in plain[at:head].split(b"\r\n")
            if line.startswith(b"Content-Length: ")
        )
        end = head + 4 + size + 4
        yield at, plain[at:end]
        at = end


def mark_revisits(
    records: DataFrame, id_col: str, payload: Column, min_payload: int = 0
) -> DataFrame:
    """The rows with payload, payload_bytes, sha1 and, for revisits, refers_to.

    Of the rows with one payload of `min_payload` bytes or more, that with the
    smallest id is the response (those, if several rows share that id; all, if
    every id is null). A null id is never the smallest.
    """
    rows = records.withColumn("payload", F.encode(payload, "UTF-8")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload")}
    )
    firsts = (
        records.select(F.col(id_col).alias("id"), F.encode(payload, "UTF-8").alias("payload"))
        .groupBy(F.sha1("payload").alias("first_sha1")).agg(F.min("id").alias("first"))
    )
    # the hash is one more join key: the join then has exchanges of its own, of which
    # adaptive execution splits a payload that very many rows have
    rows = rows.withColumn("spread", F.xxhash64("sha1"))
    firsts = firsts.withColumn("first_spread", F.xxhash64("first_sha1"))
    same = (F.col("sha1") == F.col("first_sha1")) & (F.col("spread") == F.col("first_spread"))
    again = (F.col("payload_bytes") >= min_payload) & ~F.col(id_col).eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    return rows.join(firsts, same).withColumn(
        "refers_to", F.when(again, F.col("first"))
    ).drop("first", "first_sha1", "spread", "first_spread")


def write_bundles(
    records: DataFrame, folder: str, id_col: str = "record_id", uri_col: str = "url",
    payload_col: str = "html", min_payload: int = 0, date: str = "2024-01-01T00:00:00Z",
    frame_bytes: int = 1 << 20, bundle_bytes: int = 256 << 20, level: int = 3,
) -> DataFrame:
    """Writes every row as a WARC record; returns the stored index (`INDEX`).

    Record ids are `urn:page:` and the id. Payloads are UTF-8 text, null as
    empty. A frame is closed at `frame_bytes` of records (a longer record has a
    frame of its own), a bundle at `bundle_bytes` of frames. A task holds one
    frame. An empty table writes no bundle. Rows with equal ids are records with
    equal ids. Columns other than the three named are not read.
    """
    rows = mark_revisits(
        records.select(
            F.col(id_col).alias("page"), whole_text(uri_col).alias("uri"), F.col(payload_col).alias("body")
        ),
        "page", whole_text("body"), min_payload,
    ).select(
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("page").cast("string"), F.lit(""))).alias("record_id"),
        "uri", "sha1", "payload_bytes",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        F.concat(F.lit("urn:page:"), F.col("refers_to").cast("string")).alias("refers_to"),
    )

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        packer = zstandard.ZstdCompressor(level=level)
        bundle = None

        for batch in _frames(frames, frame_bytes, date):
            if bundle is None:
                name, sizes, written = f"{uuid.uuid4().hex}.warc.zst", [], 0
                bundle = system.open_output_stream(f"{root}/{name}", compression=None)
            plain = b"".join(data for _, data in batch)
            packed = packer.compress(plain)
            bundle.write(packed)
            index, at = [], 0
            for record_id, data in batch:
                index.append((record_id, name, len(sizes), at, len(data)))
                at += len(data)
            sizes.append((len(packed), len(plain)))
            written += len(packed)
            if written >= bundle_bytes:
                bundle.write(seek_table(sizes))
                bundle.close()
                bundle = None
            yield pd.DataFrame(index, columns=["record_id", "bundle", "frame", "offset", "length"])
        if bundle is not None:
            bundle.write(seek_table(sizes))
            bundle.close()

    return stored(rows.mapInPandas(write, INDEX), "warc-index")


def _frames(frames: Iterable[pd.DataFrame], frame_bytes: int, date: str) -> Iterator[list]:
    batch, size = [], 0
    for frame in frames:
        for row in frame.itertuples(index=False):
            kind = RESPONSE if row.refers_to is None else REVISIT
            data = format_record(
                row.record_id, kind, row.uri, date, digest_text(row.sha1), row.payload_bytes,
                row.payload or b"", row.refers_to,
            )
            if batch and size + len(data) > frame_bytes:
                yield batch
                batch, size = [], 0
            batch.append((row.record_id, data))
            size += len(data)
    if batch:
        yield batch


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles that the index names, decoded (`RECORD`).

    The seek tables are read first; then frames, one by one, wherever there is a
    free core.
    """
    def frames_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open(folder)
        for batch in batches:
            for name in batch["bundle"]:
                with system.open_input_file(f"{root}/{name}") as file:
                    table = read_seek_table(file)
                yield pd.DataFrame(
                    [(name, start, packed, plain) for start, packed, plain in table],
                    columns=["bundle", "start", "packed", "plain"],
                )

    def records_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open(folder)
        for batch in batches:
            for name, start, packed, plain in batch.itertuples(index=False):
                with system.open_input_file(f"{root}/{name}") as file:
                    data = zstandard.ZstdDecompressor().decompress(
                        file.read_at(packed, start), max_output_size=plain
                    )
                yield pd.DataFrame(
                    [parse_record(record) for _, record in split_records(data)],
                    columns=[part.split(" ")[0] for part in RECORD.split(", ")],
                )

    # a number is named because rows this small would otherwise share one task
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = index.select("bundle").distinct().repartition(tasks, "bundle").mapInPandas(
        frames_of, "bundle string, start long, packed long, plain long"
    )
    return places.repartition(tasks, "bundle", "start").mapInPandas(records_of, RECORD)


def fetch_records(index: DataFrame, folder: str, wanted: DataFrame, id_col: str = "record_id") -> DataFrame:
    """The records whose ids are in `wanted`, by range reads of their frames alone."""
    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open(folder)
        for batch in batches:
            for name, places in batch.groupby("bundle"):
                with system.open_input_file(f"{root}/{name}") as file:
                    table = read_seek_table(file)
                    out = []
                    for number, rows in places.groupby("frame"):
                        start, packed, plain = table[number]
                        data = zstandard.ZstdDecompressor().decompress(
                            file.read_at(packed, start), max_output_size=plain
                        )
                        out += [parse_record(data[a : a + n]) for a, n in zip(rows["offset"], rows["length"])]
                yield pd.DataFrame(out, columns=[part.split(" ")[0] for part in RECORD.split(", ")])

    ids = wanted.select(F.col(id_col).alias("record_id")).distinct()
    return index.join(ids, "record_id", "left_semi").repartition("bundle").mapInPandas(fetch, RECORD)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()
