"""Media columns: an Ogg container that is written, verified and read back."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ident, unident

FRAME = 576  # bytes of a packet; one byte is one 8-bit sample
RATE = 8000  # samples a second
STREAMS = 2  # logical streams; packets are dealt to them in turn
PAGE_PACKETS = 16  # packets that begin on a page, unless its lacing values run out
CONTINUED, FIRST, LAST = 1, 2, 4  # flags of a page's header
_MIRROR = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def page_checksum(data: bytes) -> int:
    """The container's CRC-32 (polynomial 0x04C11DB7, most significant bit first, no inversion).

    It is the common reflected CRC-32 of the mirrored bytes, mirrored, without that one's two inversions.
    """
    return int(f"{zlib.crc32(data.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF:032b}"[::-1], 2)


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = struct.pack("<4sBBqIIIB", b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    return head[:22] + struct.pack("<I", page_checksum(head + body)) + head[26:] + body


def _lacing(size: int) -> bytes:
    return b"\xff" * (size // 255) + bytes([size % 255])


def _stream_pages(packets: list[bytes], serial: int) -> list[bytes]:
    """Pages of one logical stream. A page's granule position counts the samples of the packets that end on it; -1 if none does."""
    pages, flags, samples, open_lacing, open_body, ended = [], FIRST, 0, bytearray(), bytearray(), 0
    done_at = -1

    def close(last: bool, continued: bool) -> None:
        nonlocal flags, open_lacing, open_body, ended, done_at
        pages.append(_page(flags | (LAST if last else 0), done_at, serial, len(pages), bytes(open_lacing), bytes(open_body)))
        flags, open_lacing, open_body, ended, done_at = (CONTINUED if continued else 0), bytearray(), bytearray(), 0, -1

    for n, packet in enumerate(packets, 1):
        at = 0
        for value in _lacing(len(packet)):
            if len(open_lacing) == 255:
                close(False, at > 0)
            open_lacing.append(value)
            open_body += packet[at : at + value]
            at += value
        samples += len(packet)
        done_at, ended = samples, ended + 1
        if ended == PAGE_PACKETS and n < len(packets):
            close(False, False)
    close(True, False)
    return pages


def write_ogg(payload: bytes) -> bytes:
    """The payload as 8-bit samples in ``STREAMS`` multiplexed logical streams. Serial numbers depend on the payload alone."""
    packets = [payload[i : i + FRAME] for i in range(0, len(payload), FRAME)]
    base = zlib.crc32(payload) & 0x7FFFFFFF
    streams = [_stream_pages(packets[k::STREAMS], base ^ k) for k in range(STREAMS) if packets[k::STREAMS]]
    out = [pages[0] for pages in streams]  # all first pages come first
    for i in range(1, max(map(len, streams))):
        out += [pages[i] for pages in streams if i < len(pages)]
    return b"".join(out)


def read_ogg(data: bytes) -> tuple[bytes, dict]:
    """Payload and facts of a container: checks page checksums and numbers, reassembles packets, demultiplexes, derives timestamps.

    Raises ValueError for a broken page. Timestamps are end times in seconds by stream, one for each page that ends a packet.
    """
    at, streams, order, pages = 0, {}, [], 0
    while at < len(data):
        magic, version, flags, granule, serial, number, checksum, n_lacing = struct.unpack_from("<4sBBqIIIB", data, at)
        if magic != b"OggS" or version != 0:
            raise ValueError(f"no page at byte {at}")
        lacing = data[at + 27 : at + 27 + n_lacing]
        end = at + 27 + n_lacing + sum(lacing)
        if end > len(data) or page_checksum(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != checksum:
            raise ValueError(f"checksum of the page at byte {at}")
        if serial not in streams:
            if not flags & FIRST:
                raise ValueError(f"stream {serial} has no first page")
            streams[serial] = {"packets": [], "open": [], "times": [], "next": 0, "last": False}
            order.append(serial)
        s = streams[serial]
        if number != s["next"] or s["last"] or bool(flags & CONTINUED) != bool(s["open"]):
            raise ValueError(f"page {number} of stream {serial} is out of order")
        s["next"], s["last"] = number + 1, bool(flags & LAST)
        body = at + 27 + n_lacing
        for value in lacing:
            s["open"].append(data[body : body + value])
            body += value
            if value < 255:
                s["packets"].append(b"".join(s["open"]))
                s["open"] = []
        if granule >= 0:
            s["times"].append(granule / RATE)
        at, pages = end, pages + 1
    if any(s["open"] or not s["last"] for s in streams.values()):
        raise ValueError("a stream has no end")
    dealt = [streams[serial]["packets"] for serial in order]
    payload = b"".join(dealt[i % len(dealt)][i // len(dealt)] for i in range(sum(map(len, dealt)))) if dealt else b""
    return payload, {"pages": pages, "packets": sum(map(len, dealt)), "streams": len(dealt), "times": [streams[serial]["times"] for serial in order]}


def sample_feature(payload: bytes, facts: dict) -> str:
    """Counts, the last timestamp, and level and zero crossings of the samples around 128, as a string of integers."""
    x = np.frombuffer(payload, np.uint8).astype(np.int16) - 128
    level = int(np.square(x.astype(np.int64)).sum()) // len(x)
    crossings = int(np.count_nonzero(np.signbit(x[1:]) != np.signbit(x[:-1])))
    last = max(t for times in facts["times"] for t in times)
    return f"streams={facts['streams']};pages={facts['pages']};packets={facts['packets']};end_ms={round(last * 1000)};level={level};crossings={crossings}"


def pad(data: bytes) -> bytes:
    """Bytes 255 up to a positive multiple of a packet."""
    return data + b"\xff" * (-len(data) % FRAME if data else FRAME)


_SCHEMA = "nid long, n_bytes long, payload binary, media binary, feature string"


def ogg_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each whole text as an Ogg column: identifier, ``n_bytes``, ``payload`` (read back), ``media`` (the container), ``feature``.

    A null text is an empty one. One row out for each row in, repeated ones too; equal texts give equal values. A null
    identifier stays null. There is no shuffle: a row's work depends on it alone, and a container is held for one row at a
    time beside its batch. Other columns are ignored.
    """
    rows = docs.select(ident(id_col).alias("nid"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.schema([("nid", pa.int64()), ("n_bytes", pa.int64()), ("payload", pa.binary()), ("media", pa.binary()), ("feature", pa.string())])
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part, out = batch.slice(start, 256), []
                for nid, value in zip(part.column(0).to_pylist(), part.column(1)):
                    data = value.as_py()
                    media = write_ogg(pad(data))
                    payload, facts = read_ogg(media)
                    out.append((nid, len(data), payload, media, sample_feature(payload, facts)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), fields)], schema=fields)

    return rows.mapInArrow(run, _SCHEMA).withColumnRenamed("nid", id_col).withColumn(id_col, unident(id_col))


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def op5_media_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    media = ogg_media(docs)
    return media.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, octet_length(payload) - 31, 32)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature",
    )
