"""Ogg media columns: whole payloads stored as physical Ogg bitstreams and read back.

The writer stores a payload of 8-bit mono samples as packets of ``UNIT`` bytes in one logical
stream, multiplexed with a second logical stream of text comments. The reader verifies every
page's checksum, sorts pages into logical streams by serial number, reassembles packets from the
lacing values (packets may cross pages), and derives times from granule positions.

Null text counts as empty; rows with a null id and repeated rows each give a row; an empty table gives
none; a very long text gives many pages; other columns are ignored, whatever their names. Equal payloads give equal bytes: serial numbers are drawn from content.
A page that is cut short, out of sequence or fails its checksum raises ``OggError``.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm._arrow import slices

UNIT = 576
RATE = 8000
HEAD = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
_REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


class OggError(ValueError):
    pass


def checksum(page: bytes) -> int:
    """CRC-32 with polynomial 0x04c11db7, most significant bit first, from 0 and not inverted.

    That is zlib's CRC over bit-reversed bytes, its result reversed, without zlib's inversions.
    """
    x = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(x.to_bytes(4, "little").translate(_REVERSED), "big")


def page(serial: int, number: int, granule: int, flags: int, lacing: bytes, body: bytes) -> bytes:
    head = HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    crc = checksum(head + body)
    return head[:22] + crc.to_bytes(4, "little") + head[26:] + body


def write(payload: bytes, unit: int = UNIT, rate: int = RATE) -> bytes:
    """The payload as an Ogg bitstream: header pages of both streams, a comment page, then the data pages."""
    serial = zlib.crc32(payload)
    other = serial ^ 0x5A5A5A5A
    head = b"\x7fPCM8" + struct.pack("<IHQ", rate, unit, len(payload))
    note = b"\x7fNOTE" + struct.pack("<Q", len(payload) // unit)
    out = [page(serial, 0, 0, FIRST, bytes([len(head)]), head), page(other, 0, 0, FIRST, bytes([len(note)]), note)]
    said = f"samples={len(payload)}".encode()
    out.append(page(other, 1, 1, LAST, bytes([len(said)]), said))
    lace = b"\xff" * (unit // 255) + bytes([unit % 255])
    lacing = lace * (len(payload) // unit)
    at, number = 0, 1
    for start in range(0, len(lacing), 255):
        own = lacing[start : start + 255]
        size = sum(own)
        ended = (start + len(own)) // len(lace)  # packets complete by the end of this page
        granule = ended * unit if any(x < 255 for x in own) else -1
        flags = (CONTINUED if start % len(lace) else 0) | (LAST if start + 255 >= len(lacing) else 0)
        out.append(page(serial, number, granule, flags, own, payload[at : at + size]))
        at, number = at + size, number + 1
    return b"".join(out)


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    times: list[int] = field(default_factory=list)  #: granule position of the page on which each packet ended
    pages: int = 0
    granule: int = 0
    ended: bool = False
    open: list[bytes] = field(default_factory=list)


def read(media: bytes) -> dict[int, Stream]:
    """The logical streams of a physical bitstream, by serial number."""
    streams: dict[int, Stream] = {}
    at, view = 0, memoryview(media)
    while at < len(media):
        if len(media) - at < HEAD.size:
            raise OggError("page cut short")
        mark, version, flags, granule, serial, number, crc, n = HEAD.unpack_from(media, at)
        if mark != b"OggS" or version:
            raise OggError("no page where one should begin")
        lacing = media[at + HEAD.size : at + HEAD.size + n]
        body = at + HEAD.size + n
        end = body + sum(lacing)
        if len(lacing) < n or end > len(media):
            raise OggError("page cut short")
        if checksum(b"".join((media[at : at + 22], b"\0\0\0\0", view[at + 26 : end]))) != crc:
            raise OggError(f"page {number} of stream {serial}: wrong checksum")
        s = streams.get(serial)
        if bool(flags & FIRST) != (s is None):
            raise OggError(f"stream {serial} begins at the wrong page")
        s = s or streams.setdefault(serial, Stream(serial))
        if number != s.pages or s.ended or bool(flags & CONTINUED) != bool(s.open):
            raise OggError(f"page {number} of stream {serial} is out of sequence")
        s.pages += 1
        run = 0
        for x in lacing:
            run += x
            if x < 255:
                s.packets.append(b"".join((*s.open, view[body : body + run])))
                s.times.append(granule)
                s.open, body, run = [], body + run, 0
        if run:
            s.open.append(bytes(view[body : body + run]))
        s.granule, s.ended = (granule if granule != -1 else s.granule), bool(flags & LAST)
        at = end
    if bad := [s.serial for s in streams.values() if s.open or not s.ended]:
        raise OggError(f"streams without an end: {bad}")
    return streams


def samples(media: bytes) -> tuple[bytes, dict]:
    """The payload in a bitstream made by ``write``, and what its pages say."""
    streams = read(media)
    data = [s for s in streams.values() if s.packets[0][:5] == b"\x7fPCM8"]
    if len(data) != 1:
        raise OggError("not one data stream")
    s = data[0]
    rate, unit, n = struct.unpack("<IHQ", s.packets[0][5:])
    payload = b"".join(s.packets[1:])
    if len(payload) != n or s.granule != n:
        raise OggError("the granule position and the packets disagree")
    return payload, {"rate": rate, "packets": len(s.packets) - 1, "pages": sum(x.pages for x in streams.values()), "streams": len(streams), "seconds": s.granule / rate}


def feature(payload: bytes, info: dict) -> str:
    """Packets, pages, seconds by the granule position, mean, root mean square about 128, and sign changes."""
    x = np.frombuffer(payload, np.uint8).astype(np.float32) - 128
    above = x >= 0
    return f"packets={info['packets']};pages={info['pages']};seconds={info['seconds']:.6f};mean={x.mean(dtype=np.float64):.4f};rms={np.sqrt(np.mean(x * x, dtype=np.float64)):.4f};crossings={int((above[1:] != above[:-1]).sum())}"


ROWS = "row bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


def media(docs: DataFrame, text: str = "text", row: str = "doc_id", unit: int = UNIT, stored: bool = True) -> DataFrame:
    """One row per document: digests and features of its payload as read back, and the stored bytes (``media``) if ``stored``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4_000_000):
            out = []
            for row_id, words in zip(part["row"].to_pylist(), part["text"].to_pylist(), strict=True):
                raw = (words or "").encode()
                kept = write(raw + b"\xff" * (-len(raw) % unit or (0 if raw else unit)), unit)
                back, info = samples(kept)
                out.append((row_id, len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(kept), hashlib.sha256(kept).hexdigest(), feature(back, info), *([kept] if stored else [])))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            names = [*(c.split()[0] for c in ROWS.split(", ")), "media"][: len(types) if stored else -1]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=False)], names)

    slim = docs.select(F.col(row).cast("bigint").alias("row"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, ROWS + (", media binary" if stored else "")).withColumnRenamed("row", row)
