"""MPEG audio columns: write, resynchronise, parse and seek MPEG audio streams.

`write_stream` stores a payload of bytes losslessly as the ancillary data of
silent MPEG-1 Layer III frames (48 kHz, one channel, header checksums), after an
ID3v2 tag with the payload's length and a variable-bitrate table frame.  A frame's
bit rate is the least of the standard table that holds what is left, so streams
are truly of variable bit rate.  `read_stream` takes any bytes: MPEG-1, 2 and 2.5,
Layers I to III.  It parses ID3v2.2 to 2.4 tags and a trailing ID3v1 tag, finds
frame headers again after foreign bytes (a header counts if another of its version,
layer and rate, a tag or the end stands where its length says, or such a frame ends before it), parses Xing, Info and VBRI
tables by their flags, verifies checksums (those of Layer II, which need its
allocation tables, are counted as unverified) and gives exact durations and the
byte offset of every frame.

Defined cases: null payloads count as empty and are padded like others; streams
without frames have duration 0 and no offsets; foreign bytes are counted, not
parsed; repeated rows give equal streams; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAD = 576
#: Fixed values of frame headers: kbit/s by index for MPEG-1 Layers I to III, then MPEG-2 Layer I and Layers II and III; Hz of MPEG-1 by index.
_KBITS = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
BITRATES = _KBITS[1, 3]
RATES = (44100, 48000, 32000)
SAMPLES = 1152


class Header(NamedTuple):
    """What a frame header says: bytes and samples of the frame, Hz, kbit/s, bytes of side information, bytes under the checksum (None: unknown), and what all frames of a stream share."""

    length: int
    samples: int
    hz: int
    kbits: int
    side: int
    protected: bool
    covered: int | None
    kind: tuple[int, int, int]


@lru_cache(4096)
def checksum(protected: bytes) -> int:
    """CRC-16 with polynomial 0x8005 and start 0xFFFF over the last two header bytes and the side information."""
    crc = 0xFFFF
    for byte in protected:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


@lru_cache(65536)
def header_fields(head: bytes) -> Header | None:
    """The fields of a frame header, or None where these 4 bytes are none."""
    if len(head) < 4 or head[0] != 0xFF or head[1] & 0xE0 != 0xE0:
        return None
    version, layer, index, rate, mode = head[1] >> 3 & 3, 4 - (head[1] >> 1 & 3), head[2] >> 4, head[2] >> 2 & 3, head[3] >> 6
    if version == 1 or layer == 4 or not 0 < index < 15 or rate == 3 or head[3] & 3 == 2:
        return None
    first = version == 3
    kbits = _KBITS[1 if first else 2, layer if first else min(layer, 2)][index]
    hz = RATES[rate] >> (0 if first else 1 if version == 2 else 2)
    samples = 384 if layer == 1 else 1152 if layer == 2 or first else 576
    unit = 4 if layer == 1 else 1
    length = (samples // 8 // unit * kbits * 1000 // hz + (head[2] >> 1 & 1)) * unit
    side = 0 if layer < 3 else (17 if first else 9) if mode == 3 else (32 if first else 17)
    if layer == 1:  # 4 bits of allocation for each of 32 bands and each channel; joint stereo shares those above a bound
        covered = 16 if mode == 3 else (32 + 4 * ((head[3] >> 4 & 3) + 1)) // 2 if mode == 1 else 32
    else:
        covered = side if layer == 3 else None
    return Header(length, samples, hz, kbits, side, not head[1] & 1, covered, (version, layer, rate))


@lru_cache(16)
def _silent(rate: int) -> bytes:
    """Header, checksum and empty side information of a frame with the rate at this index."""
    head, side = bytes((0xFF, 0xFA, rate << 4 | 1 << 2, 0xC4)), bytes(17)
    return head + checksum(head[2:] + side).to_bytes(2, "big") + side


def _syncsafe(n: int) -> bytes:
    return bytes(n >> s & 127 for s in (21, 14, 7, 0))


def _tag(**texts: str) -> bytes:
    frames = b""
    for name, value in texts.items():
        body = b"\3" + name.encode() + b"\0" + value.encode()
        frames += b"TXXX" + _syncsafe(len(body)) + b"\0\0" + body
    return b"ID3\4\0\0" + _syncsafe(len(frames)) + frames


def padded(text: bytes) -> bytes:
    """The text and bytes 255 up to a positive multiple of PAD."""
    return text + b"\xff" * (PAD - len(text) % PAD if len(text) % PAD or not text else 0)


def write_stream(payload: bytes) -> bytes:
    frames, at, over = [], 0, len(_silent(1))
    while at < len(payload):
        rate = next((r for r in range(1, 15) if 3 * BITRATES[r] - over >= len(payload) - at), 14)
        size = 3 * BITRATES[rate]  # 144 * kbit/s * 1000 / 48000
        part = payload[at : at + size - over]
        frames.append(_silent(rate) + part + bytes(size - over - len(part)))
        at += len(part)
    table = _silent(10)
    length = 3 * BITRATES[10]
    total = length + sum(map(len, frames))
    starts, offset = [], length
    for f in frames:
        starts.append(offset)
        offset += len(f)
    seek = bytes(min(255, 256 * starts[i * len(starts) // 100] // total) for i in range(100)) if starts else bytes(100)
    body = table + b"Xing" + (7).to_bytes(4, "big") + len(frames).to_bytes(4, "big") + total.to_bytes(4, "big") + seek
    return _tag(payload_bytes=str(len(payload))) + body + bytes(length - len(body)) + b"".join(frames)


def read_stream(data: bytes) -> dict:
    """Tags, table, frames and what the frames carry."""
    out: dict = {
        "tags": {}, "table": None, "offsets": [], "bitrates": [], "samples": 0, "hz": 0, "bad_checksums": 0, "unverified_checksums": 0, "foreign_bytes": 0, "payload": b"",
    }
    at = 0
    while data[at : at + 3] == b"ID3" and len(data) >= at + 10:
        size = _number(data[at + 6 : at + 10], 7)
        _read_tag(data[at + 3], data[at + 5], data[at + 10 : at + 10 + size], out["tags"])
        at += 10 + size + (10 if data[at + 3] == 4 and data[at + 5] & 0x10 else 0)
    at = min(at, len(data))
    parts, last, kind = [], max(0, len(data) - 128), None  # where an ID3v1 tag would stand; what the frame that ends here shares with its stream
    while at < len(data):
        if at == last and data[at : at + 3] == b"TAG":
            _read_old_tag(data[at:], out["tags"])
            at = len(data)
            break
        head = header_fields(data[at : at + 4])
        end = at + head.length if head else at
        follows = header_fields(data[end : end + 4])
        if not head or end > len(data) or len(data) - end >= 4 and head.kind != kind and not (follows and follows.kind == head.kind) and not (end == last and data[end : end + 3] == b"TAG"):
            step = data.find(b"\xff", at + 1)
            step = len(data) if step < 0 else step
            if at < last < step and data[last : last + 3] == b"TAG":
                step = last
            out["foreign_bytes"] += step - at
            at, kind = step, None
            continue
        begin = at + 4
        if head.protected:
            if head.covered is None:
                out["unverified_checksums"] += 1
            else:
                out["bad_checksums"] += checksum(data[at + 2 : at + 4] + data[begin + 2 : begin + 2 + head.covered]) != int.from_bytes(data[begin : begin + 2], "big")
            begin += 2
        begin += head.side
        table = _read_table(data[at:end], begin - at) if not out["offsets"] and out["table"] is None else None
        if table:
            out["table"] = table
        else:
            out["offsets"].append(at)
            out["bitrates"].append(head.kbits)
            out["samples"] += head.samples
            parts.append(data[begin:end])
        out["hz"], at, kind = head.hz, end, head.kind
    carried = b"".join(parts)
    size = out["tags"].get("payload_bytes")
    out["payload"] = carried[: int(size)] if size and size.isdigit() else carried
    return out


def _read_table(frame: bytes, begin: int) -> dict | None:
    """Frames, bytes and seek places of a variable-bitrate table; None for what its flags leave out, or where the frame holds no table."""
    if frame[begin : begin + 4] in (b"Xing", b"Info"):
        flags, at, out = int.from_bytes(frame[begin + 4 : begin + 8], "big"), begin + 8, {}
        for flag, name in ((1, "frames"), (2, "bytes")):
            out[name] = int.from_bytes(frame[at : at + 4], "big") if flags & flag else None
            at += 4 if flags & flag else 0
        return out | {"seek": frame[at : at + 100] if flags & 4 else None}
    if frame[36:40] == b"VBRI":
        entries, scale, width = (int.from_bytes(frame[i : i + 2], "big") for i in (54, 56, 58))
        return {"frames": int.from_bytes(frame[50:54], "big"), "bytes": int.from_bytes(frame[46:50], "big"), "seek": [scale * int.from_bytes(frame[62 + i * width : 62 + (i + 1) * width], "big") for i in range(entries)]}
    return None


def _number(raw: bytes, bits: int) -> int:
    """Big-endian number of digits of 7 or 8 bits."""
    out = 0
    for byte in raw:
        out = out << bits | byte
    return out


def _decoded(encoding: int, raw: bytes) -> list[str]:
    """The strings of a text frame, which zeros part."""
    name = ("latin-1", "utf-16", "utf-16-be", "utf-8")[encoding] if encoding < 4 else "latin-1"
    if name == "utf-16" and raw[:2] not in (b"\xff\xfe", b"\xfe\xff"):
        name = "utf-16-be"
    return [x.removeprefix("\ufeff") for x in raw.decode(name, "replace").rstrip("\0").split("\0")]


def _read_tag(version: int, flags: int, body: bytes, tags: dict) -> None:
    """Text frames of an ID3v2 tag by name (free ones by their description); other frames by name with their size."""
    if flags & 0x80 and version < 4:
        body = body.replace(b"\xff\0", b"\xff")
    at = 0
    if flags & 0x40 and version > 2:  # an extended header; its size counts itself in 2.4 only
        at = _number(body[:4], 7) if version == 4 else 4 + _number(body[:4], 8)
    name_size, size_size, over = (3, 3, 6) if version == 2 else (4, 4, 10)
    while at + over <= len(body) and body[at]:
        name = body[at : at + name_size].decode("latin-1")
        size = _number(body[at + name_size : at + name_size + size_size], 7 if version == 4 else 8)
        frame = body[at + over : at + over + size]
        if version == 4 and body[at + 9] & 1:  # a length stands first
            frame = frame[4:]
        if version == 4 and body[at + 9] & 2:
            frame = frame.replace(b"\xff\0", b"\xff")
        if name[0] == "T" and frame:
            texts = _decoded(frame[0], frame[1:])
            if name in ("TXXX", "TXX"):
                tags[texts[0]] = "/".join(texts[1:])
            else:
                tags[name] = "/".join(texts)
        else:
            tags[name] = f"{len(frame)} bytes"
        at += over + size


def _read_old_tag(tag: bytes, tags: dict) -> None:
    """The fields of an ID3v1 tag, unless an ID3v2 tag has them."""
    for name, a, b in (("TIT2", 3, 33), ("TPE1", 33, 63), ("TALB", 63, 93), ("TYER", 93, 97), ("COMM", 97, 127)):
        text = tag[a:b].split(b"\0")[0].decode("latin-1").strip()
        if text:
            tags.setdefault(name, text)


def seek(offsets: list[int], hz: int, seconds: float, samples: int = SAMPLES) -> int | None:
    """Byte offset of the frame that sounds at a time, None past the end."""
    frame = int(seconds * hz) // samples
    return offsets[frame] if 0 <= frame < len(offsets) else None


_PIECE = 8 << 20  # bytes of output held before a batch is passed on


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])
    for batch in batches:
        rows, held = ([], [], []), 0
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            raw = (text.as_py() or "").encode()
            media = write_stream(padded(raw))
            for c, v in zip(rows, (doc_id.as_py(), len(raw), media), strict=True):
                c.append(v)
            held += len(media)
            if held > _PIECE:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)
                rows, held = ([], [], []), 0
        if rows[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)


READ = (
    "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, frames long, samples long, hz int, bad_checksums long, "
    "foreign_bytes long, table_frames long, least_kbits int, most_kbits int, offsets array<long>"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ["doc_id", "n_bytes", *(x.split()[0] for x in READ.split(", "))]
        rows: dict = {n: [] for n in names}
        for doc_id, n_bytes, media in zip(*batch.columns, strict=True):
            data = media.as_py()
            s = read_stream(data)
            values = (
                doc_id.as_py(), n_bytes.as_py(), len(s["payload"]), hashlib.sha256(s["payload"]).hexdigest(), zlib.crc32(s["payload"][-32:]), len(data), hashlib.sha256(data).hexdigest(),
                len(s["offsets"]), s["samples"], s["hz"], s["bad_checksums"], s["foreign_bytes"], s["table"]["frames"] if s["table"] else None,
                min(s["bitrates"], default=0), max(s["bitrates"], default=0), s["offsets"],
            )
            for c, v in zip(rows.values(), values, strict=True):
                c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, _TYPES.get(n, pa.int64())) for n, c in rows.items()], names)


_TYPES = {"payload_sha256": pa.string(), "media_sha256": pa.string(), "hz": pa.int32(), "least_kbits": pa.int32(), "most_kbits": pa.int32(), "offsets": pa.list_(pa.int64())}


def to_media(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_bytes (of the text) and media, the stream that carries the padded text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_write, "doc_id long, n_bytes long, media binary")


def describe_media(media: DataFrame) -> DataFrame:
    """What reading the stored streams back gives, with the seek offset of every frame."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_read, "doc_id long, n_bytes long, " + READ)
