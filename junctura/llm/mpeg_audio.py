"""MPEG audio columns: bytes stored losslessly in Layer III frames, and a reader for frames, tags and seek tables.

A stored stream is an ID3v2 tag, a variable-bitrate header frame (Xing, with frame and byte counts and a 100-entry seek table), payload
frames of the highest bitrate and one of the lowest that holds the rest, and an ID3v1 tag.  Frames carry a checksum; their side information is
zero, so a decoder plays silence, and the payload lies in the ancillary bytes behind it.  The reader resynchronises on frame headers, so
foreign bytes between frames are skipped and reported.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .store import Scratch
from .words import batches_of

#: Tables of ISO/IEC 11172-3 and 13818-3; fixed values: kbit/s by (MPEG-1, layer), Hz by version bits.
KBPS = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HERTZ = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
_SIDE = {(True, False): 32, (True, True): 17, (False, False): 17, (False, True): 9}  # by (MPEG-1, mono)
_TOP = 14
_LENGTH = b"payload_bytes"


@dataclass(frozen=True)
class Header:
    """What a frame's four bytes say."""

    kbps: int
    hertz: int
    size: int
    samples: int
    side: int
    checked: bool
    mono: bool
    layer: int

    def continues(self, other: Header | None) -> bool:
        """May the other frame belong to the same stream?"""
        return other is not None and (self.layer, self.hertz) == (other.layer, other.hertz)


@lru_cache(maxsize=4096)
def parse_header(four: bytes) -> Header | None:
    """A frame header of Layer I, II or III, or None where the bytes are no such header or the bitrate is free."""
    if len(four) < 4 or four[0] != 0xFF or four[1] & 0xE0 != 0xE0:
        return None
    version, layer, rate, hz = four[1] >> 3 & 3, 4 - (four[1] >> 1 & 3), four[2] >> 4, four[2] >> 2 & 3
    if version == 1 or layer == 4 or rate in (0, 15) or hz == 3 or four[3] & 3 == 2:
        return None
    first = version == 3
    kbps, hertz, mono, pad = KBPS[first, layer][rate], HERTZ[version][hz], four[3] >> 6 == 3, four[2] >> 1 & 1
    samples = 384 if layer == 1 else 576 if layer == 3 and not first else 1152
    size = (12 * kbps * 1000 // hertz + pad) * 4 if layer == 1 else samples // 8 * kbps * 1000 // hertz + pad
    return Header(kbps, hertz, size, samples, _SIDE[first, mono] if layer == 3 else 0, not four[1] & 1, mono, layer)


@lru_cache(maxsize=4096)
def checksum(data: bytes) -> int:
    """CRC-16 of the two last header bytes and the side information: polynomial 8005, start FFFF."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


@lru_cache(maxsize=32)
def _front(rate: int) -> tuple[bytes, int]:
    """Header, checksum and side information of a 44.1 kHz mono frame of a bitrate's index, and the frame's payload size."""
    four = bytes([0xFF, 0xFA, rate << 4, 0xC0])
    h = parse_header(four)
    side = bytes(h.side)
    return four + struct.pack(">H", checksum(four[2:] + side)) + side, h.size - 6 - h.side


def _syncsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def _id3(entries: dict[bytes, bytes]) -> bytes:
    body = b""
    for k, v in entries.items():
        text = b"\x03" + k + b"\0" + v
        body += b"TXXX" + _syncsafe(len(text)) + b"\0\0" + text
    return b"ID3\x04\0\0" + _syncsafe(len(body)) + body


def store(payload: bytes) -> bytes:
    """A stream that holds ``payload``."""
    front, room = _front(_TOP)
    full = len(payload) // room
    rest = payload[full * room :]
    matrix = np.empty((full, len(front) + room), np.uint8)
    matrix[:, : len(front)] = np.frombuffer(front, np.uint8)
    matrix[:, len(front) :] = np.frombuffer(payload, np.uint8, full * room).reshape(full, room)
    frames = matrix.tobytes()
    sizes = [matrix.shape[1]] * full
    if rest:
        rate = next(r for r in range(1, 15) if _front(r)[1] >= len(rest))
        f, r = _front(rate)
        frames += f + rest + bytes(r - len(rest))
        sizes.append(len(f) + r)
    own, r = _front(9)
    offsets = np.concatenate([[0], np.cumsum(sizes)]) + len(own) + r
    total = int(offsets[-1])
    toc = bytes(int(offsets[len(sizes) * i // 100]) * 256 // total for i in range(100))
    xing = b"Xing" + struct.pack(">III", 7, len(sizes), total) + toc
    tail = b"TAG" + b"stored bytes".ljust(124, b"\0") + b"\xff"
    return _id3({_LENGTH: b"%d" % len(payload)}) + own + xing + bytes(r - len(xing)) + frames + tail


@dataclass
class Table:
    """A variable-bitrate header: Xing, Info or VBRI; frames and bytes as it states them, and byte offsets of equally long parts of the play time."""

    kind: str
    frames: int | None
    bytes: int | None
    offsets: list[int]


@dataclass
class Stream:
    """What the reader found."""

    tags: dict[str, str] = field(default_factory=dict)
    offsets: list[int] = field(default_factory=list)  # of audio frames, for seeking
    samples: int = 0
    seconds: float = 0.0
    hertz: int = 0
    layer: int = 0
    kbps: set[int] = field(default_factory=set)
    bad: int = 0  # Layer III frames whose checksum is wrong
    skipped: int = 0  # bytes outside frames and tags
    table: Table | None = None
    payload: bytes = b""


def _safe(four: bytes) -> int:
    return sum((b & 0x7F) << s for b, s in zip(four, (21, 14, 7, 0), strict=True))


def _text(data: bytes) -> str:
    """A tag's text by its encoding byte: Latin-1, UTF-16 with mark, UTF-16 big-endian, UTF-8."""
    kind = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(data[0], "latin-1") if data else "latin-1"
    return data[1:].decode(kind, "replace").replace("\ufeff", "").rstrip("\0")


def _frames(body: bytes, version: int, flags: int):
    """(name, content) of an ID3v2 tag's frames; compressed and encrypted ones are left out."""
    if version < 4 and flags & 0x80:
        body = body.replace(b"\xff\0", b"\xff")
    at = 0
    if version > 2 and flags & 0x40 and len(body) >= 4:  # the extended header's size leaves itself out before 2.4
        at = _safe(body[:4]) if version == 4 else 4 + int.from_bytes(body[:4], "big")
    wide, head = (3, 6) if version == 2 else (4, 10)
    while at + head <= len(body) and body[at] != 0:
        size = body[at + wide : at + 2 * wide]
        n = _safe(size) if version == 4 else int.from_bytes(size, "big")
        content, form = body[at + head : at + head + n], body[at + 9] if version > 2 else 0
        name, at = body[at : at + wide].decode("latin-1"), at + head + n
        if (version == 3 and form & 0xC0) or (version == 4 and form & 0x0C):
            continue
        if version == 3 and form & 0x20 or version == 4 and form & 0x40:  # a group byte
            content = content[1:]
        if version == 4:
            content = content[4:] if form & 1 else content  # a length in front
            content = content.replace(b"\xff\0", b"\xff") if form & 2 or flags & 0x80 else content
        yield name, content


def _tags(data: bytes) -> tuple[dict[str, str], int]:
    """Text frames of an ID3v2.2, 2.3 or 2.4 tag in front, and its whole size with padding and footer."""
    if data[:3] != b"ID3" or len(data) < 10 or not 2 <= data[3] <= 4 or max(data[6:10]) > 0x7F:
        return {}, 0
    version, flags, n = data[3], data[5], _safe(data[6:10])
    out: dict[str, str] = {}
    for name, content in () if version == 2 and flags & 0x40 else _frames(data[10 : 10 + n], version, flags):
        if name.startswith("T"):
            key, _, value = _text(content).partition("\0") if name in ("TXXX", "TXX") else (name, "", _text(content))
            out[key] = value
    return out, 10 + n + (10 if version == 4 and flags & 0x10 else 0)


def _table(data: bytes, at: int, h: Header) -> Table | None:
    """The variable-bitrate header that a frame holds, if any; offsets count from the frame."""
    number = lambda p, n: int.from_bytes(data[p : p + n], "big")
    p = at + 36
    if data[p : p + 4] == b"VBRI" and h.size >= 62:
        total, frames, entries, scale, wide = number(p + 10, 4), number(p + 14, 4), number(p + 18, 2), number(p + 20, 2), number(p + 22, 2)
        steps = [number(p + 26 + i * wide, wide) * scale for i in range(entries) if p + 26 + (i + 1) * wide <= at + h.size] if wide else []
        return Table("VBRI", frames, total, [0, *np.cumsum(steps, dtype=np.int64).tolist()][: len(steps)])
    p = at + (6 if h.checked else 4) + h.side
    for p in dict.fromkeys((p, at + 4 + h.side)):  # many writers forget the checksum's two bytes
        kind = data[p : p + 4]
        if kind in (b"Xing", b"Info"):
            flags, q = number(p + 4, 4), p + 8
            frames, q = (number(q, 4), q + 4) if flags & 1 else (None, q)
            total, q = (number(q, 4), q + 4) if flags & 2 else (None, q)
            toc = data[q : q + 100] if flags & 4 else b""
            return Table(kind.decode(), frames, total, [x * total // 256 for x in toc] if total is not None else [])
    return None


def read(data: bytes) -> Stream:
    """Parse a stream of Layer I, II or III; it may be cut short or hold foreign bytes.  Checksums are verified for Layer III."""
    out = Stream()
    out.tags, at = _tags(data)
    end = len(data)
    if end >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        out.tags.setdefault("title", data[end + 3 : end + 33].rstrip(b"\0 ").decode("latin-1"))
    parts, synced = [], False
    while at < end:
        h = parse_header(data[at : at + 4])
        # out of step, a header counts only if another frame of its kind or the end follows it
        if h is None or at + h.size > end or (not synced and at + h.size < end and not h.continues(parse_header(data[at + h.size : at + h.size + 4]))):
            following = data.find(b"\xff", at + 1, end)
            following = end if following < 0 else following
            out.skipped += following - at
            at, synced = following, False
            continue
        synced = True
        body = at + (6 if h.checked else 4) + h.side
        if h.checked and h.layer == 3 and struct.unpack(">H", data[at + 4 : at + 6])[0] != checksum(data[at + 2 : at + 4] + data[at + 6 : body]):
            out.bad += 1
        first = out.table is None and not out.offsets and h.layer == 3
        table = _table(data, at, h) if first else None
        if table is not None:
            out.table = table
        else:
            out.offsets.append(at)
            out.samples += h.samples
            out.seconds += h.samples / h.hertz
            out.hertz, out.layer = h.hertz, h.layer
            out.kbps.add(h.kbps)
            parts.append(data[body : at + h.size])
        at += h.size
    if len(out.offsets) * 1152 >= out.samples and out.hertz and abs(out.seconds - out.samples / out.hertz) < 1e-6:
        out.seconds = out.samples / out.hertz  # one sampling rate: no rounding of sums
    whole = b"".join(parts)
    length = out.tags.get(_LENGTH.decode())
    out.payload = whole[: int(length)] if length is not None and length.isdigit() else whole
    return out


def padded(text: bytes, unit: int = 64) -> bytes:
    """``text`` with zero bytes up to a positive multiple of ``unit``."""
    return text + bytes(-len(text) % unit if text else unit)

#: Bytes of texts or streams that a task works on at once, but for a longer one.
TURN = 4 << 20


def _encode(text: str, names: list[str]):
    def encode(batches):
        for own in batches_of(batches, text, TURN):
            media = [store(padded((t or "").encode())) for t in own[text].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(own[n] for n in names), pa.array(media, pa.binary())], [*names, "media"])

    return encode


def encode_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """Store each text's UTF-8 bytes, padded with zeros to a positive multiple of 64, as MPEG audio in a table of the shared folder.

    Returns the input columns without ``text``, and ``media`` (binary, replaces a column of that name).  A null text counts as empty; equal texts
    give equal streams.
    """
    names = [c for c in docs.columns if c not in (text, "media")]
    schema = T.StructType([docs.schema[n] for n in names]).add("media", "binary")
    return Scratch(docs.sparkSession, "audio").write(docs.select(*names, text).mapInArrow(_encode(text, names), schema), "media")


def _decode(media: str, names: list[str]):
    def decode(batches):
        for own in batches_of(batches, media, TURN):
            got = [read(x or b"") for x in own[media].to_pylist()]
            new = {
                "payload": pa.array([s.payload for s in got], pa.binary()),
                "frames": pa.array([len(s.offsets) for s in got], pa.int64()),
                "hertz": pa.array([s.hertz for s in got], pa.int32()),
                "max_kbps": pa.array([max(s.kbps, default=0) for s in got], pa.int32()),
                "samples": pa.array([s.samples for s in got], pa.int64()),
                "seconds": pa.array([s.seconds for s in got], pa.float64()),
                "bad_checksums": pa.array([s.bad for s in got], pa.int64()),
                "skipped_bytes": pa.array([s.skipped for s in got], pa.int64()),
                "layer": pa.array([s.layer for s in got], pa.int32()),
                "table_kind": pa.array([s.table.kind if s.table else None for s in got], pa.string()),
                "table_frames": pa.array([s.table.frames if s.table else None for s in got], pa.int64()),
                "table_bytes": pa.array([s.table.bytes if s.table else None for s in got], pa.int64()),
                "table_offsets": pa.array([s.table.offsets if s.table else None for s in got], pa.list_(pa.int64())),
                "seek": pa.array([s.offsets for s in got], pa.list_(pa.int64())),
                "tags": pa.array([list(s.tags.items()) for s in got], pa.map_(pa.string(), pa.string())),
            }
            yield pa.RecordBatch.from_arrays([*(own[n] for n in names), *new.values()], [*names, *new])

    return decode


def decode_audio(table: DataFrame, media: str = "media") -> DataFrame:
    """Read MPEG audio: payload, exact duration (frames, samples, seconds), frame seek offsets, tags, variable-bitrate table and checksum errors.

    Layers I to III of MPEG-1, 2 and 2.5; ID3v1 and ID3v2.2 to 2.4 text frames; Xing, Info and VBRI headers, whose frame is no audio.  Streams of free bitrate have
    no frames.

    The other input columns stay, but for those named like a result.  A null or empty stream has no frames; one that is cut short has its
    whole frames.
    """
    made = T.StructType().add("payload", "binary").add("frames", "long").add("hertz", "integer").add("max_kbps", "integer").add("samples", "long")
    made = made.add("seconds", "double").add("bad_checksums", "long").add("skipped_bytes", "long").add("layer", "integer")
    made = made.add("table_kind", "string").add("table_frames", "long").add("table_bytes", "long").add("table_offsets", T.ArrayType(T.LongType()))
    made = made.add("seek", T.ArrayType(T.LongType())).add("tags", T.MapType(T.StringType(), T.StringType()))
    names = [c for c in table.columns if c not in made.names]
    schema = T.StructType([table.schema[n] for n in names] + made.fields)
    return table.select(*dict.fromkeys([*names, media])).mapInArrow(_decode(media, names), schema)
