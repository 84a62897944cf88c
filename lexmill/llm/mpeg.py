"""MPEG audio: frame headers with resynchronisation, tags, variable-bitrate tables, checksums; and a carrier.

`scan` reads any run of MPEG-1/2/2.5 layer I-III frames. `carry` writes bytes losslessly into a stream of
MPEG-1 layer III frames (mono, 32 kHz, variable bitrate, CRC): a frame whose granules have no coded data is
silence to a decoder, and the rest of its body is ancillary data, which the format leaves to the writer.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

# The standard's bitrate (kbit/s) and sampling-rate (Hz) tables.
BITRATES = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {1: (44100, 48000, 32000), 2: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}

RATE = 32000
SIDE = 17  # bytes of side information in a mono MPEG-1 layer III frame
HEAD = 4 + 2 + SIDE
SAMPLES = 1152


@lru_cache(maxsize=4096)
def header(raw: bytes) -> tuple | None:
    """(version, layer, kbit/s, Hz, has CRC, channels, frame bytes, samples) of four bytes, None if they are no header."""
    if len(raw) < 4 or raw[0] != 0xFF or raw[1] & 0xE0 != 0xE0:
        return None
    version, layer = {0: 2.5, 2: 2, 3: 1}.get(raw[1] >> 3 & 3), {1: 3, 2: 2, 3: 1}.get(raw[1] >> 1 & 3)
    rate_at, bit_at = raw[2] >> 2 & 3, raw[2] >> 4
    if version is None or layer is None or rate_at == 3 or bit_at in (0, 15) or raw[3] & 3 == 2:
        return None
    kbit, hz, pad = BITRATES[1 if version == 1 else 2, layer][bit_at], RATES[version][rate_at], raw[2] >> 1 & 1
    if layer == 1:
        size, samples = (12 * kbit * 1000 // hz + pad) * 4, 384
    else:
        samples = 576 if layer == 3 and version != 1 else 1152
        size = samples // 8 * kbit * 1000 // hz + pad
    return version, layer, kbit, hz, not raw[1] & 1, 1 if raw[3] >> 6 == 3 else 2, size, samples


def _crc_table() -> list[int]:
    out = []
    for byte in range(256):
        x = byte << 8
        for _ in range(8):
            x = x << 1 ^ (0x8005 if x & 0x8000 else 0)
        out.append(x & 0xFFFF)
    return out


_CRC = _crc_table()


@lru_cache(maxsize=4096)
def crc16(data: bytes) -> int:
    """The standard's frame checksum: polynomial 0x8005 from 0xFFFF over the header's last two bytes and what follows the CRC."""
    x = 0xFFFF
    for byte in data:
        x = x << 8 & 0xFF00 ^ _CRC[x >> 8 ^ byte]
    return x


def side_bytes(version: float, channels: int) -> int:
    return {(1, 1): 17, (1, 2): 32}.get((version, channels)) or (9 if channels == 1 else 17)


def _synchsafe(n: int) -> bytes:
    return bytes(n >> 7 * k & 0x7F for k in (3, 2, 1, 0))


@lru_cache(maxsize=16)
def _frame_head(bit_at: int) -> bytes:
    """Header, CRC and empty side information of a carrier frame."""
    head = bytes((0xFF, 0xFA, bit_at << 4 | 2 << 2, 0xC0))
    side = bytes(SIDE)
    return head + crc16(head[2:] + side).to_bytes(2, "big") + side


def _capacity(bit_at: int) -> int:
    return 144 * BITRATES[1, 3][bit_at] * 1000 // RATE - HEAD


_ROOM = [0] + [_capacity(k) for k in range(1, 15)]


def carry(payload: bytes, n_bytes: int) -> bytes:
    """A tagged variable-bitrate stream that holds payload; n_bytes goes to a tag."""
    frames, at, total = [], 0, len(payload)
    while at < total:
        left = total - at
        bit_at = 14 if left >= _ROOM[14] else next(k for k in range(1, 15) if _ROOM[k] >= left)
        body = payload[at : at + _ROOM[bit_at]]
        frames.append(_frame_head(bit_at) + body + bytes(_ROOM[bit_at] - len(body)))
        at += len(body)
    sizes = [len(f) for f in frames]
    whole = 144 + sum(sizes)
    ends, spot = [144], 144
    for s in sizes:
        spot += s
        ends.append(spot)
    toc = bytes(min(255, 256 * ends[k * len(frames) // 100] // whole) for k in range(100))
    info = bytes((0xFF, 0xFB, 1 << 4 | 2 << 2, 0xC0)) + bytes(SIDE) + b"Xing" + (7).to_bytes(4, "big") + len(frames).to_bytes(4, "big") + whole.to_bytes(4, "big") + toc
    text = b"\x00n_bytes\x00%d" % n_bytes
    kept = b"\x00payload_bytes\x00%d" % total
    tag = b"".join(b"TXXX" + len(x).to_bytes(4, "big") + b"\x00\x00" + x for x in (text, kept))
    return b"ID3\x03\x00\x00" + _synchsafe(len(tag)) + tag + info + bytes(144 - len(info)) + b"".join(frames)


@dataclass
class Scan:
    tags: dict = field(default_factory=dict)
    frames: int = 0
    samples: int = 0
    hz: int = 0
    crc_ok: int = 0
    crc_bad: int = 0
    skipped: int = 0
    bitrates: dict = field(default_factory=dict)
    offsets: list = field(default_factory=list)
    vbr: dict = field(default_factory=dict)
    bodies: list = field(default_factory=list)


def _id3v2(data: bytes, tags: dict) -> int:
    size = 10 + sum((b & 0x7F) << 7 * (3 - k) for k, b in enumerate(data[6:10]))
    version, at = data[3], 10
    id_len = 3 if version == 2 else 4
    while at + 10 <= size and data[at : at + id_len].strip(b"\x00"):
        name = data[at : at + id_len].decode("latin-1")
        if version == 2:
            n, body = int.from_bytes(data[at + 3 : at + 6], "big"), at + 6
        elif version == 4:
            n, body = sum((b & 0x7F) << 7 * (3 - k) for k, b in enumerate(data[at + 4 : at + 8])), at + 10
        else:
            n, body = int.from_bytes(data[at + 4 : at + 8], "big"), at + 10
        value = data[body + 1 : min(body + n, size)].decode({1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(data[body], "latin-1") if body < len(data) else "latin-1", "replace")
        key, _, rest = value.partition("\x00")
        tags.update({key: rest} if name in ("TXXX", "TXX") else {name: value.rstrip("\x00")})
        at = body + n
    return min(size, len(data))


def _table(data: bytes, at: int, side: int) -> dict:
    """The variable-bitrate table in a frame, if it is one: Xing/Info after the side information, VBRI at 36."""
    if (kind := data[at + 4 + side : at + 8 + side]) in (b"Xing", b"Info"):
        flags, spot, out = int.from_bytes(data[at + 8 + side : at + 12 + side], "big"), at + 12 + side, {"kind": kind.decode()}
        for bit, name in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out[name] = int.from_bytes(data[spot : spot + 4], "big")
                spot += 4
        if flags & 4:
            out["toc"] = list(data[spot : spot + 100])
        return out
    if data[at + 36 : at + 40] == b"VBRI":
        return {"kind": "VBRI", "bytes": int.from_bytes(data[at + 46 : at + 50], "big"), "frames": int.from_bytes(data[at + 50 : at + 54], "big")}
    return {}


def _plausible(data: bytes, at: int, end: int) -> tuple | None:
    """A header at `at` whose frame ends the data or meets another header of the same version, layer and rate."""
    head = header(data[at : at + 4])
    if head is None or at + head[6] > end:
        return None
    after = at + head[6]
    if after == end or _is_trailer(data, after) or ((x := header(data[after : after + 4])) and (x[:2], x[3]) == (head[:2], head[3])):
        return head
    return None


def _is_trailer(data: bytes, at: int) -> bool:
    """An ID3v1 tag stands at `at`: 128 bytes that end the data. Only asked where a frame has ended, so bytes of a frame's
    body are never taken for one."""
    return len(data) - at == 128 and data[at : at + 3] == b"TAG"


def scan(data: bytes) -> Scan:
    """Reads a stream: bytes that fit no frame are skipped up to the next plausible header."""
    out, at, end = Scan(), 0, len(data)
    while data[at : at + 3] == b"ID3" and end - at >= 10:
        at += _id3v2(data[at:], out.tags)
    first = True
    while at + 4 <= end:
        if _is_trailer(data, at):
            out.tags.setdefault("title", data[at + 3 : at + 33].split(b"\x00")[0].decode("latin-1"))
            at = end
            break
        head = header(data[at : at + 4])
        if head is None or at + head[6] > end or (first and not _plausible(data, at, end)):
            step = data.find(b"\xff", at + 1, end)
            while step >= 0 and not _plausible(data, step, end):
                step = data.find(b"\xff", step + 1, end)
            if step < 0:
                step = end - 128 if at < end - 128 and _is_trailer(data, end - 128) else end
            out.skipped += step - at
            at = step
            continue
        version, layer, kbit, hz, has_crc, channels, size, samples = head
        side = side_bytes(version, channels) if layer == 3 else 0
        if first and layer == 3 and (table := _table(data, at, side + 2 * has_crc) or _table(data, at, side)):
            out.vbr = table
            first = False
            at += size
            continue
        first = False
        start = at + 4
        if has_crc:
            start += 2
            if layer == 3:
                good = crc16(data[at + 2 : at + 4] + data[start : start + side]) == int.from_bytes(data[at + 4 : at + 6], "big")
                out.crc_ok += good
                out.crc_bad += not good
        out.bodies.append(data[start + side : at + size])
        out.offsets.append(at)
        out.bitrates[kbit] = out.bitrates.get(kbit, 0) + 1
        out.frames += 1
        out.samples += samples
        out.hz = hz
        at += size
    out.skipped += end - at
    return out
