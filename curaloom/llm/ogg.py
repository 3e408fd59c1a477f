"""Media columns: Ogg physical streams, written and read back page by page.

Writing: a logical stream is a list of packets with granule positions; pages carry lacing values, a
sequence number and the page checksum, and packets may span pages. Several logical streams are
multiplexed: all first pages, then the rest by time.

Reading: checksums are verified, packets reassembled from the lacing values, logical streams told apart
by serial number, and timestamps derived from granule positions.

The payload of the media column is stored as unsigned 8-bit samples (one channel, RATE a second) in one
stream; a second stream holds, for every sample packet, a cue packet with the packet's CRC-32.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaloom.llm import runtime

RATE, PACKET, ALIGN = 8000, 4096, 64
_HEADER = "<4sBBqIIIB"
_CONTINUED, _FIRST, _LAST = 1, 2, 4
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


class OggError(ValueError):
    """A stream that breaks the format: a checksum, a sequence number or a packet that doesn't end."""


def page_crc(page: bytes) -> int:
    """The format's checksum (polynomial 0x04C11DB7, most significant bit first, zero start), by way of zlib's mirrored one."""
    mirrored = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(_REVERSED), "big")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = struct.pack(_HEADER, b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    crc = page_crc(head + body)
    return head[:22] + crc.to_bytes(4, "little") + head[26:] + body


@dataclass
class Packet:
    data: bytes
    granule: int


def pages(serial: int, packets: list[Packet]) -> list[tuple[int, bytes]]:
    """(granule, page) of one logical stream; its first packet has a page of its own. A page on which no packet ends has granule -1."""
    out, number = [], 0
    lacing, body, granule, continued = bytearray(), bytearray(), -1, False

    def flush(last: bool, opened: bool) -> None:
        nonlocal number, lacing, body, granule, continued
        flags = _CONTINUED * continued | _FIRST * (number == 0) | _LAST * last
        out.append((granule, _page(flags, granule, serial, number, bytes(lacing), bytes(body))))
        number += 1
        lacing, body, granule, continued = bytearray(), bytearray(), -1, opened

    for i, packet in enumerate(packets):
        sizes = [255] * (len(packet.data) // 255) + [len(packet.data) % 255]
        at = 0
        for j, n in enumerate(sizes):
            if len(lacing) == 255:
                flush(False, j > 0)
            lacing.append(n)
            body += packet.data[at : at + n]
            at += n
        granule = packet.granule
        if i == 0 and len(packets) > 1:
            flush(False, False)
    flush(True, False)
    return out


def multiplexed(streams: dict[int, list[Packet]]) -> bytes:
    """Serial -> packets as one physical stream: first pages first, then by time, a stream's own order kept."""
    first, rest = [], []
    for order, (serial, packets) in enumerate(streams.items()):
        mine = pages(serial, packets)
        first.append(mine[0][1])
        time = 0
        for granule, page in mine[1:]:
            time = max(time, granule)
            rest.append((time, order, len(rest), page))
    return b"".join(first + [p[3] for p in sorted(rest)])


@dataclass
class Stream:
    packets: list[Packet] = field(default_factory=list)
    parts: list[bytes] = field(default_factory=list)
    number: int = 0
    ended: bool = False
    n_pages: int = 0


def demultiplexed(media: bytes) -> dict[int, Stream]:
    """The logical streams of a physical one, by serial number, verified. Raises OggError."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(media):
        if at + 27 > len(media):
            raise OggError("truncated header")
        magic, version, flags, granule, serial, number, crc, n = struct.unpack_from(_HEADER, media, at)
        if magic != b"OggS" or version:
            raise OggError("no page here")
        lacing = media[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(lacing)
        if end > len(media):
            raise OggError("truncated page")
        if page_crc(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : end]) != crc:
            raise OggError("checksum")
        s = streams.get(serial)
        if s is None:
            if not flags & _FIRST:
                raise OggError("stream without first page")
            s = streams[serial] = Stream()
        elif flags & _FIRST or s.ended:
            raise OggError("page after the end or second first page")
        if number != s.number or bool(flags & _CONTINUED) != bool(s.parts):
            raise OggError("lost page")
        s.number, s.n_pages = number + 1, s.n_pages + 1
        place, done = at + 27 + n, []
        for size in lacing:
            s.parts.append(media[place : place + size])
            place += size
            if size < 255:
                done.append(b"".join(s.parts))
                s.parts = []
        s.packets += [Packet(d, -1) for d in done]
        if done:
            s.packets[-1].granule = granule
        s.ended = bool(flags & _LAST)
        at = end
    if any(s.parts or not s.ended for s in streams.values()):
        raise OggError("stream without end")
    return streams


def padded(text: bytes) -> bytes:
    return text + bytes(-len(text) % ALIGN if text else ALIGN)


def encode(payload: bytes) -> bytes:
    """The payload as samples and cues; serial numbers come from the payload, so equal payloads give equal media."""
    serial = zlib.crc32(payload)
    head = b"PCM8\0" + struct.pack("<IIQ", RATE, PACKET, len(payload))
    samples, cues = [Packet(head, 0)], [Packet(b"CUES\0" + struct.pack("<I", RATE), 0)]
    for at in range(0, len(payload), PACKET):
        block = payload[at : at + PACKET]
        samples.append(Packet(block, at + len(block)))
        cues.append(Packet(zlib.crc32(block).to_bytes(4, "little"), at + len(block)))
    return multiplexed({serial: samples, serial ^ 0xFFFFFFFF: cues})


@dataclass
class Decoded:
    payload: bytes
    rate: int
    times: list[float]
    n_pages: int


def decode(media: bytes) -> Decoded:
    """The samples and the time in seconds at each sample packet's end; cues and length are verified."""
    streams = demultiplexed(media)
    sound, cues = (next((s for s in streams.values() if s.packets and s.packets[0].data.startswith(head)), None) for head in (b"PCM8\0", b"CUES\0"))
    if sound is None or cues is None or len(sound.packets[0].data) != 21:
        raise OggError("no samples or no cues")
    rate, _, total = struct.unpack_from("<IIQ", sound.packets[0].data, 5)
    blocks = [p.data for p in sound.packets[1:]]
    if [zlib.crc32(b).to_bytes(4, "little") for b in blocks] != [p.data for p in cues.packets[1:]]:
        raise OggError("cues")
    payload = b"".join(blocks)
    if len(payload) != total:
        raise OggError("length")
    # only the last packet that ends on a page has the page's granule position; the others follow from their lengths back from it
    times, position = [0.0] * len(blocks), 0
    for i in range(len(blocks) - 1, -1, -1):
        granule = sound.packets[i + 1].granule
        position = granule if granule >= 0 else position
        times[i] = position / rate
        position -= len(blocks[i])
    return Decoded(payload, rate, times, sum(s.n_pages for s in streams.values()))


def feature(d: Decoded) -> str:
    """Duration, packets, pages, and of the samples: mean, deviation, zero crossings and energy in four bands of differences."""
    x = np.frombuffer(d.payload, np.uint8).astype(np.float32) - 128
    crossings = int(np.count_nonzero(np.signbit(x[1:]) != np.signbit(x[:-1])))
    bands = [float(np.abs(x[k:] - x[:-k]).mean()) for k in (1, 2, 4, 8)]
    return f"{d.times[-1]:.6f};{len(d.times)};{d.n_pages};{x.mean(dtype=np.float64):.4f};{x.std(dtype=np.float64):.4f};{crossings};" + ",".join(f"{b:.4f}" for b in bands)


def _encoded(batches):
    for batch in batches:
        texts = [t or b"" for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([encode(padded(t)) for t in texts], pa.binary())], names=["doc_id", "n_bytes", "media"])


def media_column(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: every whole text of docs as an Ogg stream. Null text counts as empty, which is 64 zero samples."""
    runtime.bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(_encoded, "doc_id long, n_bytes long, media binary")


def _read_back(batches):
    for batch in batches:
        out = []
        for n, media in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            d = decode(media)
            out.append((n, len(d.payload), hashlib.sha256(d.payload).hexdigest(), zlib.crc32(d.payload[-ALIGN:]), len(media), hashlib.sha256(media).hexdigest(), feature(d)))
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def media_features(media: DataFrame) -> DataFrame:
    """The digest columns of a media column, from the stored bytes as read back."""
    return media.mapInArrow(_read_back, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
