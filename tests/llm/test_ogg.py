import hashlib
import random
import zlib

import pytest

from curaloom.llm import ogg


def slow_crc(data):
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7) & 0xFFFFFFFF if crc & 0x80000000 else crc << 1
    return crc


def test_checksum():
    r = random.Random(1)
    for n in (0, 1, 5, 300):
        data = r.randbytes(n)
        assert ogg.page_crc(data) == slow_crc(data)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 254, 255, 256, 4095, 4096, 4097, 65025, 65026, 300_000])
def test_round_trip(n):
    text = random.Random(n).randbytes(n)
    payload = ogg.padded(text)
    assert len(payload) % 64 == 0 and payload[:n] == text and len(payload) - n in range(0, 65) and payload
    d = ogg.decode(ogg.encode(payload))
    assert d.payload == payload
    assert d.times == [min(k * 4096, len(payload)) / 8000 for k in range(1, -(-len(payload) // 4096) + 1)]


def test_packets_that_span_pages_and_three_streams():
    r = random.Random(2)
    streams = {s: [ogg.Packet(r.randbytes(n), i * 10) for i, n in enumerate([9, 70_000, 0, 255, 510, 1])] for s in (5, 6, 7)}
    back = ogg.demultiplexed(ogg.multiplexed(streams))
    assert {s: [p.data for p in x.packets] for s, x in back.items()} == {s: [p.data for p in x] for s, x in streams.items()}


def test_damage_is_found():
    media = ogg.encode(ogg.padded(b"abc" * 9000))
    for at in (0, 4, 6, 23, 30, 40, len(media) - 1):
        broken = bytearray(media)
        broken[at] ^= 1
        with pytest.raises(ogg.OggError):
            ogg.decode(bytes(broken))
    with pytest.raises(ogg.OggError):
        ogg.decode(media[: len(media) // 2])


def test_media_without_the_expected_streams():
    for streams in ({1: [ogg.Packet(b"other", 0)]}, {1: [ogg.Packet(b"PCM8\0", 0)], 2: [ogg.Packet(b"CUES\0", 0)]}, {}):
        with pytest.raises(ogg.OggError):
            ogg.decode(ogg.multiplexed(streams))


@pytest.mark.parametrize("n", [0, 3, 64, 5000, 70_000])
def test_feature_against_a_loop(n):
    payload = ogg.padded(random.Random(n).randbytes(n))
    media = ogg.encode(payload)
    x = [b - 128 for b in payload]
    mean = sum(x) / len(x)
    deviation = (sum((v - mean) ** 2 for v in x) / len(x)) ** 0.5
    crossings = sum((a < 0) != (b < 0) for a, b in zip(x, x[1:], strict=False))
    bands = [sum(abs(x[i + k] - x[i]) for i in range(len(x) - k)) / (len(x) - k) for k in (1, 2, 4, 8)]
    got = ogg.feature(ogg.decode(media)).split(";")
    assert got[:3] == [f"{len(payload) / 8000:.6f}", str(-(-len(payload) // 4096)), str(media.count(b"OggS"))] and int(got[5]) == crossings
    want = [mean, deviation, *bands]
    assert all(abs(float(g) - w) < 1e-3 for g, w in zip([got[3], got[4], *got[6].split(",")], want, strict=True))


def test_empty_table_and_long_text(spark):
    docs = spark.createDataFrame([(1, "long text " * 300_000)], "doc_id long, text string")
    assert ogg.media_features(ogg.media_column(docs.limit(0))).count() == 0
    assert ogg.media_features(ogg.media_column(docs)).first().payload_bytes == 3_000_000 + 0 if 3_000_000 % 64 == 0 else 3_000_064 - 3_000_000 % 64


def test_query_rows(spark):
    docs = spark.createDataFrame([(1, "é" * 40, 1), (2, None, 2), (3, "", 3), (4, "é" * 40, 4), (None, "x", 5)], "doc_id long, text string, media long")
    rows = {r.doc_id: r for r in ogg.media_features(ogg.media_column(docs)).collect()}
    p = "é".encode() * 40 + bytes(48)
    assert rows[1][1:5] == (80, 128, hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    assert rows[1][1:] == rows[4][1:]
    assert rows[2][1:] == rows[3][1:] and rows[2][1:3] == (0, 64)
    assert rows[None][1] == 1
