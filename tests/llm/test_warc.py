import gzip
import hashlib
import io

import pytest

from curaloom.llm import warc


def archive(*payloads):
    return b"".join(warc.record(i, f"http://a/{i}", p) for i, p in enumerate(payloads))


def test_members_and_framing():
    payloads = [b"", b"x", b"a\r\n\r\nb" * 5, bytes(range(256)) * 4000]
    data = archive(*payloads)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 4
    back = list(warc.records(io.BytesIO(data)))
    assert [p for _, p, _ in back] == payloads and [n for _, _, n in back] == [len(p) for p in payloads]
    assert [h["warc-record-id"] for h, _, _ in back] == [f"<urn:x-page:{i}>" for i in range(4)]


def test_damage_is_found():
    data = archive(b"abc" * 100, b"def" * 100)
    for broken in (data[:-3], data[:50], data + b"zz"):
        with pytest.raises((warc.WarcError, Exception)):
            list(warc.records(io.BytesIO(broken)))
    plain = gzip.decompress(warc.record(1, None, b"abc" * 50))
    for a, b in ((b"abcabc", b"abcabd"), (b"Content-Length: 225", b"Content-Length: 224")):
        assert a in plain or a.startswith(b"Content")
        with pytest.raises(warc.WarcError):
            list(warc.records(io.BytesIO(gzip.compress(plain.replace(a, b, 1) if a in plain else plain[:-1]))))


@pytest.mark.parametrize("few", [True, False])
def test_rows(spark, monkeypatch, few):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 1000 if few else 0)  # both ways of telling what repeats
    long = "é" * 60
    rows = [(3, "http://x/ y", long), (1, None, long), (2, "u", long), (2, "u", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (None, "u", long), (7, "u", "z" * 300_000)]
    pages = spark.createDataFrame([(*r, b"x") for r in rows], "page_id long, url string, html string, payload binary").repartition(3)
    got = warc.summary(warc.read_archives(warc.write_archives(pages))).collect()
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = []
    for p, _, h in rows:
        again = h == long and p != 1
        want.append((p, len((h or "").encode()), digest(h), "revisit" if again else "response", 1 if again else None))
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert warc.summary(warc.read_archives(warc.write_archives(pages.limit(0)))).count() == 0


def test_a_revisit_announces_its_length():
    payload = b"Content-Length: 5\r\n\r\n" * 40
    (head, stored, n), = warc.records(io.BytesIO(warc.record(2, "u", payload, 1, True)))
    assert head["warc-type"] == "revisit" and stored == b"" and n == len(payload)


def test_archives_are_packed_by_size(spark):
    pages = spark.range(400).selectExpr("id as page_id", "'u' as url", "repeat(cast(id as string), 50) as html").repartition(40)
    manifest = warc.write_archives(pages)
    read = warc.read_archives(manifest)
    assert read.rdd.getNumPartitions() <= max(spark.sparkContext.defaultParallelism, 1) and read.count() == 400
