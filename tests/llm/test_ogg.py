import hashlib
import random
import struct
import zlib

import pytest

from rosterline.llm import ogg

SCHEMA = "doc_id long, text string, payload string, feature int"


def slow_checksum(data):
    r = 0
    for byte in data:
        r ^= byte << 24
        for _ in range(8):
            r = ((r << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if r & 0x80000000 else r << 1
    return r


def test_checksum_is_the_bitwise_one():
    r = random.Random(1)
    for n in (0, 1, 27, 500):
        data = bytes(r.randrange(256) for _ in range(n))
        assert ogg.page_checksum(data) == slow_checksum(data)


@pytest.mark.parametrize("n", [0, 1, 575, 576, 577, 576 * 170, 576 * 1000 + 3])
def test_round_trip(n):
    payload = ogg.pad(random.Random(n).randbytes(n))
    media = ogg.write_ogg(payload)
    back, facts = ogg.read_ogg(media)
    assert back == payload and len(payload) % 576 == 0 and payload and facts["packets"] == len(payload) // 576
    ends = [t[-1] for t in facts["times"]]
    assert abs(sum(ends) * ogg.RATE - len(payload)) < 1e-6 and all(sorted(t) == t for t in facts["times"])


def test_packets_over_several_pages():
    packets = [b"a" * 70_000, b"", b"b" * 255, b"c" * 510, b"d" * 200_000]
    back, facts = ogg.read_ogg(b"".join(ogg._stream_pages(packets, 7)))
    assert back == b"".join(packets) and facts["packets"] == 5 and facts["pages"] >= 5


@pytest.mark.parametrize("where", [5, 22, 40, -1])
def test_a_changed_byte_is_found(where):
    media = bytearray(ogg.write_ogg(ogg.pad(b"hello" * 500)))
    media[where] ^= 1
    with pytest.raises((ValueError, struct.error)):
        ogg.read_ogg(bytes(media))


def test_a_lost_page_is_found():
    pages = ogg._stream_pages([b"x" * 576] * 100, 3)
    with pytest.raises(ValueError):
        ogg.read_ogg(b"".join(pages[:2] + pages[3:]))


def test_columns(spark):
    texts = ["", None, "é😀", "same", "same", "x" * 5000]
    docs = spark.createDataFrame([(i if i else None, t, "p", 1) for i, t in enumerate(texts)], SCHEMA)
    rows = {r["doc_id"]: r for r in ogg.ogg_media(docs).collect()}
    for i, t in enumerate(texts):
        r = rows[i if i else None]
        payload = ogg.pad((t or "").encode())
        assert bytes(r["payload"]) == payload and r["n_bytes"] == len((t or "").encode()) and bytes(r["media"]) == ogg.write_ogg(payload)
        assert zlib.crc32(bytes(r["payload"])[-32:]) == zlib.crc32(payload[-32:])
    assert rows[3]["media"] == rows[4]["media"] and rows[3]["feature"] == rows[4]["feature"] != rows[5]["feature"]
    assert hashlib.sha256(rows[1]["media"]).digest() == hashlib.sha256(rows[None]["media"]).digest()
    assert ogg.ogg_media(docs.limit(0)).count() == 0
