import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tractloom.llm import flac


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=1800), min_size=1, max_size=5))
def test_round_trip(texts):
    payloads = [t + b"\xff" * (-len(t) % 576 if t else 576) for t in texts]
    assert flac.decode(flac.encode(payloads)) == payloads


def test_kinds_of_blocks_and_long_codes():
    rng = np.random.default_rng(0)
    spike = bytearray(b"\x80" * 576)
    spike[300] = 0
    payloads = [
        b"a" * 576 * 3, bytes(rng.integers(0, 256, 576 * 4, dtype=np.uint8)), bytes(range(256)) * 9, bytes(spike), ("the and of " * 500).encode()[: 576 * 9],
        bytes(np.clip(128 + np.cumsum(rng.integers(-2, 3, 576 * 5)), 0, 255).astype(np.uint8)), b"text " * 576 * 40,
    ]
    files = flac.encode(payloads)
    assert flac.decode(files) == payloads
    assert len(files[5]) < 0.6 * len(payloads[5])
    kinds = {f[flac.parse(f)[2] + 6] for f in files}
    assert {0, 2} <= kinds and len(kinds) > 3  # constant, verbatim and predicted frames all occur


def test_headers_follow_the_format():
    assert flac.coded_number(0x7F) == b"\x7f" and flac.coded_number(0x80) == "\u0080".encode() and flac.coded_number(0x7FF) == "߿".encode() and flac.coded_number(0x10000) == "\U00010000".encode()
    p = b"some text with words " * 28
    p = p[:576]
    f = flac.encode([p])[0]
    samples, md5, start, points = flac.parse(f)
    assert f[:4] == b"fLaC" and samples == 576 and points == [(0, 0)] and md5 == hashlib.md5(bytes(b ^ 0x80 for b in p)).digest()
    assert f[start : start + 2] == b"\xff\xf8" and f[start + 2] == 0x24 and f[start + 3] == 2


class Tape:
    """Bits read and written one by one."""

    def __init__(self, bits=""):
        self.bits, self.at = bits, 0

    def take(self, n):
        self.at += n
        return int(self.bits[self.at - n : self.at] or "0", 2)

    def signed(self, n):
        v = self.take(n)
        return v - (1 << n) if n and v >> (n - 1) else v

    def put(self, v, n):
        self.bits += format(v & ((1 << n) - 1), f"0{n}b") if n else ""


def crc(data, polynomial, width):
    c = 0
    for b in data:
        c ^= b << (width - 8)
        for _ in range(8):
            c = ((c << 1) ^ (polynomial if c >> (width - 1) else 0)) & ((1 << width) - 1)
    return c


def slow_decode(file):
    """A plain reader of one frame after the other, by the format's definition."""
    samples, _, start, _ = flac.parse(file)
    out = []
    at = start
    while len(out) < samples:
        head = 4
        while file[at + head] & 0xC0 == 0x80 or head == 4:
            head += 1
        assert crc(file[at : at + head], 0x07, 8) == file[at + head]
        t = Tape("".join(f"{b:08b}" for b in file[at + head + 1 : at + 2000]))
        kind = t.take(8) >> 1
        x = []
        if kind == 0:
            x = [t.signed(8)] * 576
        elif kind == 1:
            x = [t.signed(8) for _ in range(576)]
        else:
            order = kind - 31 if kind >= 32 else kind - 8
            x = [t.signed(8) for _ in range(order)]
            coefficients, shift = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]][order] if kind < 32 else None, 0
            if kind >= 32:
                precision, shift = t.take(4) + 1, t.signed(5)
                coefficients = [t.signed(precision) for _ in range(order)]
            wide = 4 + t.take(2)
            parts = 1 << t.take(4)
            for part in range(parts):
                k = t.take(wide)
                raw = t.take(5) if k == (1 << wide) - 1 else None
                for _ in range(576 // parts - (order if part == 0 else 0)):
                    if raw is not None:
                        r = t.signed(raw)
                    else:
                        q = 0
                        while not t.take(1):
                            q += 1
                        z = q << k | t.take(k)
                        r = z >> 1 if z % 2 == 0 else -(z + 1 >> 1)
                    x.append(r + (sum(c * x[-1 - j] for j, c in enumerate(coefficients)) >> shift))
        size = head + 1 + (t.at + 7) // 8
        assert crc(file[at : at + size], 0x8005, 16) == int.from_bytes(file[at + size : at + size + 2], "big")
        out += x
        at += size + 2
    return bytes(v + 128 for v in out)


def wave(n=576 * 3):
    t = np.arange(n)
    return bytes(np.clip(128 + 60 * np.sin(t / 7.3) + 30 * np.sin(t / 3.1) + (t % 144 > 100) * (t * 37 % 23), 0, 255).astype(np.uint8))


def test_frames_are_read_by_a_plain_decoder():
    rng = np.random.default_rng(4)
    payloads = [wave(), b"the and of it " * 42 + b"the!" * 141, bytes(rng.integers(0, 256, 576, dtype=np.uint8)), b"a" * 1152]
    payloads[1] = payloads[1][:1152]
    files = flac.encode(payloads)
    assert [slow_decode(f) for f in files] == payloads == flac.decode(files)
    f = files[0]
    start = flac.parse(f)[2]
    kinds = {flac.encode([payloads[0][a : a + 576]])[0][flac.parse(flac.encode([payloads[0][a : a + 576]])[0])[2] + 6] for a in range(0, 1728, 576)}
    assert any(k & 0x40 for k in kinds), kinds  # LPC is chosen where it is the shortest
    assert start == 42 + 4 + 18 * 3


def foreign(payload, plan, points):
    """A file as another writer might make it: (order, coefficients, shift, method, partition order, escapes) of each block."""
    x = [b - 128 for b in payload]
    frames = []
    for i, (order, coefficients, shift, method, p, escapes) in enumerate(plan):
        own = x[i * 576 : i * 576 + 576]
        t = Tape()
        t.put((32 + order - 1) << 1, 8)
        for v in own[:order]:
            t.put(v, 8)
        t.put(11, 4)
        t.put(shift, 5)
        for c in coefficients:
            t.put(c, 12)
        t.put(method, 2)
        t.put(p, 4)
        size = 576 >> p
        for part in range(1 << p):
            places = range(max(part * size, order), (part + 1) * size)
            rest = [own[j] - (sum(c * own[j - 1 - m] for m, c in enumerate(coefficients)) >> shift) for j in places]
            wide = 4 + method
            if part in escapes:
                width = max(max((r if r >= 0 else ~r).bit_length() for r in rest) + 1, 1)
                t.put((1 << wide) - 1, wide)
                t.put(width, 5)
                for r in rest:
                    t.put(r, width)
            else:
                t.put(part % 5, wide)
                for r in rest:
                    z = 2 * r if r >= 0 else -2 * r - 1
                    t.bits += "0" * (z >> part % 5) + "1"
                    t.put(z, part % 5)
        t.bits += "0" * (-len(t.bits) % 8)
        frame = flac.header(i) + int(t.bits, 2).to_bytes(len(t.bits) // 8, "big")
        frames.append(frame + crc(frame, 0x8005, 16).to_bytes(2, "big"))
    offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames])))
    table = b"".join(int(k * 576).to_bytes(8, "big") + int(offsets[k]).to_bytes(8, "big") + (576).to_bytes(2, "big") for k in points)
    md5 = hashlib.md5(bytes(b ^ 0x80 for b in payload)).digest()
    info = bytes([2, 64, 2, 64]) + bytes(6) + (8000 << 44 | 7 << 36 | len(payload)).to_bytes(8, "big") + md5
    blocks = [b"\x84\x00\x00\x04note"] if not points else [b"\x83" + len(table).to_bytes(3, "big") + table]
    return b"fLaC\x00" + len(info).to_bytes(3, "big") + info + b"".join(blocks) + b"".join(frames)


@pytest.mark.parametrize("points", [(), (2,), (0, 1, 2, 3)])
def test_files_of_other_writers(points):
    payload = wave(576 * 4)
    plan = [(8, [1024, -300, 20, 0, 5, -7, 1, 2], 10, 0, 3, {1, 7}), (1, [1], 0, 1, 0, set()), (12, [900] + [3, -3] * 5 + [1], 9, 1, 4, {0, 5}), (2, [2, -1], 0, 0, 6, {63})]
    f = foreign(payload, plan, points)
    assert slow_decode(f) == payload
    assert flac.decode([f, flac.encode([payload])[0], f]) == [payload] * 3
    for first, count in ((0, 1), (575, 2), (576, 576), (1200, 900), (2303, 50), (2304, 5), (0, 9999)):
        assert flac.read_samples(f, first, count) == payload[first : first + count]


def test_seeking_reads_no_frame_before_the_point():
    payload = wave(576 * 6)
    f = bytearray(flac.encode([payload])[0])
    _, _, start, points = flac.parse(bytes(f))
    f[start + 20] ^= 0xFF  # the first frame is broken
    assert flac.read_samples(bytes(f), 1800, 100) == payload[1800:1900] and len(points) == 6
    with pytest.raises(ValueError):
        flac.read_samples(bytes(f), 10, 5)


def test_cut_streams_raise():
    f = flac.encode([b"words and words " * 36 * 4])[0]
    for size in range(len(f) - 400, len(f) - 1, 37):
        with pytest.raises(ValueError):
            flac.decode([f[:size]])


@pytest.mark.parametrize("at", [-1, -9, 47 + 42])
def test_damage_is_seen(at):
    f = bytearray(flac.encode([b"words and words " * 36 * 4])[0])
    f[at] ^= 1
    with pytest.raises(ValueError):
        flac.decode([bytes(f)])


def test_documents(spark):
    rng = random.Random(1)
    texts = [None, "", "é" * 700, "a" * 576, "".join(rng.choices("abc dé\n", k=300000)), "a" * 576]
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, media string, read string")
    rows = {r.doc_id: r for r in flac.read_media(flac.add_media(d)).collect()}
    for i, t in enumerate(texts):
        p = flac.padded(t)
        assert len(p) % 576 == 0 and len(p) > 0 and rows[i].read.payload_bytes == len(p) and rows[i].read.payload_sha256 == hashlib.sha256(p).hexdigest()
        assert rows[i].read.media_sha256 == hashlib.sha256(bytes(rows[i].media)).hexdigest()
    assert rows[3].read == rows[5].read and rows[0].read == rows[1].read
    pcm = flac.pcm_blocks(flac.add_media(d)).orderBy("doc_id", "first_sample").collect()
    assert b"".join(bytes(r.pcm) for r in pcm if r.doc_id == 4) == flac.padded(texts[4])
    assert [r.first_sample for r in pcm if r.doc_id == 4] == list(range(0, len(flac.padded(texts[4])), 16 * 576))
    assert flac.read_media(flac.add_media(d.limit(0))).count() == 0


def test_query_is_what_sql_says_of_the_payload(spark):
    import duckdb

    from tractloom.llm.queries import media

    sf = "/root/testdata/sf0.001"
    sql = f"""WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM '{sf}/documents.parquet'),
        p AS (SELECT doc_id, octet_length(b) AS n, b || unhex(repeat('FF', (CASE WHEN octet_length(b) = 0 THEN 576 ELSE (576 - octet_length(b) % 576) % 576 END)::INT)) AS payload FROM d)
        SELECT doc_id, n, octet_length(payload), sha256(payload) FROM p ORDER BY ALL"""
    got = sorted((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256) for r in media(spark, sf).collect())
    assert got == duckdb.sql(sql).fetchall()
