"""Media columns: FLAC frames of 8-bit mono samples, written and read back in numpy, with seekable sample offsets.

A payload is a byte string cut into blocks of BLOCK samples (a byte less 128 is a sample). A frame holds a block: its
header with a CRC-8, one subframe, and a CRC-16. A subframe is constant, verbatim, or predicted: by a fixed polynomial of
order 0 to 4, or by LPC coefficients fitted to the block and quantised; the residuals are Rice codes in 1, 2, 4 or 8
partitions, whichever takes the fewest bits. The stream starts with STREAMINFO (sizes, MD5 of the samples) and a
SEEKTABLE of byte offsets by sample number. Frames of a run of blocks are made and read in step, one numpy operation
for all of them at a time; at most RUN blocks are held at once, so memory does not grow with a payload.

Reading takes LPC of any order and precision, both lengths of Rice parameters and unencoded partitions, and streams of
any number of seek points: frames between two points are read one after the other, all of them from the first on without
a point. `read_samples` starts at the last point before a sample. PCM blocks carry the number of their first sample.
Reading verifies the CRC of every header and frame, its number and block size, the sample count and the MD5, and raises
ValueError on a mismatch. It also does so for what no payload here needs: other rates of bits or channels, other block
sizes, and samples with wasted bits.

Defined cases: a null text counts as empty; an empty payload is padded to one block; a payload must otherwise be whole
blocks; equal texts have equal values; an empty table gives an empty result; input columns named like an output are
replaced; a null file has no PCM blocks, and null values.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 576
PAD = b"\xff"
RATE = 8000
RUN = 3072
SEEK_EVERY = 1
MAX_ORDER = 4
LPC_ORDER, LPC_PRECISION = 4, 7
PARTITION_ORDERS = (0, 1, 2, 3)
PCM_BLOCKS = 16
# CRC polynomials and header codes of the format.
CRC8, CRC16 = 0x07, 0x8005
BLOCK_SIZE_CODE, RATE_CODE, SAMPLE_SIZE_CODE = 0b0010, 0b0100, 0b001


def crc_table(polynomial: int, bits: int) -> np.ndarray:
    out = np.zeros(256, dtype=np.uint32)
    for i in range(256):
        c = i << (bits - 8)
        for _ in range(8):
            c = ((c << 1) ^ polynomial) if c >> (bits - 1) & 1 else c << 1
        out[i] = c & ((1 << bits) - 1)
    return out


TABLE8, TABLE16 = crc_table(CRC8, 8), crc_table(CRC16, 16)


def crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, bits: int) -> np.ndarray:
    """CRC of data[start:start+length] for all starts at once."""
    table = TABLE8 if bits == 8 else TABLE16
    out = np.zeros(len(starts), dtype=np.uint32)
    order = np.argsort(-lengths, kind="stable")
    at, ends = starts[order].astype(np.int64), lengths[order]
    live = len(order)
    c = np.zeros(len(order), dtype=np.uint32)
    for i in range(int(lengths.max(initial=0))):
        while live and ends[live - 1] <= i:
            live -= 1
        b = data[at[:live] + i]
        c[:live] = table[c[:live] ^ b] if bits == 8 else ((c[:live] << 8) & 0xFFFF) ^ table[(c[:live] >> 8) ^ b]
    out[order] = c
    return out


def coded_number(n: int) -> bytes:
    """The frame number as the format codes it (like UTF-8, up to 36 bits)."""
    if n < 0x80:
        return bytes([n])
    more = 1
    while n >> (6 * more + 6 - more):
        more += 1
    return bytes([(0xFF00 >> (more + 1)) & 0xFF | n >> 6 * more]) + bytes(0x80 | n >> 6 * k & 0x3F for k in range(more - 1, -1, -1))


def header(number: int) -> bytes:
    h = bytes([0xFF, 0xF8, BLOCK_SIZE_CODE << 4 | RATE_CODE, SAMPLE_SIZE_CODE << 1]) + coded_number(number)
    c = 0
    for b in h:
        c = int(TABLE8[c ^ b])
    return h + bytes([c])


def lpc(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (newest sample first) as integers and their shifts, fitted to each row by Levinson's recursion."""
    f = x.astype(np.float32)
    r = [np.einsum("ij,ij->i", f[:, k:], f[:, : f.shape[1] - k], dtype=np.float64) for k in range(LPC_ORDER + 1)]
    error = r[0] * (1 + 1e-9) + 1e-9
    a = np.zeros((len(x), LPC_ORDER))
    for k in range(LPC_ORDER):
        turn = (r[k + 1] - sum(a[:, j] * r[k - j] for j in range(k))) / error
        a[:, :k] -= turn[:, None] * a[:, :k][:, ::-1]
        a[:, k] = turn
        error = np.maximum(error * (1 - turn**2), 1e-9)
    most = np.abs(a).max(axis=1)
    shift = np.clip(LPC_PRECISION - 2 - np.floor(np.log2(np.maximum(most, 1e-9))).astype(np.int64), 0, 15)
    limit = 1 << (LPC_PRECISION - 1)
    return np.clip(np.rint(a * (1 << shift)[:, None]), -limit, limit - 1).astype(np.int32), shift.astype(np.int32)


def predicted(x: np.ndarray, coefficients: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """What the coefficients say of every sample after the first ones."""
    order = coefficients.shape[1]
    total = sum(coefficients[:, j : j + 1] * x[:, order - 1 - j : x.shape[1] - 1 - j] for j in range(order))
    return total >> shift[:, None]


def folded(residual: np.ndarray) -> np.ndarray:
    return (residual << 1) ^ (residual >> 31)


def rice_of(total: np.ndarray, count: np.ndarray | int) -> np.ndarray:
    """The parameter that suits numbers of this sum."""
    return np.clip(np.floor(np.log2(np.maximum(total / count * 0.6931 + 0.5, 1))), 0, 13).astype(np.int64)


def partitioned(z: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The partition order of the fewest bits and every number's Rice parameter, for rows of folded residuals."""
    n = len(z)
    full = np.zeros((n, BLOCK), dtype=np.int64)
    full[:, order:] = z
    best, chosen, rice = np.full(n, 1 << 40), np.zeros(n, dtype=np.int64), np.zeros((n, BLOCK), dtype=np.int64)
    for p in PARTITION_ORDERS:
        parts = full.reshape(n, 1 << p, -1)
        count = np.full(1 << p, BLOCK >> p)
        count[0] -= order
        k = rice_of(parts.sum(axis=2), count)
        each = np.repeat(k, BLOCK >> p, axis=1)
        bits = (full >> each).sum(axis=1) + (count * (1 + k)).sum(axis=1) + (4 << p)
        better = bits < best
        best[better], chosen[better], rice[better] = bits[better], p, each[better]
    return chosen, rice[:, order:]


def encode_run(payload: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Frames of the rows of payload (blocks of bytes); first: their frame numbers."""
    x = payload.astype(np.int32) - 128
    n = len(x)
    best, kind = np.full(n, 8 * BLOCK, dtype=np.int64), np.full(n, -1)  # bits of a verbatim block
    residual, found = x, []
    coefficients, shift = lpc(x)
    for o in range(MAX_ORDER + 2):  # the last is LPC
        is_lpc = o > MAX_ORDER
        if is_lpc:
            residual = x[:, LPC_ORDER:] - predicted(x, coefficients, shift)
        elif o:
            residual = np.diff(residual, axis=1)
        z = folded(residual)
        found.append(z)
        k = rice_of(z.sum(axis=1), z.shape[1])
        head = (8 + LPC_PRECISION) * LPC_ORDER + 9 if is_lpc else 8 * o
        bits = head + 10 + (z >> k[:, None]).sum(axis=1) + z.shape[1] * (1 + k)
        better = bits < best
        best[better], kind[better] = bits[better], o
    kind[(x == x[:, :1]).all(axis=1)] = -2
    heads = [header(int(i)) for i in first]
    frames: list[bytes | None] = [None] * n
    for i in np.flatnonzero(kind == -2):
        frames[i] = heads[i] + b"\x00" + bytes([x[i, 0] & 0xFF])
    for i in np.flatnonzero(kind == -1):
        frames[i] = heads[i] + b"\x02" + (x[i] & 0xFF).astype(np.uint8).tobytes()
    for o in range(MAX_ORDER + 2):
        rows = np.flatnonzero(kind == o)
        if len(rows):
            is_lpc = o > MAX_ORDER
            bodies = subframes(x[rows], found[o][rows], LPC_ORDER if is_lpc else o, (coefficients[rows], shift[rows]) if is_lpc else None)
            for i, body in zip(rows, bodies, strict=True):
                frames[i] = heads[i] + body
    joined = np.frombuffer(b"".join(frames), dtype=np.uint8)
    lengths = np.array([len(f) for f in frames])
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    check = crcs(joined, starts, lengths, 16)
    return [f + struct.pack(">H", c) for f, c in zip(frames, check.tolist(), strict=True)]


def subframes(x: np.ndarray, z: np.ndarray, order: int, lpc_of: tuple[np.ndarray, np.ndarray] | None) -> list[bytes]:
    """Predicted subframes of rows of samples with these folded residuals."""
    p, k = partitioned(z, order)
    place = np.arange(order, BLOCK)
    opens = (place % (BLOCK >> p)[:, None] == 0) | (place == order)  # a partition's first code follows its parameter
    warm = 8 + 8 * order + 6 + ((9 + LPC_PRECISION * order) if lpc_of else 0)
    length = (z >> k) + 1 + k + 4 * opens
    ends = np.cumsum(length, axis=1) + warm
    size = (ends[:, -1] + 7) // 8
    base = np.concatenate(([0], np.cumsum(size)))[:-1] * 8
    bits = np.zeros(int(size.sum()) * 8, dtype=np.uint8)

    def put(at: np.ndarray, value: np.ndarray | int, width: int) -> np.ndarray:
        for j in range(width):
            bits[at + j] = (value >> (width - 1 - j)) & 1
        return at + width

    at = put(base, (0b01000000 | (order - 1) << 1) if lpc_of else (0b00010000 | order << 1), 8)
    for j in range(order):
        at = put(at, x[:, j] & 0xFF, 8)
    if lpc_of:
        at = put(put(at, LPC_PRECISION - 1, 4), lpc_of[1], 5)
        for j in range(order):
            at = put(at, lpc_of[0][:, j] & ((1 << LPC_PRECISION) - 1), LPC_PRECISION)
    put(put(at, 0, 2), p, 4)
    stop = base[:, None] + ends - 1 - k
    begun = base[:, None] + ends - length
    for j in range(4):
        bits[begun[opens] + j] = (k[opens] >> (3 - j)) & 1
    bits[stop] = 1
    for j in range(int(k.max(initial=0))):
        own = k > j
        bits[stop[own] + 1 + j] = (z[own] >> (k[own] - 1 - j)) & 1
    packed = np.packbits(bits).tobytes()
    at = base // 8
    return [packed[a:b] for a, b in zip(at.tolist(), (at + size).tolist(), strict=True)]


def stream(payload: bytes, frames: list[bytes]) -> bytes:
    """The whole file: marker, STREAMINFO, SEEKTABLE, frames."""
    lengths = list(map(len, frames))
    samples = np.frombuffer(payload, dtype=np.uint8) ^ 0x80
    info = struct.pack(">HH", BLOCK, BLOCK) + min(lengths).to_bytes(3, "big") + max(lengths).to_bytes(3, "big")
    info += (RATE << 44 | 0 << 41 | 7 << 36 | len(payload)).to_bytes(8, "big") + hashlib.md5(samples.tobytes()).digest()
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    points = b"".join(struct.pack(">QQH", i * BLOCK, int(offsets[i]), BLOCK) for i in range(0, len(frames), SEEK_EVERY))
    return b"fLaC" + bytes([0]) + len(info).to_bytes(3, "big") + info + bytes([0x83]) + len(points).to_bytes(3, "big") + points + b"".join(frames)


def encode(payloads: list[bytes]) -> list[bytes]:
    """FLAC files of payloads, each a positive multiple of BLOCK bytes."""
    counts = [len(p) // BLOCK for p in payloads]
    numbers = np.concatenate([np.arange(c) for c in counts]) if counts else np.zeros(0, dtype=int)
    blocks = np.frombuffer(b"".join(payloads), dtype=np.uint8).reshape(-1, BLOCK)
    frames: list[bytes] = []
    for a in range(0, len(blocks), RUN):
        frames += encode_run(blocks[a : a + RUN], numbers[a : a + RUN])
    out, at = [], 0
    for p, c in zip(payloads, counts, strict=True):
        out.append(stream(p, frames[at : at + c]))
        at += c
    return out


def parse(file: bytes) -> tuple[int, bytes, int, list[tuple[int, int]]]:
    """Samples, MD5, where frames start, and seek points (sample, byte offset from the first frame)."""
    if file[:4] != b"fLaC":
        raise ValueError("no FLAC marker")
    at, last, samples, md5, points = 4, False, 0, b"", []
    while not last:
        last, kind, size = bool(file[at] & 0x80), file[at] & 0x7F, int.from_bytes(file[at + 1 : at + 4], "big")
        body = file[at + 4 : at + 4 + size]
        if kind == 0:
            samples, md5 = int.from_bytes(body[10:18], "big") & ((1 << 36) - 1), body[18:34]
        elif kind == 3:
            points = [struct.unpack(">QQ", body[i : i + 16]) for i in range(0, size, 18)]
        at += 4 + size
    return samples, md5, at, points


def windows(data: np.ndarray) -> np.ndarray:
    """The 32 bits from every byte on."""
    d = np.concatenate([data, np.zeros(4, dtype=np.uint8)]).astype(np.uint32)
    return d[:-4] << 24 | d[1:-3] << 16 | d[2:-2] << 8 | d[3:-1]


LEADING = 16 - np.ceil(np.log2(np.arange(1 << 16) + 1)).astype(np.int64)


def long_code(data: np.ndarray, at: int, k: int) -> tuple[int, int]:
    """One Rice code, bit by bit."""
    bit = lambda i: int(data[i >> 3]) >> (7 - (i & 7)) & 1
    q = 0
    while not bit(at + q):
        q += 1
    rest = 0
    for i in range(k):
        rest = rest << 1 | bit(at + q + 1 + i)
    return q, rest


class Bits:
    """Cursors into bytes, one for each frame, that read in step."""

    def __init__(self, data: np.ndarray, words: np.ndarray, at: np.ndarray) -> None:
        self.data, self.words, self.at = data, words, at

    def take(self, width: np.ndarray | int, rows=slice(None)) -> np.ndarray:
        """Unsigned numbers of up to 25 bits."""
        at = self.at[rows]
        v = (self.words[at >> 3] << (at & 7).astype(np.uint32)).astype(np.uint64)
        self.at[rows] = at + width
        return (v >> np.asarray(32 - width, dtype=np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def signed(self, width: np.ndarray | int, rows=slice(None)) -> np.ndarray:
        v, half = self.take(width, rows), np.left_shift(1, np.asarray(width) - 1)
        return np.where(np.asarray(width) == 0, 0, (v ^ half) - half)


def decode_subframes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of bytes from subframes at the byte offsets, and where each ended. data ends in 8 spare bytes."""
    n = len(at)
    out = np.zeros((n, BLOCK), dtype=np.int32)
    ends = np.zeros(n, dtype=np.int64)
    kinds, words = data[at], windows(data)
    for i in np.flatnonzero(kinds == 0):
        out[i], ends[i] = np.int8(data[at[i] + 1]), at[i] + 2
    rows = np.flatnonzero(kinds == 2)
    if len(rows):
        if (at[rows] + 1 + BLOCK > len(data) - 8).any():
            raise ValueError("stream ends within a frame")
        out[rows] = data[at[rows][:, None] + 1 + np.arange(BLOCK)].view(np.int8)
        ends[rows] = at[rows] + 1 + BLOCK
    for kind in np.unique(kinds[(kinds != 0) & (kinds != 2)]):
        is_lpc, order = bool(kind & 0x40), int(kind >> 1 & 31) + 1 if kind & 0x40 else int(kind >> 1 & 7)
        if kind & 0x81 or not (is_lpc or (kind & 0x70 == 0x10 and order <= MAX_ORDER)):
            raise ValueError("unknown subframe")
        rows = np.flatnonzero(kinds == kind)
        read = Bits(data, words, (at[rows] + 1) * 8)
        out[rows] = decode_predicted(read, order, is_lpc)
        ends[rows] = (read.at + 7) >> 3
    return (out + 128).astype(np.uint8), ends


def decode_predicted(read: Bits, order: int, is_lpc: bool) -> np.ndarray:
    n = len(read.at)
    last = 8 * (len(read.data) - 8)
    block = np.zeros((BLOCK, n), dtype=np.int64)
    for j in range(order):
        block[j] = read.signed(8)
    if is_lpc:
        precision, shift = read.take(4) + 1, read.signed(5)
        if (precision == 16).any() or (shift < 0).any():
            raise ValueError("unknown predictor")
        coefficients = [read.signed(precision) for _ in range(order)]
    method, partitions = read.take(2), read.take(4)
    if (method > 1).any() or (BLOCK % (1 << partitions)).any() or ((BLOCK >> partitions) < order).any():
        raise ValueError("unknown residual coding")
    opening: dict[int, list] = {}
    for p in np.unique(partitions):
        own = np.flatnonzero(partitions == p)
        for i in range(0, BLOCK, BLOCK >> int(p)):
            opening.setdefault(max(i, order), []).append(own)
    k, raw, any_raw, escape = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool), False, np.where(method == 0, 15, 31)
    width = np.zeros(n, dtype=np.int64)  # bits of a sample in a partition that is not encoded
    for i in range(order, BLOCK):
        if i in opening:
            for own in opening[i]:
                k[own] = read.take(4 + method[own], own)
            raw = k == escape
            any_raw = bool(raw.any())
            for own in opening[i] if any_raw else ():
                own = own[raw[own]]
                width[own] = read.take(5, own)
            drop = (32 - k).astype(np.uint32)
            if (read.at > last).any():
                raise ValueError("stream ends within a frame")
        v = read.words[read.at >> 3] << (read.at & 7).astype(np.uint32)
        q = LEADING[v >> 16]
        used = q + 1 + k
        rest = (v << (q + 1).astype(np.uint32)).astype(np.uint64) >> drop
        long = (used > 25) | (q == 16)
        rest = rest.astype(np.int64)
        if long.any():  # such a code does not fit into what one window has
            for j in np.flatnonzero(long & ~raw):
                q[j], rest[j] = long_code(read.data, int(read.at[j]), int(k[j]))
            used = q + 1 + k
        z = (q << k) | rest
        value = (z >> 1) ^ -(z & 1)
        if any_raw:
            own = np.flatnonzero(raw)
            place = read.at[own].copy()
            value[own] = read.signed(width[own], own)
            read.at[own] = place
            used = np.where(raw, width, used)
        read.at = read.at + used
        if is_lpc:
            value += sum(c * block[i - 1 - j] for j, c in enumerate(coefficients)) >> shift
        block[i] = value
    if is_lpc:
        return block.T
    series = block[order:]
    for d in range(order - 1, -1, -1):
        series = np.cumsum(np.concatenate([np.diff(block[: d + 1], n=d, axis=0)[:1], series]), axis=0)
    return series.T


def decode(files: list[bytes]) -> list[bytes]:
    """Payloads of files; frames are found by the seek table, and one by one between its points."""
    payloads = []
    parsed = [parse(f) for f in files]
    group: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal group, held
        if group:
            payloads.extend(decode_group([files[i] for i in group], [parsed[i] for i in group]))
        group, held = [], 0

    for i, (samples, *_) in enumerate(parsed):
        group.append(i)
        held += samples // BLOCK
        if held >= RUN:
            flush()
    flush()
    return payloads


def frames_at(data: np.ndarray, at: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of bytes of the frames at the byte offsets, which have these numbers, and where the next frames are."""
    if (at + 16 > len(data)).any() or ((data[at] != 0xFF) | (data[at + 1] != 0xF8)).any():
        raise ValueError("no frame where one is due")
    if ((data[at + 2] >> 4 != BLOCK_SIZE_CODE) | (data[at + 3] >> 4 != 0) | ~np.isin(data[at + 3] >> 1 & 7, [0, SAMPLE_SIZE_CODE])).any():
        raise ValueError("another block size, channels or sample size")
    lead = data[at + 4]
    more = np.select([lead < 0x80, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC, lead < 0xFE], [0, 1, 2, 3, 4, 5], 6)
    number = np.where(more == 0, lead, lead & (0x3F >> np.minimum(more, 6))).astype(np.int64)
    for k in range(int(more.max(initial=0))):
        number = np.where(more > k, number << 6 | (data[at + 5 + k] & 0x3F), number)
    size = 5 + more + np.select([data[at + 2] & 15 == 12, (data[at + 2] & 15 == 13) | (data[at + 2] & 15 == 14)], [1, 2], 0)  # a rate may follow
    if (crcs(data, at, size, 8) != data[at + size]).any():
        raise ValueError("header checksum")
    if (number != block).any():
        raise ValueError("frame number")
    try:
        samples, ends = decode_subframes(data, at + size + 1)
    except IndexError:
        raise ValueError("stream ends within a frame") from None
    if (ends + 2 > len(data) - 8).any():
        raise ValueError("stream ends within a frame")
    if (crcs(data, at, ends - at, 16) != (data[ends].astype(np.uint32) << 8 | data[ends + 1])).any():
        raise ValueError("frame checksum")
    return samples, ends + 2


def checked_points(samples: int, points: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The seek points in order, with one at the first frame; placeholders are no points."""
    points = [p for p in points if p[0] != (1 << 64) - 1]
    if any(sample % BLOCK or sample >= samples for sample, _ in points):
        raise ValueError("seek point outside the blocks")
    return sorted({(0, 0), *points}) if samples else []


def decode_group(files: list[bytes], parsed: list[tuple]) -> list[bytes]:
    """All seek segments of all files are read in step: the k-th frame of each, then the next of each."""
    data = np.frombuffer(b"".join(files) + bytes(8), dtype=np.uint8)
    base, cursors, owner, block, left = 0, [], [], [], []
    for i, (f, (samples, _, start, points)) in enumerate(zip(files, parsed, strict=True)):
        if samples % BLOCK:
            raise ValueError("samples are not whole blocks")
        points = checked_points(samples, points)
        ends = [sample for sample, _ in points[1:]] + [samples]
        for (sample, offset), end in zip(points, ends, strict=True):
            cursors.append(base + start + offset)
            owner.append(i)
            block.append(sample // BLOCK)
            left.append((end - sample) // BLOCK)
        base += len(f)
    at, owner, block, left = (np.array(v, dtype=np.int64) for v in (cursors, owner, block, left))
    out = [np.zeros((p[0] // BLOCK, BLOCK), dtype=np.uint8) for p in parsed]
    while len(at):
        samples, at = frames_at(data, at, block)
        for i, b, s in zip(owner.tolist(), block.tolist(), samples, strict=True):
            out[i][b] = s
        block, left = block + 1, left - 1
        go = left > 0
        at, owner, block, left = at[go], owner[go], block[go], left[go]
    payloads = [x.tobytes() for x in out]
    for p, (samples, md5, *_) in zip(payloads, parsed, strict=True):
        if len(p) != samples or hashlib.md5((np.frombuffer(p, dtype=np.uint8) ^ 0x80).tobytes()).digest() != md5:
            raise ValueError("samples differ from their MD5")
    return payloads


def read_samples(file: bytes, first: int, count: int) -> bytes:
    """Samples first to first + count - 1 as payload bytes, from the last seek point before them and no further back."""
    samples, _, start, points = parse(file)
    end = min(first + count, samples)
    if first >= end or samples % BLOCK:
        return b""
    data = np.frombuffer(file + bytes(8), dtype=np.uint8)
    sample, offset = max(p for p in checked_points(samples, points) if p[0] <= first)
    at, block, parts = np.array([start + offset]), np.array([sample // BLOCK]), []
    while block[0] * BLOCK < end:
        found, at = frames_at(data, at, block)
        if (block[0] + 1) * BLOCK > first:
            parts.append(found[0].tobytes())
        block = block + 1
    skip = first % BLOCK if parts else 0
    return b"".join(parts)[skip : skip + end - first]


def padded(text: str | None) -> bytes:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + PAD * (-len(data) % BLOCK if data else BLOCK)


def measured(pcm: list[bytes]) -> dict:
    """What a file's PCM blocks say, one block after the other: sizes, digests, and mean, root mean square, zero crossings
    and mean step of the samples, to three digits."""
    sha, n, total, square, cross, steps, last, tail = hashlib.sha256(), 0, 0, 0, 0, 0, None, b""
    for block in pcm:
        sha.update(block)
        tail = (tail + block[-32:])[-32:]
        x = np.frombuffer(block, dtype=np.uint8).astype(np.int64) - 128
        own = x if last is None else np.concatenate(([last], x))
        n, total, square, last = n + len(x), total + int(x.sum()), square + int((x * x).sum()), x[-1]
        cross += int(np.count_nonzero(np.diff(own < 0)))
        steps += int(np.abs(np.diff(own)).sum())
    text = f"mean={total / n:.3f};rms={(square / n) ** 0.5:.3f};crossings={cross};step={steps / max(n - 1, 1):.3f}"
    return {"payload_bytes": n, "payload_sha256": sha.hexdigest(), "tail_crc32": zlib.crc32(tail), "feature": text}


def grouped(payloads: list[bytes], most: int = RUN * BLOCK):
    """Slices of the list with about `most` bytes."""
    a = held = 0
    for b, p in enumerate(payloads):
        held += len(p)
        if held >= most:
            yield payloads[a : b + 1]
            a, held = b + 1, 0
    if a < len(payloads):
        yield payloads[a:]


def add_media(docs: DataFrame, *, text: str = "text", out: str = "media") -> DataFrame:
    """docs with `out`: the FLAC file of each whole text."""

    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([f for part in grouped([padded(t) for t in texts.to_pylist()]) for f in encode(part)], type=pa.binary())

    return docs.withColumn(out, of(F.col(text)))


def pcm_of(payload: bytes, blocks: int = PCM_BLOCKS) -> list[dict]:
    size = blocks * BLOCK
    return [{"first_sample": a, "samples": payload[a : a + size]} for a in range(0, len(payload), size)]


PCM = "array<struct<first_sample:bigint,samples:binary>>"
ARROW_PCM = pa.list_(pa.struct([("first_sample", pa.int64()), ("samples", pa.binary())]))


def add_pcm(docs: DataFrame, *, media: str = "media", out: str = "pcm", blocks: int = PCM_BLOCKS) -> DataFrame:
    """docs with `out`: the decoded samples of each file in blocks by their first sample. A broken file fails the job."""

    @F.arrow_udf(PCM)
    def of(files: pa.Array) -> pa.Array:
        rows: list[list[dict]] = []
        for part in grouped([f for f in files.to_pylist() if f is not None]):
            rows += [pcm_of(p, blocks) for p in decode(part)]
        some = iter(rows)
        return pa.array([next(some) if f.is_valid else None for f in files], type=ARROW_PCM)

    return docs.withColumn(out, of(F.col(media)))


MEASURED = "struct<payload_bytes:bigint,payload_sha256:string,tail_crc32:bigint,feature:string>"
ARROW_MEASURED = pa.struct([("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("feature", pa.string())])


def read_media(docs: DataFrame, *, media: str = "media", out: str = "read") -> DataFrame:
    """docs with `out`: what the PCM blocks of the stored files give, and their size and digest. A null file gives null."""

    @F.arrow_udf(MEASURED)
    def of(pcm: pa.Array) -> pa.Array:
        return pa.array([measured([b["samples"] for b in x.as_py()]) if x.is_valid else None for x in pcm], type=ARROW_MEASURED)

    stored = add_pcm(docs, media=media, out="__pcm").withColumn("__m", of(F.col("__pcm")))
    fields = ["payload_bytes", "payload_sha256", "tail_crc32", "feature"]
    made = F.struct(*[F.col(f"__m.{c}").alias(c) for c in fields[:3]], F.octet_length(media).cast("bigint").alias("media_bytes"), F.sha2(media, 256).alias("media_sha256"), F.col("__m.feature").alias("feature"))
    return stored.withColumn(out, F.when(F.col(media).isNotNull(), made)).drop("__pcm", "__m")


def pcm_blocks(docs: DataFrame, *, key: str = "doc_id", media: str = "media", blocks: int = PCM_BLOCKS) -> DataFrame:
    """key, first_sample, n_samples, pcm: a row for each block of samples."""
    each = add_pcm(docs.select(key, media), media=media, out="__pcm", blocks=blocks).select(key, F.explode("__pcm").alias("b"))
    return each.select(key, "b.first_sample", F.octet_length("b.samples").alias("n_samples"), F.col("b.samples").alias("pcm"))
