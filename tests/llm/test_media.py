import hashlib
import zlib

import numpy as np
import pytest
from helpers import ODD, no_documents, odd_documents

from millrace.llm import progressive_jpeg as J
from millrace.llm.media_columns import media_columns, payload_of
from millrace.llm.queries import QUERIES


class Writer:
    """Symbols in codes of eight bits, as a plain encoder for files of any content."""

    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> k & 1 for k in range(n - 1, -1, -1)]

    def signed(self, v):
        n = abs(v).bit_length()
        self.put(v if v > 0 else v + (1 << n) - 1, n)

    def data(self):
        bits = self.bits + [1] * (-len(self.bits) % 8)
        return np.packbits(bits).tobytes().replace(b"\xff", b"\xff\x00")


SYMBOLS = bytes(range(255))


def wide_table(slot):
    """255 symbols in codes of 8 and, for the last ones, 9 bits; the code of ones alone stays free."""
    counts = bytearray(16)
    counts[7], counts[8] = 250, 5
    return J._segment(0xC4, bytes([slot]) + bytes(counts) + SYMBOLS)


def symbol(w, s):
    w.put(s, 8) if s < 250 else w.put((250 << 1) + s - 250, 9)


def ac_first(blocks, first, last, low, runs=True):
    w, eob = Writer(), 0

    def flush():
        nonlocal eob
        while eob:
            r = min(eob.bit_length() - 1, 14 if runs else 0)
            symbol(w, r << 4), w.put(eob - (1 << r) if eob < 2 << r else 0, r)
            eob -= eob if eob < 2 << r else 1 << r

    for b in blocks:
        run = 0
        vals = [int(np.sign(v)) * (abs(int(v)) >> low) for v in b[first : last + 1]]
        end = max((k for k, v in enumerate(vals) if v), default=-1)
        for v in vals[: end + 1]:
            if v == 0:
                run += 1
                continue
            flush()
            while run > 15:
                symbol(w, 0xF0)
                run -= 16
            symbol(w, run << 4 | abs(v).bit_length()), w.signed(v)
            run = 0
        if end < len(vals) - 1:
            eob += 1
    flush()
    return w.data()


def ac_refine(blocks, first, last, low):
    w = Writer()
    for b in blocks:
        vals = [int(v) for v in b[first : last + 1]]
        old, bit = [abs(v) >> (low + 1) for v in vals], [abs(v) >> low & 1 for v in vals]
        fresh = [k for k in range(len(vals)) if not old[k] and bit[k]]
        k = 0
        for f in fresh:
            zeros = [j for j in range(k, f) if not old[j]]
            while len(zeros) > 15:
                symbol(w, 0xF0)
                stop = zeros[15]
                for j in range(k, stop + 1):
                    if old[j]:
                        w.put(bit[j], 1)
                k, zeros = stop + 1, zeros[16:]
            symbol(w, len(zeros) << 4 | 1), w.put(int(vals[f] > 0), 1)
            for j in range(k, f):
                if old[j]:
                    w.put(bit[j], 1)
            k = f + 1
        if k < len(vals):
            symbol(w, 0)
            for j in range(k, len(vals)):
                if old[j]:
                    w.put(bit[j], 1)
    return w.data()


def general_file(y, cb, cr, across, down, height, width):
    """A 4:2:0 file of any coefficients, in many scans of general tables, AC scans covering their own blocks."""
    w = Writer()
    last = [0, 0, 0]
    for u in range(across * down):
        r, c = divmod(u, across)
        for part, which in [(y[(2 * r + dy) * 2 * across + 2 * c + dx], 0) for dy in (0, 1) for dx in (0, 1)] + [(cb[u], 1), (cr[u], 2)]:
            v = int(part[0]) >> 1
            d, last[which] = v - last[which], v
            symbol(w, abs(d).bit_length())
            if d:
                w.signed(d)
    out = [b"\xff\xd8", J._segment(0xDB, bytes([0]) + bytes(range(1, 65))), J._segment(0xC2, b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + b"\x03\x01\x22\x00\x02\x11\x00\x03\x11\x00"), wide_table(0), wide_table(0x10), J._start(J._ALL, 0, 0, 0, 1), w.data()]
    own = lambda blocks, wide, ow, oh: [blocks[r * wide + c] for r in range(oh) for c in range(ow)]
    parts = [(1, own(y, 2 * across, -(-width // 8), -(-height // 8))), (2, own(cb, across, -(-(-(-width // 2)) // 8), -(-(-(-height // 2)) // 8))), (3, own(cr, across, -(-(-(-width // 2)) // 8), -(-(-(-height // 2)) // 8)))]
    for ident, blocks in parts:
        out += [J._start(bytes([ident, 0]), 1, 5, 0, 2), ac_first(blocks, 1, 5, 2), J._start(bytes([ident, 0]), 6, 63, 0, 2), ac_first(blocks, 6, 63, 2)]
        for low in (1, 0):
            out += [J._start(bytes([ident, 0]), 1, 63, low + 1, low), ac_refine(blocks, 1, 63, low)]
    w = Writer()
    for u in range(across * down):
        r, c = divmod(u, across)
        for part in [y[(2 * r + dy) * 2 * across + 2 * c + dx] for dy in (0, 1) for dx in (0, 1)] + [cb[u], cr[u]]:
            w.put(int(part[0]) & 1, 1)
    return b"".join([*out, J._start(J._ALL, 0, 0, 1, 0), w.data(), b"\xff\xd9"])


def test_general_scans():
    rng = np.random.default_rng(6)
    across, down, height, width = 3, 2, 32, 48
    shape = lambda n: np.where(rng.random((n, 64)) < 0.2, rng.integers(-60, 60, (n, 64)), 0)
    y, cb, cr = shape(4 * across * down), shape(across * down), shape(across * down)
    y[3, 1:] = 0
    image = J.decode(general_file(y, cb, cr, across, down, height, width))
    for c, want in zip(image.components, (y, cb, cr), strict=True):
        assert (c.coefficients == want).all()
    rgb = J.to_rgb(image)
    assert rgb.shape == (height, width, 3)


def test_sizes_that_are_no_multiple():
    rng = np.random.default_rng(7)
    y, cb, cr = (rng.integers(-9, 9, (n, 64)) for n in (24, 6, 6))
    image = J.decode(general_file(y, cb, cr, 3, 2, 19, 35))
    assert J.to_rgb(image).shape == (19, 35, 3)
    assert (image.components[0].coefficients[[0, 1, 6, 7]] == y[[0, 1, 6, 7]]).all()


def test_inverse_transform_by_definition():
    c = J.Component(1, 1, 1, 0, 1, 1)
    rng = np.random.default_rng(1)
    c.coefficients = rng.integers(-50, 50, (1, 64)).astype(np.int32)
    block = np.zeros(64)
    block[J.zigzag()] = c.coefficients[0]
    block = block.reshape(8, 8)
    k = lambda u: np.sqrt(0.5) if u == 0 else 1.0
    want = [[sum(k(u) * k(v) / 4 * block[v, u] * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16) for u in range(8) for v in range(8)) for x in range(8)] for y in range(8)]
    assert (J.samples(c, np.ones(64)) == np.clip(np.rint(want) + 128, 0, 255)).all()


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 100, 30_000])
def test_payload_round_trip(n):
    payload = np.random.default_rng(n).integers(0, 256, 64 * n, dtype=np.uint8).tobytes()
    media = J.encode_payload(payload)
    assert J.read_payload(J.decode(media)) == payload and media[:2] == b"\xff\xd8" and media[-2:] == b"\xff\xd9"


@pytest.mark.parametrize("byte", [0, 127, 128, 255])
def test_constant_payloads(byte):
    assert J.read_payload(J.decode(J.encode_payload(bytes([byte]) * 640))) == bytes([byte]) * 640


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = {r.doc_id: r for r in media_columns(docs).collect()}
    for k, t in enumerate(ODD):
        raw = (t or "").encode()
        r = rows[k]
        assert r.n_bytes == len(raw) and r.payload == payload_of(t) and r.payload[: len(raw)] == raw and len(r.payload) % 64 == 0 < len(r.payload)
        assert len(r.rgb) == r.height * r.width * 3
    assert rows[7].media == rows[8].media and rows[7].feature == rows[8].feature and rows[0].media == rows[1].media
    assert media_columns(no_documents(spark)).count() == 0


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op9_media_columns"](spark, sf).collect():
        p = payload_of(texts[r.doc_id])
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        m = J.encode_payload(p)
        assert (r.media_bytes, r.media_sha256) == (len(m), hashlib.sha256(m).hexdigest())
