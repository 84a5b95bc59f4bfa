"""Progressive JPEG in numpy: coefficient arrays from scans, and samples from coefficients.

``decode`` reads Huffman-coded progressive files of 8 bits and one to four components: it
accumulates DC and AC scans, first and refining, of any spectral band into one array of
coefficients for each component. ``to_rgb`` transforms, upsamples chroma and converts.
Scans whose tables leave only one layout (a single AC symbol, end-of-band runs alone, DC
codes of one length) are read as whole arrays; all others symbol by symbol, to equal effect.

``encode_payload`` stores bytes losslessly in a format that is lossy in its samples: its
unit is the coefficient, so each group of 64 bytes is one block, the first byte its DC
value less 128, byte k its k-th AC value plus 256. All quantisers are one. Positive values
of one magnitude class make every scan but the first one a plain array of bits.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

BLOCK = 64
#: Largest side in units of 16 samples.
MOST_UNITS = 4095
COMMENT = b"payload bytes "

_NEXT = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")


@lru_cache(maxsize=1)
def zigzag() -> np.ndarray:
    """Place in a row-major 8x8 block of each coefficient in scan order."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))
    return np.array([8 * r + c for r, c in cells])


@lru_cache(maxsize=1)
def _basis() -> np.ndarray:
    u, x = np.arange(8)[:, None], np.arange(8)[None, :]
    return np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(1 / 8), 1 / 2)


@dataclass
class Component:
    ident: int
    h: int
    v: int
    quantiser: int
    #: Blocks across and down: those of whole units, and those that scans of this component alone have.
    across: int = 0
    down: int = 0
    own_across: int = 0
    own_down: int = 0
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros((0, BLOCK), np.int32))


@dataclass
class Image:
    height: int
    width: int
    components: list[Component]
    quantisers: dict[int, np.ndarray]
    comment: bytes


class Table:
    """A Huffman table: symbols by (length, code)."""

    def __init__(self, counts: bytes, symbols: bytes):
        self.lengths, self.symbols, self.codes = [n for n, k in enumerate(counts, 1) for _ in range(k)], list(symbols), {}
        code = last = 0
        for n, s in zip(self.lengths, self.symbols, strict=True):
            code <<= n - last if last else n
            last = n
            self.codes[n, code] = s
            code += 1


class Bits:
    """Entropy-coded data, unstuffed, one bit an element."""

    def __init__(self, data: bytes):
        self.bits = np.unpackbits(np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8))
        self.at = 0

    def take(self, n: int) -> int:
        value = 0
        for b in self.bits[self.at : self.at + n].tolist():
            value = 2 * value + b
        self.at += n
        return value

    def symbol(self, table: Table) -> int:
        code = 0
        for n, b in enumerate(self.bits[self.at : self.at + 16].tolist(), 1):
            code = 2 * code + b
            if (n, code) in table.codes:
                self.at += n
                return table.codes[n, code]
        raise ValueError("no such code")

    def signed(self, n: int) -> int:
        value = self.take(n)
        return value if not n or value >> (n - 1) else value - (1 << n) + 1


def _unit_order(parts: list[Component], across: int, down: int) -> list[np.ndarray]:
    """For an interleaved scan, each component's blocks in the order of units."""
    out = []
    for c in parts:
        y, x = np.divmod(np.arange(across * down), across)
        dy, dx = np.divmod(np.arange(c.h * c.v), c.h)
        out.append(((y[:, None] * c.v + dy) * c.across + x[:, None] * c.h + dx).ravel())
    return out


@lru_cache(maxsize=4096)
def _payload_order(across: int, down: int) -> np.ndarray:
    y, c = Component(1, 2, 2, 0, 2 * across, 2 * down), Component(2, 1, 1, 0, across, down)
    luma, chroma = _unit_order([y, c], across, down)
    n = across * down
    return np.concatenate([luma.reshape(n, 4), (chroma + 4 * n)[:, None], (chroma + 5 * n)[:, None]], axis=1).ravel()


def decode(data: bytes) -> Image:
    """The image's coefficients, all scans accumulated."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    at, image, tables, quantisers, interval, comment = 2, None, {}, {}, 0, b""
    while True:
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        if marker == 0xD9:
            break
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xC2:
            image = _frame(body, quantisers)
        elif marker in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("only Huffman-coded progressive files are read")
        elif marker == 0xDB:
            while body:
                n = 128 if body[0] >> 4 else 64
                quantisers[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if n == 128 else np.uint8).astype(np.int32)
                body = body[1 + n :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = Table(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            interval = int.from_bytes(body[:2], "big")
        elif marker == 0xFE:
            comment = body
        elif marker == 0xDA:
            stop = _NEXT.search(data, at)
            end = stop.start() if stop else len(data)
            _scan(image, body, data[at:end], tables, interval)
            at = end
    if image is None:
        raise ValueError("no frame")
    image.comment = comment
    return image


def _frame(body: bytes, quantisers: dict[int, np.ndarray]) -> Image:
    if body[0] != 8:
        raise ValueError("only 8-bit files are read")
    height, width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
    parts = [Component(body[k], body[k + 1] >> 4, body[k + 1] & 15, body[k + 2]) for k in range(6, 6 + 3 * body[5], 3)]
    h, v = max(c.h for c in parts), max(c.v for c in parts)
    for c in parts:
        c.across, c.down = -(-width // (8 * h)) * c.h, -(-height // (8 * v)) * c.v
        c.own_across, c.own_down = -(-(-(-width * c.h // h)) // 8), -(-(-(-height * c.v // v)) // 8)
        c.coefficients = np.zeros((c.across * c.down, BLOCK), np.int32)
    return Image(height, width, parts, quantisers, b"")


def _scan(image: Image, head: bytes, data: bytes, tables: dict[int, Table], interval: int) -> None:
    chosen = {head[k]: head[k + 1] for k in range(1, 1 + 2 * head[0], 2)}
    parts = [c for c in image.components if c.ident in chosen]
    first, last, high, low = head[-3], head[-2], head[-1] >> 4, head[-1] & 15
    if len(parts) > 1:
        c = parts[0]
        orders = _unit_order(parts, c.across // c.h, c.down // c.v)
        each = [c.h * c.v for c in parts]
    else:
        c = parts[0]
        y, x = np.divmod(np.arange(c.own_across * c.own_down), c.own_across)
        orders, each = [y * c.across + x], [1]
    units = len(orders[0]) // each[0]
    pieces = re.split(rb"\xff[\xd0-\xd7]", data) if interval else [data]
    step = interval or units
    for k, piece in enumerate(pieces):
        part = [o[k * step * e : (k + 1) * step * e] for o, e in zip(orders, each, strict=True)]
        if not len(part[0]):
            continue
        bits = Bits(piece)
        if first == 0 and high == 0:
            _dc_first(bits, parts, part, each, [tables[chosen[c.ident] >> 4] for c in parts], low)
        elif first == 0:
            n = len(part[0]) // each[0]
            raw = bits.bits[: n * sum(each)].reshape(n, sum(each)).astype(np.int32) << low
            for c, o, e, a in zip(parts, part, each, np.cumsum([0, *each]), strict=False):
                c.coefficients[o, 0] |= raw[:, a : a + e].ravel()
        elif high == 0:
            _ac_first(bits, parts[0], part[0], tables[0x10 | chosen[parts[0].ident] & 15], first, last, low)
        else:
            _ac_refine(bits, parts[0], part[0], tables[0x10 | chosen[parts[0].ident] & 15], first, last, low)


def _dc_first(bits: Bits, parts: list[Component], orders: list[np.ndarray], each: list[int], tables: list[Table], low: int) -> None:
    units, total = len(orders[0]) // each[0], sum(each)
    lengths = {n for t in tables for n in t.lengths}
    if len(lengths) == 1 and len({id(t) for t in tables}) == 1 and all(s <= 11 for s in tables[0].symbols):
        # codes of one length: where a code starts says where the next one does
        n = lengths.pop()
        span = n + 11
        padded = np.concatenate([bits.bits, np.zeros(span, np.uint8)])
        sizes = np.zeros(1 << n, np.int64)
        for (_, code), s in tables[0].codes.items():
            sizes[code] = s
        code = np.zeros(len(bits.bits), np.int64)
        for k in range(n):
            code = 2 * code + padded[k : k + len(code)]
        size = sizes[code]
        following, at, starts = (np.arange(len(code)) + n + size).tolist(), 0, []
        for _ in range(units * total):
            starts.append(at)
            at = following[at]
        starts = np.array(starts)
        size = size[starts]
        wide = np.zeros(len(starts), np.int64)
        for k in range(11):
            wide = 2 * wide + padded[starts + n + k]
        value = wide >> (11 - size)
        diffs = np.where((size > 0) & (value < (1 << np.maximum(size - 1, 0))), value - (1 << size) + 1, value)
    else:
        owner = np.repeat(np.arange(len(parts)), each).tolist() * units
        diffs = np.array([bits.signed(bits.symbol(tables[k])) for k in owner])
    diffs = diffs.reshape(units, total)
    for c, o, e, a in zip(parts, orders, each, np.cumsum([0, *each]), strict=False):
        c.coefficients[o, 0] = np.cumsum(diffs[:, a : a + e].ravel()) << low


def _ac_first(bits: Bits, c: Component, order: np.ndarray, table: Table, first: int, last: int, low: int) -> None:
    band = last - first + 1
    if len(table.symbols) == 1 and 0 < table.symbols[0] < 16:
        # one symbol, a value without zeros before it: every value takes as many bits
        n, size = table.lengths[0], table.symbols[0]
        raw = bits.bits[: len(order) * band * (n + size)].reshape(-1, n + size)
        if raw[:, :n].any():
            raise ValueError("no such code")
        if size <= 8:
            value = np.packbits(raw[:, n:], axis=1)[:, 0].astype(np.int32) >> (8 - size)
        else:
            value = raw[:, n:] @ (1 << np.arange(size - 1, -1, -1, dtype=np.int32))
        if not raw[:, n].all():
            value = np.where(raw[:, n] == 0, value - (1 << size) + 1, value)
        c.coefficients[order, first : last + 1] = value.reshape(len(order), band) << low
        return
    run = 0
    for b in order.tolist():
        if run:
            run -= 1
            continue
        k = first
        while k <= last:
            r, size = divmod(bits.symbol(table), 16)
            if size:
                k += r
                c.coefficients[b, k] = bits.signed(size) * (1 << low)
                k += 1
            elif r == 15:
                k += 16
            else:
                run = (1 << r) - 1 + bits.take(r)
                break


def _ac_refine(bits: Bits, c: Component, order: np.ndarray, table: Table, first: int, last: int, low: int) -> None:
    step = 1 << low

    def correct(rows: np.ndarray, a: int) -> None:
        """One bit for each value of the rows, from place ``a``, that isn't zero so far."""
        part = c.coefficients[rows, a : last + 1]
        there = part != 0
        n = int(np.count_nonzero(there))
        if n == part.size and part.min() > 0:
            part += bits.bits[bits.at : bits.at + n].reshape(part.shape) * np.int32(step)
        else:
            part[there] += np.where(bits.bits[bits.at : bits.at + n] == 1, np.where(part[there] > 0, step, -step), 0)
        c.coefficients[rows, a : last + 1] = part
        bits.at += n

    done = 0
    while done < len(order):
        b, k = order[done], first
        row = c.coefficients[b]
        while k <= last:
            r, size = divmod(bits.symbol(table), 16)
            if size == 0 and r < 15:
                run = (1 << r) + bits.take(r)
                if k > first:
                    correct(order[done : done + 1], k)
                    run, done = run - 1, done + 1
                if run:
                    correct(order[done : done + run], first)
                done += run
                break
            value = (step if bits.take(1) else -step) if size else 0
            while k <= last:
                if row[k]:
                    if bits.take(1):
                        row[k] += step if row[k] > 0 else -step
                elif r == 0:
                    row[k] = value or row[k]
                    k += 1
                    break
                else:
                    r -= 1
                k += 1
        else:
            done += 1


def samples(c: Component, quantiser: np.ndarray) -> np.ndarray:
    """The component's plane, by a separable inverse transform of all its blocks."""
    blocks = np.empty((len(c.coefficients), BLOCK))
    blocks[:, zigzag()] = c.coefficients * quantiser
    basis = _basis()
    blocks = np.matmul(np.matmul(basis.T, blocks.reshape(-1, 8, 8)), basis)
    plane = np.clip(np.rint(blocks) + 128, 0, 255).astype(np.int16)
    return plane.reshape(c.down, c.across, 8, 8).transpose(0, 2, 1, 3).reshape(8 * c.down, 8 * c.across)


def to_rgb(image: Image) -> np.ndarray:
    """The full-resolution uint8 tensor [height, width, 3]; grey images repeat their plane."""
    h, v = max(c.h for c in image.components), max(c.v for c in image.components)
    planes = [samples(c, image.quantisers[c.quantiser]) for c in image.components]
    if len(planes) != 3:
        return np.repeat(planes[0][: image.height, : image.width, None], 3, axis=2).astype(np.uint8)
    wide = lambda plane, c: plane.repeat(v // c.v, axis=0).repeat(h // c.h, axis=1)
    luma, (blue, red), (cb, cr) = wide(planes[0], image.components[0]), image.components[1:], planes[1:]
    b, r = cb.astype(np.int32) - 128, cr.astype(np.int32) - 128
    # shares of the colour differences in 65,536ths
    shift = lambda x: ((x + 32768) >> 16).astype(np.int16)
    if (blue.h, blue.v) == (red.h, red.v):
        parts = [wide(shift(91881 * r), red), wide(shift(-22554 * b - 46802 * r), blue), wide(shift(116130 * b), blue)]
    else:
        b, r = wide(b, blue), wide(r, red)
        parts = [shift(91881 * r), shift(-22554 * b - 46802 * r), shift(116130 * b)]
    rgb = np.stack([np.clip(luma + p, 0, 255) for p in parts], axis=2).astype(np.uint8)
    return rgb[: image.height, : image.width]


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def _huffman(slot: int, length: int, symbols: bytes) -> bytes:
    counts = bytearray(16)
    counts[length - 1] = len(symbols)
    return _segment(0xC4, bytes([slot]) + bytes(counts) + symbols)


#: DC sizes 0 to 7 and refining end-of-band runs in codes of four bits; the one AC symbol (no zeros, 8 bits) in one.
_TABLES = _huffman(0x00, 4, bytes(range(8))) + _huffman(0x10, 1, b"\x08") + _huffman(0x11, 4, bytes(16 * r for r in range(15)))
_DC_SIZE = np.array([abs(d).bit_length() for d in range(-128, 129)], np.int32)
_WEIGHTS = np.arange(11)


def _packed(bits: np.ndarray) -> bytes:
    """Bits as entropy-coded bytes, the last one filled with ones."""
    out = np.packbits(bits)
    if pad := -len(bits) % 8:
        out[-1] |= (1 << pad) - 1
    return out.tobytes().replace(b"\xff", b"\xff\x00")


def _start(parts: bytes, first: int, last: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([len(parts) // 2]) + parts + bytes([first, last, high << 4 | low]))


_ALL = b"\x01\x00\x02\x00\x03\x00"


def encode_payload(payload: bytes) -> bytes:
    """A progressive file of 4:2:0 colour whose coefficients hold a payload of a positive multiple of 64 bytes."""
    if not payload or len(payload) % BLOCK:
        raise ValueError("a payload is a positive multiple of 64 bytes")
    units = -(-len(payload) // (6 * BLOCK))
    across = -(-units // MOST_UNITS)
    down = -(-units // across)
    units = across * down
    flat = np.zeros(6 * units * BLOCK, np.uint8)
    flat[: len(payload)] = np.frombuffer(payload, np.uint8)
    blocks = flat.reshape(-1, BLOCK)
    order = _payload_order(across, down)
    dc = blocks[order, 0].astype(np.int32) - 128
    halves = (dc >> 1).reshape(units, 6)
    diffs = np.empty((units, 6), np.int32)
    diffs[:, :4] = np.diff(halves[:, :4].ravel(), prepend=0).reshape(units, 4)
    diffs[:, 4:] = np.diff(halves[:, 4:], axis=0, prepend=0)
    diffs = diffs.ravel()
    size = _DC_SIZE[diffs + 128]
    coded = (size << size) | np.where(diffs < 0, diffs + (1 << size) - 1, diffs)
    left = coded << (7 - size)
    bits = ((left[:, None] >> (10 - _WEIGHTS)) & 1).astype(np.uint8)[_WEIGHTS < (4 + size)[:, None]]
    head = _segment(0xFE, COMMENT + str(len(payload)).encode()) + _segment(0xDB, bytes([0]) + bytes([1]) * 64)
    frame = _segment(0xC2, b"\x08" + (16 * down).to_bytes(2, "big") + (16 * across).to_bytes(2, "big") + b"\x03\x01\x22\x00\x02\x11\x00\x03\x11\x00")
    out = [b"\xff\xd8", head, frame, _TABLES, _start(_ALL, 0, 0, 0, 1), _packed(bits)]
    ranges = ((1, 0, 4 * units), (2, 4 * units, 5 * units), (3, 5 * units, 6 * units))
    upper = flat >> 1 | 0x80
    wide = np.zeros((len(flat), 9), np.uint8)
    wide[:, 1:] = np.unpackbits(upper).reshape(-1, 8)
    wide = wide.reshape(-1, BLOCK, 9)
    for ident, a, b in ranges:
        for first, last in ((1, 5), (6, 63)) if ident == 1 else ((1, 63),):
            out += [_start(bytes([ident, 0]), first, last, 0, 1), _packed(wide[a:b, first : last + 1].ravel())]
    out += [_start(_ALL, 0, 0, 1, 0), _packed((dc & 1).astype(np.uint8))]
    lower = blocks[:, 1:] & 1
    for ident, a, b in ranges:
        scan = []
        for at in range(a, b, 32767):
            n = min(32767, b - at)
            r = n.bit_length() - 1
            scan += [np.array([(r << r | n - (1 << r)) >> k & 1 for k in range(3 + r, -1, -1)], np.uint8), lower[at : at + n].ravel()]
        out += [_start(bytes([ident, 1]), 1, 63, 1, 0), _packed(np.concatenate(scan))]
    return b"".join([*out, b"\xff\xd9"])


def read_payload(image: Image) -> bytes:
    """The bytes that ``encode_payload`` stored, from the coefficients alone."""
    if not image.comment.startswith(COMMENT):
        raise ValueError("no payload")
    values = np.concatenate([c.coefficients for c in image.components])
    values = values - np.where(np.arange(BLOCK) == 0, -128, 256)
    if values.min() < 0 or values.max() > 255:
        raise ValueError("coefficients out of range")
    return values.astype(np.uint8).tobytes()[: int(image.comment[len(COMMENT) :])]
