"""Baseline JPEG in numpy: a writer for crops and a reader for frames, both of 8 bits and sequential; for use inside tasks.

The writer works on all blocks at once: the transform is a matrix product, and codes, runs and bits are arrays. The reader walks the
Huffman codes one by one, with a table of all 16-bit windows, and transforms all blocks at once. It reads one or three components at any
sampling, and restart intervals; progressive, lossless and arithmetic files are a ``ValueError``.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np

# The standard's example tables, quantisation in natural order, Huffman as counts by length and symbols in the order of codes.
LUMA = [
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
]
CHROMA = [
    17, 18, 24, 47, 99, 99, 99, 99, 18, 21, 26, 66, 99, 99, 99, 99, 24, 26, 56, 99, 99, 99, 99, 99, 47, 66, 99, 99, 99, 99, 99, 99,
    *[99] * 32,
]
DC_LUMA = ([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0], bytes(range(12)))
DC_CHROMA = ([0, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0], bytes(range(12)))
AC_LUMA = (
    [0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125],
    bytes.fromhex(
        "01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 "
        "23 42 b1 c1 15 52 d1 f0 24 33 62 72 82 09 0a 16 17 18 19 1a 25 26 27 28 "
        "29 2a 34 35 36 37 38 39 3a 43 44 45 46 47 48 49 4a 53 54 55 56 57 58 59 "
        "5a 63 64 65 66 67 68 69 6a 73 74 75 76 77 78 79 7a 83 84 85 86 87 88 89 "
        "8a 92 93 94 95 96 97 98 99 9a a2 a3 a4 a5 a6 a7 a8 a9 aa b2 b3 b4 b5 b6 "
        "b7 b8 b9 ba c2 c3 c4 c5 c6 c7 c8 c9 ca d2 d3 d4 d5 d6 d7 d8 d9 da e1 e2 "
        "e3 e4 e5 e6 e7 e8 e9 ea f1 f2 f3 f4 f5 f6 f7 f8 f9 fa "
    ),
)
AC_CHROMA = (
    [0, 2, 1, 2, 4, 4, 3, 4, 7, 5, 4, 4, 0, 1, 2, 119],
    bytes.fromhex(
        "00 01 02 03 11 04 05 21 31 06 12 41 51 07 61 71 13 22 32 81 08 14 42 91 "
        "a1 b1 c1 09 23 33 52 f0 15 62 72 d1 0a 16 24 34 e1 25 f1 17 18 19 1a 26 "
        "27 28 29 2a 35 36 37 38 39 3a 43 44 45 46 47 48 49 4a 53 54 55 56 57 58 "
        "59 5a 63 64 65 66 67 68 69 6a 73 74 75 76 77 78 79 7a 82 83 84 85 86 87 "
        "88 89 8a 92 93 94 95 96 97 98 99 9a a2 a3 a4 a5 a6 a7 a8 a9 aa b2 b3 b4 "
        "b5 b6 b7 b8 b9 ba c2 c3 c4 c5 c6 c7 c8 c9 ca d2 d3 d4 d5 d6 d7 d8 d9 da "
        "e2 e3 e4 e5 e6 e7 e8 e9 ea f2 f3 f4 f5 f6 f7 f8 f9 fa "
    ),
)


def _zigzag() -> np.ndarray:
    """The natural place of each place of the zigzag order."""
    by_diagonal = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))
    return np.array([8 * r + c for r, c in by_diagonal])


ZIGZAG = _zigzag()
#: The cosine transform as a matrix; its transpose is the inverse.
COSINES = np.array([[np.sqrt((1 if u == 0 else 2) / 8) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])


def quantisation(table: list[int], quality: int) -> np.ndarray:
    """The example table scaled to a quality of 1 to 100, in natural order."""
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array(table) * scale + 50) // 100, 1, 255)


def _codes(table: tuple[list[int], bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code and length of each symbol."""
    code, lengths = np.zeros(256, np.int64), np.zeros(256, np.int64)
    at, value = 0, 0
    for bits, n in enumerate(table[0], 1):
        for symbol in table[1][at : at + n]:
            code[symbol], lengths[symbol] = value, bits
            value += 1
        at += n
        value <<= 1
    return code, lengths


# writing


def _planes(pixels: np.ndarray) -> np.ndarray:
    b, g, r = (pixels[..., i].astype(float) for i in range(3))
    y = 0.299 * r + 0.587 * g + 0.114 * b
    return np.stack([y - 128, (b - y) / 1.772, (r - y) / 1.402])


def _blocks(plane: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Quantised coefficients of each 8 x 8 block in zigzag order: rows x columns x 64."""
    h, w = plane.shape
    cut = plane.reshape(h // 8, 8, w // 8, 8).swapaxes(1, 2)
    return np.rint((COSINES @ cut @ COSINES.T).reshape(h // 8, w // 8, 64) / table).astype(np.int64)[..., ZIGZAG]


def _size(values: np.ndarray) -> np.ndarray:
    """The bits of each magnitude."""
    return np.frexp(np.abs(values).astype(float))[1].astype(np.int64)


def _bits(zz: np.ndarray, chroma: np.ndarray, component: np.ndarray) -> bytes:
    """The coded blocks, in the order of the scan."""
    dc = zz[:, 0].copy()
    for c in np.unique(component):
        at = np.flatnonzero(component == c)
        dc[at] = np.diff(zz[at, 0], prepend=0)
    tables = [(_codes(DC_LUMA), _codes(AC_LUMA)), (_codes(DC_CHROMA), _codes(AC_CHROMA))]
    codes = np.array([[t[k][0] for k in (0, 1)] for t in tables])
    lengths = np.array([[t[k][1] for k in (0, 1)] for t in tables])
    block, k = np.nonzero(zz[:, 1:])
    new = np.diff(block, prepend=-1) > 0
    run = k - np.where(new, -1, np.concatenate([[-1], k[:-1]])) - 1
    skips = run // 16
    skipped = np.repeat(np.arange(len(block)), skips)
    open_end = np.flatnonzero(zz[:, 63] == 0)
    # one entry for each symbol: block, place, order in the place, kind (0 first coefficient, 1 others), symbol, value
    value = zz[block, k + 1]
    parts = [
        (np.arange(len(zz)), np.full(len(zz), -1), 0, 0, _size(dc), dc),
        (block[skipped], k[skipped], 0, 1, np.full(len(skipped), 0xF0), np.zeros(len(skipped), np.int64)),
        (block, k, 1, 1, (run % 16) << 4 | _size(value), value),
        (open_end, np.full(len(open_end), 64), 0, 1, np.zeros(len(open_end), np.int64), np.zeros(len(open_end), np.int64)),
    ]
    at = np.concatenate([p[0] for p in parts])
    order = np.lexsort((np.concatenate([np.full(len(p[0]), p[2]) for p in parts]), np.concatenate([p[1] for p in parts]), at))
    at, kind = at[order], np.concatenate([np.full(len(p[0]), p[3]) for p in parts])[order]
    symbol, value = np.concatenate([p[4] for p in parts])[order], np.concatenate([p[5] for p in parts])[order]
    extra = np.where(kind == 0, symbol, symbol & 15)
    which = chroma[at].astype(np.int64)
    word = codes[which, kind, symbol] << extra | np.where(value < 0, value + (1 << extra) - 1, value)
    width = lengths[which, kind, symbol] + extra
    ends = np.cumsum(width)
    shift = np.repeat(ends, width) - 1 - np.arange(int(ends[-1]))
    bits = (np.repeat(word, width) >> shift & 1).astype(np.uint8)
    packed = np.packbits(np.concatenate([bits, np.ones(-len(bits) % 8, np.uint8)])).tobytes()
    return packed.replace(b"\xff", b"\xff\x00")


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def encode(pixels: np.ndarray, quality: int = 95, halved: bool = True) -> bytes:
    """A JPEG of blue-green-red pixels; colour differences at half the width and height if ``halved``."""
    height, width = pixels.shape[:2]
    unit = 16 if halved else 8
    padded = np.pad(pixels, ((0, -height % unit), (0, -width % unit), (0, 0)), mode="edge")
    planes = list(_planes(padded))
    if halved:
        planes[1:] = [p.reshape(p.shape[0] // 2, 2, p.shape[1] // 2, 2).mean(axis=(1, 3)) for p in planes[1:]]
    quant = [quantisation(LUMA, quality), quantisation(CHROMA, quality)]
    blocks = [_blocks(p, quant[min(i, 1)]) for i, p in enumerate(planes)]
    n = 2 if halved else 1
    rows, cols = blocks[1].shape[:2]
    luma = blocks[0].reshape(rows, n, cols, n, 64).swapaxes(1, 2).reshape(rows * cols, n * n, 64)
    units = np.concatenate([luma, *(b.reshape(rows * cols, 1, 64) for b in blocks[1:])], axis=1)
    component = np.tile(np.array([0] * (n * n) + [1, 2]), rows * cols)
    data = _bits(units.reshape(-1, 64), component > 0, component)
    out = [b"\xff\xd8", _segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0")]
    out += [_segment(0xDB, bytes([i]) + bytes(q[ZIGZAG].tolist())) for i, q in enumerate(quant)]
    out.append(_segment(0xC0, struct.pack(">BHHB", 8, height, width, 3) + bytes([1, n << 4 | n, 0, 2, 0x11, 1, 3, 0x11, 1])))
    for place, table in ((0x00, DC_LUMA), (0x10, AC_LUMA), (0x01, DC_CHROMA), (0x11, AC_CHROMA)):
        out.append(_segment(0xC4, bytes([place]) + bytes(table[0]) + table[1]))
    out.append(_segment(0xDA, bytes([3, 1, 0x00, 2, 0x11, 3, 0x11, 0, 63, 0])))
    return b"".join([*out, data, b"\xff\xd9"])


def jpeg(pixels: np.ndarray) -> bytes:
    """The contract's encoder: quality 95."""
    return encode(pixels, 95)


# reading


@dataclass
class _Head:
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    huffman: dict[int, list[int]] = field(default_factory=dict)
    height: int = 0
    width: int = 0
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, across, down, quantisation
    restart: int = 0


#: The tables of files that name none, as single pictures of a recording may.
_STANDARD = ((0x00, DC_LUMA), (0x10, AC_LUMA), (0x01, DC_CHROMA), (0x11, AC_CHROMA))


def _windows(counts: list[int], symbols: bytes) -> list[int]:
    """For each window of 16 bits: the length of the code that begins it << 8 | its symbol; 0 where none does."""
    table = np.zeros(1 << 16, np.int64)
    at, value = 0, 0
    for bits, n in enumerate(counts, 1):
        for symbol in symbols[at : at + n]:
            first = value << (16 - bits)
            table[first : first + (1 << (16 - bits))] = bits << 8 | symbol
            value += 1
        at += n
        value <<= 1
    return table.tolist()


def _read_head(content: bytes) -> tuple[_Head, list[tuple[int, int]], int]:
    """The tables, the scan's components with their Huffman tables, and where the coded data begin."""
    if content[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    head, at = _Head(), 2
    while at + 4 <= len(content):
        if content[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker = content[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        (size,) = struct.unpack_from(">H", content, at + 2)
        body, at = content[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xDB:
            while body:
                wide, n = body[0] >> 4, 64 << (body[0] >> 4)
                table = np.empty(64, np.int64)
                table[ZIGZAG] = np.frombuffer(body[1 : n + 1], ">u2" if wide else np.uint8)
                head.quant[body[0] & 15], body = table, body[n + 1 :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                head.huffman[body[0]], body = _windows(list(body[1:17]), body[17 : 17 + n]), body[17 + n :]
        elif marker in (0xC0, 0xC1):
            bits, head.height, head.width, n = struct.unpack_from(">BHHB", body)
            if bits != 8 or not head.height or not head.width or n not in (1, 3):
                raise ValueError("pictures have 8 bits, a size, and one or three components")
            head.components = [(c, s >> 4, s & 15, q) for c, s, q in (body[6 + 3 * i : 9 + 3 * i] for i in range(n))]
        elif 0xC2 <= marker <= 0xCF and marker != 0xCC:
            raise ValueError("only baseline pictures are read")
        elif marker == 0xDD:
            (head.restart,) = struct.unpack(">H", body)
        elif marker == 0xDA:
            if body[0] != len(head.components) or not head.components:
                raise ValueError("a scan holds all components")
            return head, [(body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])], at
    raise ValueError("no scan")


def _intervals(content: bytes, at: int) -> list[bytes]:
    """The coded data between restart markers, without the bytes that keep markers apart."""
    out = []
    while True:
        end = at
        while (end := content.find(b"\xff", end)) >= 0 and end + 1 < len(content) and content[end + 1] == 0:
            end += 2
        stop = len(content) if end < 0 else end
        out.append(content[at:stop].replace(b"\xff\x00", b"\xff"))
        if end < 0 or end + 1 >= len(content) or not 0xD0 <= content[end + 1] <= 0xD7:
            return out
        at = end + 2


def _walk(data: bytes, units: int, order: list[tuple[int, list[int], list[int]]], out: np.ndarray, first: int) -> None:
    """Decode whole units of one interval into rows of ``out``; ``order`` has the component and both tables of each block of a unit."""
    if not units:
        return
    data += b"\xff" * 8  # ones, as the writer pads
    window, have, at = 0, 0, 0
    last = [0] * 3
    row = first
    rows, places, values = [], [], []
    for _ in range(units):
        for component, dc, ac in order:
            k = 0
            while k < 64:
                while have < 32:
                    if at + 4 > len(data):
                        raise ValueError("the picture ends early")
                    window = (window << 32 | int.from_bytes(data[at : at + 4], "big")) & 0xFFFFFFFFFFFFFFFF
                    have += 32
                    at += 4
                found = (ac if k else dc)[window >> (have - 16) & 0xFFFF]
                if not found:
                    raise ValueError("no such code")
                have -= found >> 8
                size = found & 15
                if k:
                    run = found >> 4 & 15
                    if not size:
                        if run < 15:
                            break
                        k += 16
                        continue
                    k += run
                    if k > 63:
                        raise ValueError("a block of over 64 places")
                value = 0
                if size:
                    have -= size
                    value = window >> have & ((1 << size) - 1)
                    if value < 1 << (size - 1):
                        value -= (1 << size) - 1
                if not k:
                    value += last[component]
                    last[component] = value
                if value:
                    rows.append(row)
                    places.append(k)
                    values.append(value)
                k += 1
            row += 1
    out[rows, places] = values


def decode(content: bytes) -> np.ndarray:
    """Blue-green-red pixels of a baseline file; a picture of one component is grey."""
    head, tables, at = _read_head(content)
    for place, table in _STANDARD:
        head.huffman.setdefault(place, None)
        if head.huffman[place] is None and (place & 15, place >> 4) in {(d, 0) for d, _ in tables} | {(a, 1) for _, a in tables}:
            head.huffman[place] = _windows(*table)
    parts = head.components if len(head.components) > 1 else [(head.components[0][0], 1, 1, head.components[0][3])]
    across, down = max(c[1] for c in parts), max(c[2] for c in parts)
    cols, rows = -(-head.width // (8 * across)), -(-head.height // (8 * down))
    order, spots = [], []
    for i, (c, (dc, ac)) in enumerate(zip(parts, tables, strict=True)):
        if head.huffman.get(dc) is None or head.huffman.get(0x10 | ac) is None or c[3] not in head.quant:
            raise ValueError("a table is missing")
        spots.append((len(order), c[1] * c[2]))
        order += [(i, head.huffman[dc], head.huffman[0x10 | ac])] * (c[1] * c[2])
    units = rows * cols
    zz = np.zeros((units * len(order), 64), np.int64)
    step = head.restart or units
    intervals = _intervals(content, at)
    if len(intervals) < -(-units // step):
        raise ValueError("the picture ends early")
    for i in range(-(-units // step)):
        _walk(intervals[i], min(step, units - i * step), order, zz, i * step * len(order))
    planes = []
    for (first, n), (_, h, v, q) in zip(spots, parts, strict=True):
        natural = np.zeros((units * n, 64))
        natural[:, ZIGZAG] = zz.reshape(units, len(order), 64)[:, first : first + n].reshape(-1, 64)
        spatial = COSINES.T @ (natural * head.quant[q]).reshape(-1, 8, 8) @ COSINES
        plane = spatial.reshape(rows, cols, v, h, 8, 8).transpose(0, 2, 4, 1, 3, 5).reshape(rows * v * 8, cols * h * 8)
        planes.append(np.repeat(np.repeat(plane, down // v, 0), across // h, 1)[: head.height, : head.width])
    y = planes[0] + 128
    cb, cr = planes[1:] if len(planes) == 3 else (0 * y, 0 * y)
    colours = np.stack([y + 1.772 * cb, y - 0.344136 * cb - 0.714136 * cr, y + 1.402 * cr], axis=-1)
    return np.clip(np.rint(colours), 0, 255).astype(np.uint8)
