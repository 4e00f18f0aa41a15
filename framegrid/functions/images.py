"""Reading the stored crops: baseline JPEG, and PNG of 8 bits without interlacing."""

from __future__ import annotations

import struct
import zlib

import numpy as np

from framegrid.functions import jpeg

#: Components of each PNG colour type that is read.
_COMPONENTS = {0: 1, 2: 3, 4: 2, 6: 4}


def _unfiltered(raw: np.ndarray, height: int, width: int, n: int) -> np.ndarray:
    lines = raw.reshape(height, 1 + width * n)
    out = np.zeros((height + 1, width + 1, n), np.int64)  # a row above and a pixel before, of zeros
    for y in range(1, height + 1):
        kind, line = lines[y - 1, 0], lines[y - 1, 1:].reshape(width, n).astype(np.int64)
        if kind == 0:
            out[y, 1:] = line
        elif kind == 1:
            out[y, 1:] = np.cumsum(line, axis=0) & 255
        elif kind == 2:
            out[y, 1:] = line + out[y - 1, 1:] & 255
        elif kind in (3, 4):
            for x in range(1, width + 1):
                left, up, corner = out[y, x - 1], out[y - 1, x], out[y - 1, x - 1]
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    to_left, to_up, to_corner = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
                    guess = np.where((to_left <= to_up) & (to_left <= to_corner), left, np.where(to_up <= to_corner, up, corner))
                out[y, x] = line[x - 1] + guess & 255
        else:
            raise ValueError("no such filter")
    return out[1:, 1:].astype(np.uint8)


def png(content: bytes) -> np.ndarray:
    """Blue-green-red pixels; grey is repeated and opacity left out."""
    at, body, head = 8, [], None
    while at + 12 <= len(content):
        size, kind = struct.unpack_from(">I4s", content, at)
        part = content[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
        elif kind == b"IEND":
            break
        at += 12 + size
    if head is None or head[2] != 8 or head[3] not in _COMPONENTS or head[6]:
        raise ValueError("only PNG of 8 bits without palette or interlacing is read")
    width, height, n = head[0], head[1], _COMPONENTS[head[3]]
    pixels = _unfiltered(np.frombuffer(zlib.decompress(b"".join(body)), np.uint8), height, width, n)
    return np.repeat(pixels[..., :1], 3, axis=-1) if n < 3 else pixels[..., 2::-1]


def read(content: bytes) -> np.ndarray | None:
    """The pixels of a file, or None where it cannot be read."""
    try:
        if content.startswith(b"\xff\xd8"):
            return jpeg.decode(content)
        if content.startswith(b"\x89PNG\r\n\x1a\n"):
            return png(content)
    except (ValueError, IndexError, struct.error, zlib.error):
        return None
    return None
