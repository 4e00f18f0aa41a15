"""Image primitives in numpy, for use inside Arrow-batched tasks: blue-green-red arrays of bytes."""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Callable

import numpy as np

#: Hue range, least saturation and least value of the two ring colours.
GREEN, CYAN = (45, 95, 50, 55), (95, 112, 40, 55)
RADII = range(10, 15)
LEAST_RING, MOST_INSIDE, NMS_RADIUS = 0.60, 0.30, 6
#: Cyan needs a higher coverage; the contract does not say how much.
LEAST_CYAN = 0.70
ACCEPT, COVERAGE_WEIGHT = 1.05, 0.3
#: A patch reaches so far from its centre; the largest ring fits.
PATCH = 15


def _cubic(n: int, m: int) -> np.ndarray:
    """m x n weights of cubic interpolation (a = -0.75), edges repeated."""
    at = (np.arange(m) + 0.5) * n / m - 0.5
    low = np.floor(at).astype(int)
    out = np.zeros((m, n))
    for k in range(-1, 3):
        d = np.abs(at - (low + k))
        a = -0.75
        near = (a + 2) * d**3 - (a + 3) * d**2 + 1
        far = a * d**3 - 5 * a * d**2 + 8 * a * d - 4 * a
        np.add.at(out, (np.arange(m), np.clip(low + k, 0, n - 1)), np.where(d <= 1, near, np.where(d < 2, far, 0)))
    return out


def crop_resize(frame: np.ndarray, box: tuple[int, int, int, int], size: int = 186) -> np.ndarray:
    """The box, both ends included, resized to a square."""
    l, t, r, b = box
    part = frame[t : b + 1, l : r + 1].astype(float)
    wide = np.einsum("ij,jkc->ikc", _cubic(part.shape[0], size), part)
    both = np.einsum("ij,kjc->kic", _cubic(part.shape[1], size), wide)
    return np.clip(np.rint(both), 0, 255).astype(np.uint8)


def hsv(image: np.ndarray) -> np.ndarray:
    """Hue 0 to 179, saturation and value 0 to 255."""
    b, g, r = (image[..., i].astype(float) for i in range(3))
    v, low = np.max(image, axis=-1).astype(float), np.min(image, axis=-1).astype(float)
    span = np.where(v > low, v - low, 1)
    h = np.select([v == low, v == r, v == g], [0 * v, 60 * (g - b) / span, 120 + 60 * (b - r) / span], 240 + 60 * (r - g) / span)
    s = np.where(v > 0, 255 * (v - low) / np.where(v > 0, v, 1), 0)
    return np.stack([np.rint((h % 360) / 2) % 180, np.rint(s), v], axis=-1)


def mask(image: np.ndarray, colour: tuple[int, int, int, int], pixels: np.ndarray | None = None) -> np.ndarray:
    low, high, s, v = colour
    x = hsv(image) if pixels is None else pixels
    return (x[..., 0] >= low) & (x[..., 0] <= high) & (x[..., 1] >= s) & (x[..., 2] >= v)


def _around(m: np.ndarray, all_of: bool) -> np.ndarray:
    padded = np.pad(m, 1, constant_values=all_of)
    views = [padded[i : i + m.shape[0], j : j + m.shape[1]] for i in range(3) for j in range(3)]
    return np.logical_and.reduce(views) if all_of else np.logical_or.reduce(views)


def closing(m: np.ndarray) -> np.ndarray:
    """3 x 3 dilation, then erosion."""
    return _around(_around(m, False), True)


def _kernels() -> list[np.ndarray]:
    """Rings of all radii, then the discs inside them, on a square of 33."""
    yy, xx = np.mgrid[-16:17, -16:17]
    d = np.hypot(yy, xx)
    return [np.abs(d - r) < 0.5 for r in RADII] + [d < r - 3 for r in RADII]


@functools.lru_cache(maxsize=4)
def _transformed(height: int, width: int) -> np.ndarray:
    """The kernels' transforms, turned round, for correlation with a mask of this size and a border of 16."""
    return np.stack([np.conj(np.fft.rfft2(k.astype(float), (height + 32, width + 32))) for k in _kernels()])


def ring_coverage(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best share of a ring that is set over the radii, and the share of the disc inside that radius; outside counts as unset.

    Set pixels are counted by one transform of the mask and one back for each kernel, rounded to whole numbers.
    """
    h, w = m.shape
    spectrum = np.fft.rfft2(np.pad(m.astype(float), 16))
    counts = np.rint(np.fft.irfft2(spectrum * _transformed(h, w), (h + 32, w + 32)))[:, :h, :w]
    shares = counts / np.array([k.sum() for k in _kernels()])[:, None, None]
    n = len(RADII)
    best = np.argmax(shares[:n], axis=0)[None]
    return np.take_along_axis(shares[:n], best, 0)[0], np.take_along_axis(shares[n:], best, 0)[0]


def apart(found: list[tuple[int, int, float]], radius: int = NMS_RADIUS) -> list[tuple[int, int, float]]:
    """Of (px, py, coverage) by falling coverage those with no better one within ``radius``."""
    kept: list[tuple[int, int, float]] = []
    for x, y, c in sorted(found, key=lambda p: (-p[2], p[1], p[0])):
        if all((x - a) ** 2 + (y - b) ** 2 > radius**2 for a, b, _ in kept):
            kept.append((x, y, c))
    return kept


def valid(coverage: np.ndarray, inside: np.ndarray, least: float = LEAST_RING) -> list[tuple[int, int, float]]:
    """(px, py, coverage) where the ring is set and its inside is not."""
    at = np.argwhere((coverage >= least) & (inside <= MOST_INSIDE))
    return [(x, y, float(coverage[y, x])) for y, x in at.tolist()]


def peaks(coverage: np.ndarray, inside: np.ndarray, radius: int = NMS_RADIUS, least: float = LEAST_RING) -> list[tuple[int, int, float]]:
    """Valid centres by falling coverage, none within ``radius`` of a better one."""
    return apart(valid(coverage, inside, least), radius)


def candidates(image: np.ndarray) -> list[tuple[int, int, float]]:
    """Centres of green rings, and of cyan ones above their higher bar, apart from each other."""
    pixels = hsv(image)
    found = []
    for colour, least in ((GREEN, LEAST_RING), (CYAN, LEAST_CYAN)):
        m = mask(image, colour, pixels)
        if m.any():
            found += valid(*ring_coverage(closing(m)), least)
    return apart(found)


def patch(image: np.ndarray, x: int, y: int) -> np.ndarray:
    """The square around a centre, edges repeated."""
    padded = np.pad(image, ((PATCH, PATCH), (PATCH, PATCH), (0, 0)), mode="edge")
    return padded[y : y + 2 * PATCH + 1, x : x + 2 * PATCH + 1]


def patch_features(image: np.ndarray, x: int, y: int) -> np.ndarray:
    """Of the square around a centre: 64 grey means of an 8 x 8 grid, shares of both colours by five rings of distance, mean and deviation of hue, saturation and value."""
    part = patch(image, x, y)
    grey = part.astype(float) @ np.array([0.114, 0.587, 0.299])
    cuts = np.array_split(np.arange(len(part)), 8)
    grid = [grey[r[0] : r[-1] + 1, c[0] : c[-1] + 1].mean() for r in cuts for c in cuts]
    yy, xx = np.mgrid[-PATCH : PATCH + 1, -PATCH : PATCH + 1]
    ring = np.minimum(np.hypot(yy, xx) / 3.5, 4).astype(int)
    pixels = hsv(part)
    shares = [mask(part, colour, pixels)[ring == k].mean() for colour in (GREEN, CYAN) for k in range(5)]
    colours = pixels.reshape(-1, 3)
    return np.concatenate([grid, shares, colours.mean(axis=0), colours.std(axis=0)])


class RingDetector:
    """The candidate with the highest fused score, if it reaches ``accept``; both scorers take (image, x, y)."""

    def __init__(self, ncc: Callable[..., float], probability: Callable[..., float], accept: float = ACCEPT) -> None:
        self.ncc, self.probability, self.accept = ncc, probability, accept

    def scored(self, image: np.ndarray) -> list[tuple[float, int, int]]:
        """(fused score, px, py) of all candidates, by falling coverage."""
        return [(self.ncc(image, x, y) + self.probability(image, x, y) + COVERAGE_WEIGHT * c, x, y) for x, y, c in candidates(image)]

    def __call__(self, image: np.ndarray) -> tuple[int, int] | None:
        found = self.scored(image)
        best = max(range(len(found)), key=lambda i: (found[i][0], -i), default=None)
        return found[best][1:] if best is not None and found[best][0] >= self.accept else None


class TemplateScorer:
    """The mean of the ``most`` highest normalised cross-correlations between a patch and templates of one size."""

    def __init__(self, templates: list[np.ndarray], most: int = 5) -> None:
        self.half, self.most = templates[0].shape[0] // 2, most
        self.templates = np.stack([self._unit(t) for t in templates])

    @staticmethod
    def _unit(patch: np.ndarray) -> np.ndarray:
        flat = patch.astype(float).ravel()
        flat -= flat.mean()
        return flat / max(float(np.linalg.norm(flat)), 1e-9)

    def __call__(self, image: np.ndarray, x: int, y: int) -> float:
        padded = np.pad(image, ((self.half, self.half), (self.half, self.half), (0, 0)), mode="edge")
        size = 2 * self.half + 1
        likeness = self.templates @ self._unit(padded[y : y + size, x : x + size])
        return float(np.sort(likeness)[-self.most :].mean())


class CentroidDetector:
    """The centre of all pixels of a colour; deterministic, for tests and as the smallest plug-in."""

    def __init__(self, colour=GREEN) -> None:
        self.colour = colour

    def __call__(self, image: np.ndarray) -> tuple[int, int] | None:
        at = np.argwhere(mask(image, self.colour))
        return None if not len(at) else (int(at[:, 1].mean()), int(at[:, 0].mean()))


def roi_features(frame: np.ndarray) -> np.ndarray:
    """The 233 features of a frame: 192 means of a 16 x 12 grey grid, a 24-bin grey histogram, mean and deviation of hue, saturation and value,
    and eleven more: mean and deviation of the gradient (2), shares of green, cyan and grey pixels (3), density of edges over the frame and
    in its upper left quarter (2), width and height in thousands (2), and where in that quarter the strongest upright and level edges lie (2).
    """
    grey = frame.astype(float) @ np.array([0.114, 0.587, 0.299])
    h, w = grey.shape
    rows, cols = np.array_split(np.arange(h), 12), np.array_split(np.arange(w), 16)
    part = lambda r, c: grey[r[0] : r[-1] + 1, c[0] : c[-1] + 1].mean() if len(r) and len(c) else 0.0
    grid = [part(r, c) for r in rows for c in cols]
    histogram = np.histogram(grey, bins=24, range=(0, 256))[0] / grey.size
    pixels = hsv(frame)
    colour = pixels.reshape(-1, 3)
    across, down = np.abs(np.diff(grey, axis=1, append=grey[:, -1:])), np.abs(np.diff(grey, axis=0, append=grey[-1:]))
    slope = across + down
    edge = slope > 48
    high, wide = max(1, h // 2), max(1, w // 2)
    shares = [mask(frame, GREEN, pixels).mean(), mask(frame, CYAN, pixels).mean(), (pixels[..., 1] < 30).mean()]
    places = [int(np.argmax(across[:high, :wide].sum(axis=0))) / w, int(np.argmax(down[:high, :wide].sum(axis=1))) / h]
    others = [slope.mean(), slope.std(), *shares, edge.mean(), edge[:high, :wide].mean(), w / 1000, h / 1000, *places]
    return np.concatenate([grid, histogram, colour.mean(axis=0), colour.std(axis=0), others])


def png(pixels: np.ndarray) -> bytes:
    """The smallest lossless encoder: a PNG of blue-green-red pixels, which readers know by its content."""
    rows = b"".join(b"\0" + line.tobytes() for line in pixels[..., ::-1])

    def part(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", pixels.shape[1], pixels.shape[0], 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")
