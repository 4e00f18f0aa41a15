"""MP4 recordings: rate, frame count and duration from the file's boxes, and frames that stand alone (Motion-JPEG) by their place.

Only headers are read to describe a recording: boxes are skipped by their sizes, the ``moov`` box is read whole, media data never.
The time-to-sample table gives the mean rate, the size, chunk and offset tables the place of each frame, so a sampled frame costs
one read and one decode, wherever it lies. Codecs that need other frames are plug-ins by their four-letter name.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

from framegrid.functions import jpeg
from framegrid.sources.sinks import filesystem

#: The header box of a recording is held in memory; a larger one is an error.
MOST_HEADER_BYTES = 1 << 28


@dataclass
class Info:
    fps: float  # 0 where the file does not say
    total_frames: int
    duration_s: float
    width: int
    height: int
    codec: str
    offsets: np.ndarray
    sizes: np.ndarray


def boxes(body: bytes, at: int = 0, end: int | None = None) -> Iterator[tuple[str, int, int]]:
    """Name, first and last byte of the content of each box."""
    end = len(body) if end is None else end
    while at + 8 <= end:
        size, name = struct.unpack_from(">I4s", body, at)
        head = 8
        if size == 1 and at + 16 <= end:
            (size,), head = struct.unpack_from(">Q", body, at + 8), 16
        size = size or end - at
        if size < head or at + size > end:
            raise ValueError("a box that does not fit")
        yield name.decode("latin-1"), at + head, at + size
        at += size


def _child(body: bytes, at: tuple[int, int], *path: str) -> tuple[int, int] | None:
    for name in path:
        at = next(((lo, hi) for n, lo, hi in boxes(body, *at) if n == name), None)
        if at is None:
            return None
    return at


def _header(path: str) -> bytes:
    """The content of the ``moov`` box, wherever it stands."""
    fs, inside = filesystem(path)
    with fs.open_input_file(inside) as f:
        end, at = f.size(), 0
        while at + 8 <= end:
            f.seek(at)
            head = f.read(16)
            size, name = struct.unpack_from(">I4s", head)
            skip = 8
            if size == 1 and len(head) == 16:
                (size,), skip = struct.unpack_from(">Q", head, 8), 16
            size = size or end - at
            if size < skip or at + size > end:
                break
            if name == b"moov":
                if size > MOST_HEADER_BYTES:
                    raise ValueError(f"a header of over {MOST_HEADER_BYTES} bytes")
                f.seek(at + skip)
                return f.read(size - skip)
            at += size
    raise ValueError(f"{path} is no MP4 recording")


def _array(body: bytes, at: int, n: int, kind: str) -> np.ndarray:
    if at + n * np.dtype(kind).itemsize > len(body):
        raise ValueError("a table that does not fit")
    return np.frombuffer(body, kind, n, at).astype(np.int64)


def _offsets(body: bytes, table: tuple[int, int], sizes: np.ndarray) -> np.ndarray:
    """The first byte of each frame, from the frames in each chunk and the chunks' places."""
    wide = _child(body, table, "co64")
    at = wide or _child(body, table, "stco")
    runs = _child(body, table, "stsc")
    if at is None or runs is None:
        raise ValueError("no table of chunks")
    chunks = _array(body, at[0] + 8, struct.unpack_from(">I", body, at[0] + 4)[0], ">u8" if wide else ">u4")
    (n,) = struct.unpack_from(">I", body, runs[0] + 4)
    run = _array(body, runs[0] + 8, 3 * n, ">u4").reshape(n, 3)
    if not len(sizes):
        return np.empty(0, np.int64)
    each = np.repeat(run[:, 1], np.diff(run[:, 0], append=len(chunks) + 1))
    if len(each) != len(chunks) or each.sum() < len(sizes):
        raise ValueError("the tables of chunks and frames differ")
    first = np.cumsum(each) - each
    owner = np.repeat(np.arange(len(chunks)), each)[: len(sizes)]
    before = np.cumsum(sizes) - sizes
    return chunks[owner] + before - before[np.minimum(first[owner], len(sizes) - 1)]


def info(path: str) -> Info:
    """What the first video track says."""
    body = _header(path)
    whole = (0, len(body))
    for name, lo, hi in boxes(body):
        if name != "trak":
            continue
        handler = _child(body, (lo, hi), "mdia", "hdlr")
        if handler is None or body[handler[0] + 8 : handler[0] + 12] != b"vide":
            continue
        media, table = _child(body, (lo, hi), "mdia", "mdhd"), _child(body, (lo, hi), "mdia", "minf", "stbl")
        if media is None or table is None:
            raise ValueError("a track without tables")
        scale = struct.unpack_from(">I", body, media[0] + (20 if body[media[0]] == 1 else 12))[0]
        times, size = _child(body, table, "stts"), _child(body, table, "stsz")
        if times is None or size is None:
            raise ValueError("a track without tables of times and sizes")
        (n,) = struct.unpack_from(">I", body, times[0] + 4)
        pairs = _array(body, times[0] + 8, 2 * n, ">u4").reshape(n, 2)
        one, frames = struct.unpack_from(">II", body, size[0] + 4)
        sizes = np.full(frames, one, np.int64) if one else _array(body, size[0] + 12, frames, ">u4")
        if not frames and _child(body, whole, "mvex"):
            raise ValueError("recordings in fragments are not read")
        entry = _child(body, table, "stsd")
        codec, width, height = "", 0, 0
        if entry and entry[1] - entry[0] >= 44:
            codec = body[entry[0] + 12 : entry[0] + 16].decode("latin-1")
            width, height = struct.unpack_from(">HH", body, entry[0] + 40)
        ticks = int((pairs[:, 0] * pairs[:, 1]).sum())
        fps = frames * scale / ticks if ticks and scale else 0.0
        return Info(fps, frames, ticks / scale if scale else 0.0, width, height, codec, _offsets(body, table, sizes), sizes)
    raise ValueError(f"{path} has no video track")


class Mp4Decoder:
    """Frames of a recording by their place; ``codecs`` gives a decoder of single frames by the codec's name."""

    codecs: dict[str, Callable[[bytes], np.ndarray]] = {}

    def __init__(self, path: str) -> None:
        self.path, self.info = path, info(path)
        self.fps, self.total_frames = self.info.fps, self.info.total_frames

    def frame(self, content: bytes) -> np.ndarray:
        if self.info.codec in self.codecs:
            return self.codecs[self.info.codec](content)
        if content[:2] == b"\xff\xd8":
            return jpeg.decode(content)
        raise NotImplementedError(f"frames of codec {self.info.codec!r} need a decoder plug-in")

    def read(self, start: int, stop: int, step: int) -> Iterator[tuple[int, np.ndarray]]:
        """Ends early at a frame that cannot be decoded."""
        fs, inside = filesystem(self.path)
        with fs.open_input_file(inside) as f:
            for i in range(start, min(stop, self.total_frames), step):
                f.seek(int(self.info.offsets[i]))
                try:
                    pixels = self.frame(f.read(int(self.info.sizes[i])))
                except ValueError:
                    return
                yield i, pixels
