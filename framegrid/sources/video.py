"""A Spark data source of decoded frames; the decoder is a plug-in named by the option ``decoder`` (module:class).

A decoder is made with a path and has ``fps``, ``total_frames`` and ``read(start, stop, step)``, which yields
(frame index, height x width x 3 array) and ends early where decoding fails. Only sampled frames are asked for, and long
recordings are split into ranges, so one recording is decoded by many tasks. Conditions on ``frame_index`` reach the source:
frames outside of them are not decoded.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

from framegrid.config import Sampling
from framegrid.schemas import FRAME
from framegrid.sources.mp4 import Mp4Decoder
from framegrid.sources.sinks import filesystem


@dataclass
class FrameRange(InputPartition):
    path: str
    start: int
    stop: int


class ArrayDecoder:
    """Frames stored as one .npy array, at a rate of 10 a second."""

    fps = 10.0

    def __init__(self, path: str) -> None:
        self.frames = np.load(path.removeprefix("file:"), mmap_mode="r")
        self.total_frames = len(self.frames)

    def read(self, start: int, stop: int, step: int) -> Iterator[tuple[int, np.ndarray]]:
        for i in range(start, min(stop, self.total_frames), step):
            yield i, np.asarray(self.frames[i])


class PatternDecoder:
    """A made-up recording for benches: 13:45 minutes of 1280 x 582 at 60.4 frames a second, a ring that moves over noise."""

    fps, total_frames = 60.4, 49_830

    def __init__(self, path: str) -> None:
        self.noise = np.random.default_rng(0).integers(0, 60, (582, 1280, 3), dtype=np.uint8)

    def read(self, start: int, stop: int, step: int) -> Iterator[tuple[int, np.ndarray]]:
        for i in range(start, min(stop, self.total_frames), step):
            frame = self.noise.copy()
            x, y = 25 + (i * 7) % 136, 25 + (i * 3) % 136
            yy, xx = np.mgrid[y - 16 : y + 17, x - 16 : x + 17]
            frame[y - 16 : y + 17, x - 16 : x + 17][np.abs(np.hypot(yy - y, xx - x) - 12) < 1.2] = (60, 220, 60)
            yield i, frame


class Y4mDecoder:
    """An uncompressed YUV4MPEG2 recording of 8 bits, 4:2:0 or 4:4:4, to blue-green-red frames; frames are found by their place."""

    def __init__(self, path: str) -> None:
        self.path = path.removeprefix("file:")
        with open(self.path, "rb") as f:
            head = f.readline()
            self.start = f.tell()
            f.seek(0, 2)
            size = f.tell() - self.start
        fields = {x[:1]: x[1:] for x in head.decode("ascii").split()[1:]}
        self.width, self.height = int(fields["W"]), int(fields["H"])
        top, _, below = fields.get("F", "0:1").partition(":")
        self.fps = int(top) / int(below) if int(below) else 0.0
        self.halved = not fields.get("C", "420").startswith("444")
        self.small = (-(-self.height // 2), -(-self.width // 2)) if self.halved else (self.height, self.width)
        self.bytes = len(b"FRAME\n") + self.height * self.width + 2 * self.small[0] * self.small[1]
        self.total_frames = size // self.bytes

    def read(self, start: int, stop: int, step: int) -> Iterator[tuple[int, np.ndarray]]:
        with open(self.path, "rb") as f:
            for i in range(start, min(stop, self.total_frames), step):
                f.seek(self.start + i * self.bytes)
                raw = f.read(self.bytes)
                if not raw.startswith(b"FRAME\n") or len(raw) < self.bytes:
                    return
                yield i, self.pixels(np.frombuffer(raw, np.uint8, offset=6).astype(float))

    def pixels(self, planes: np.ndarray) -> np.ndarray:
        n, m = self.height * self.width, self.small[0] * self.small[1]
        y = 1.164 * (planes[:n].reshape(self.height, self.width) - 16)
        u, v = (planes[n + k * m : n + (k + 1) * m].reshape(self.small) - 128 for k in (0, 1))
        if self.halved:
            u, v = (np.repeat(np.repeat(x, 2, 0), 2, 1)[: self.height, : self.width] for x in (u, v))
        colours = np.stack([y + 2.018 * u, y - 0.391 * u - 0.813 * v, y + 1.596 * v], axis=-1)
        return np.clip(np.rint(colours), 0, 255).astype(np.uint8)


def recording(path: str):
    """The decoder that fits the file's first bytes: an array, an uncompressed recording, or else an MP4."""
    fs, inside = filesystem(path)
    with fs.open_input_stream(inside) as f:
        head = f.read(16)
    return (ArrayDecoder if head.startswith(b"\x93NUMPY") else Y4mDecoder if head.startswith(b"YUV4MPEG2") else Mp4Decoder)(path)


def decoder(name: str, path: str):
    module, _, cls = name.partition(":")
    return getattr(importlib.import_module(module), cls)(path)


def plan(fps: float, total: int, conf: Sampling) -> tuple[int, int, int]:
    """First frame, last frame and step of the sample."""
    rate = fps or conf.default_fps
    end = min(total / rate, conf.end_s if conf.end_s is not None else total / rate)
    return int(conf.start_s * rate), int(end * rate), max(1, round(rate * conf.interval_s))


def register(spark: SparkSession) -> None:
    """Make the source known; its pushdown of conditions needs a setting of the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(VideoFrames)


class VideoFrames(DataSource):
    @classmethod
    def name(cls) -> str:
        return "video_frames"

    def schema(self) -> str:
        return FRAME

    def reader(self, schema) -> DataSourceReader:
        return VideoReader(self.options)


class VideoReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.paths = options["path"].split(",")
        self.decoder = options.get("decoder", "framegrid.sources.video:recording")
        given = {k: float(options[k]) for k in ("start_s", "end_s", "interval_s", "default_fps") if options.get(k) not in (None, "", "None")}
        self.conf = Sampling(**given)
        self.samples = int(options.get("samples_per_task", 64))
        self.least, self.most, self.only = 0, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Bounds and lists of frame indices are kept by the source; all else goes back to Spark."""
        for f in filters:
            value = getattr(f, "value", None)
            if getattr(f, "attribute", None) != ("frame_index",) or value is None or isinstance(f, In) and None in value:
                yield f
            elif isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.least = max(self.least, value + isinstance(f, GreaterThan))
            elif isinstance(f, LessThan | LessThanOrEqual):
                most = value - isinstance(f, LessThan)
                self.most = most if self.most is None else min(self.most, most)
            elif isinstance(f, EqualTo | In):
                wanted = frozenset([value] if isinstance(f, EqualTo) else value)
                self.only = wanted if self.only is None else self.only & wanted
            else:
                yield f

    def partitions(self) -> list[FrameRange]:
        out = []
        for path in self.paths:
            opened = decoder(self.decoder, path)
            first, last, step = plan(opened.fps, opened.total_frames, self.conf)
            last = last if self.most is None else min(last, self.most)
            if self.only is not None:
                wanted = sorted(i for i in self.only if max(first, self.least) <= i <= last and (i - first) % step == 0)
                out += [FrameRange(path, i, i + 1) for i in wanted]
                continue
            first += max(0, -(-(self.least - first) // step)) * step
            out += [FrameRange(path, at, min(at + step * self.samples, last + 1)) for at in range(first, last + 1, step * self.samples)]
        return out

    def read(self, partition: FrameRange | None) -> Iterator[tuple]:
        if partition is None:  # Spark's stand-in where nothing is planned
            return
        opened = decoder(self.decoder, partition.path)
        step = plan(opened.fps, opened.total_frames, self.conf)[2]
        for i, frame in opened.read(partition.start, partition.stop, step):
            height, width = frame.shape[:2]
            yield partition.path, i, float(opened.fps), width, height, frame.tobytes()
