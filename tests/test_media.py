"""JPEG and PNG, MP4 recordings made by hand, and conditions that reach the video source."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest

from framegrid.functions import images, jpeg, vision
from framegrid.sources import mp4, video


def picture(h: int = 37, w: int = 53) -> np.ndarray:
    yy, xx = np.mgrid[:h, :w]
    return np.stack([128 + 100 * np.sin(yy / 9), 128 + 90 * np.cos(xx / 11), (yy * 2 + xx) % 256 / 2 + 40], axis=-1).astype(np.uint8)


def noise(h: int = 40, w: int = 24) -> np.ndarray:
    return np.random.default_rng(3).integers(0, 256, (h, w, 3), dtype=np.uint8)


def test_jpeg_tables():
    assert jpeg.ZIGZAG[:6].tolist() == [0, 1, 8, 16, 9, 2] and sorted(jpeg.ZIGZAG.tolist()) == list(range(64))
    for counts, symbols in (jpeg.DC_LUMA, jpeg.DC_CHROMA, jpeg.AC_LUMA, jpeg.AC_CHROMA):
        assert sum(counts) == len(symbols) == len(set(symbols))
    assert jpeg.quantisation(jpeg.LUMA, 95)[:3].tolist() == [2, 1, 1] and jpeg.quantisation(jpeg.LUMA, 50).tolist() == jpeg.LUMA
    assert np.allclose(jpeg.COSINES @ jpeg.COSINES.T, np.eye(8))


@pytest.mark.parametrize("halved", [False, True])
def test_own_files_read_back(halved):
    for pixels in (picture(), picture(8, 8), picture(1, 1), np.zeros((17, 16, 3), np.uint8), np.full((186, 186, 3), 255, np.uint8)):
        back = jpeg.decode(jpeg.encode(pixels, 95, halved))
        error = np.abs(back.astype(int) - pixels)
        assert back.shape == pixels.shape and error.mean() < (3 if halved else 1.5) and error.max() <= (32 if halved else 8)
    back = jpeg.decode(jpeg.encode(noise(), 100, False))  # long runs, all sizes of coefficients
    assert np.abs(back.astype(int) - noise()).max() <= 3


def luma(pixels: np.ndarray) -> np.ndarray:
    return pixels.astype(float) @ np.array([0.114, 0.587, 0.299])


def decoded_by_spark(spark, folder) -> dict[str, np.ndarray]:
    rows = [r.image for r in spark.read.format("image").load(str(folder)).collect()]
    arrays = {r.origin.rpartition("/")[2]: np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels) for r in rows}
    return {k: np.repeat(v, 3, axis=-1) if v.shape[-1] == 1 else v for k, v in arrays.items()}


@pytest.mark.parametrize("halved", [False, True])
def test_another_reader_agrees(spark, tmp_path, halved):
    """Spark's image source opens the files. Its pixels are ours within rounding; halved colours it smooths, so there brightness is compared."""
    for i, pixels in enumerate((picture(), picture(186, 186), noise())):
        (tmp_path / f"{i}.jpg").write_bytes(jpeg.encode(pixels, 95, halved))
    for name, theirs in decoded_by_spark(spark, tmp_path).items():
        ours = jpeg.decode((tmp_path / name).read_bytes())
        if not halved:
            assert np.abs(theirs.astype(int) - ours).max() <= 2
        elif name != "2.jpg":  # noise leaves the range of colours, where brightness is cut off
            assert np.abs(luma(theirs) - luma(ours)).max() <= 4


def java_jpeg(spark, pixels: np.ndarray, kind: int) -> bytes:
    """A file that Java's writer makes: type 5 has three bytes a pixel, 10 is grey."""
    jvm = spark.sparkContext._jvm
    image = jvm.java.awt.image.BufferedImage(pixels.shape[1], pixels.shape[0], kind)
    for y in range(pixels.shape[0]):
        for x in range(pixels.shape[1]):
            b, g, r = (int(v) for v in pixels[y, x])
            image.setRGB(x, y, (0xFF << 24 | r << 16 | g << 8 | b) - (1 << 32))
    out = jvm.java.io.ByteArrayOutputStream()
    assert jvm.javax.imageio.ImageIO.write(image, "jpg", out)
    return bytes(out.toByteArray())


def test_files_of_another_writer(spark, tmp_path):
    (tmp_path / "colour.jpg").write_bytes(java_jpeg(spark, picture(19, 21), 5))
    (tmp_path / "grey.jpg").write_bytes(java_jpeg(spark, picture(19, 21), 10))
    for name, theirs in decoded_by_spark(spark, tmp_path).items():
        ours = jpeg.decode((tmp_path / name).read_bytes())
        assert np.abs(luma(theirs) - luma(ours)).max() <= 4 and (name != "grey.jpg" or np.abs(theirs.astype(int) - ours).max() <= 2)


def test_restart_intervals():
    pixels = picture(32, 32)
    whole = jpeg.encode(pixels, 90, False)
    head, data = whole[: whole.index(b"\xff\xda")], whole[whole.index(b"\xff\xda") :]
    planes = jpeg._planes(pixels)
    quant = [jpeg.quantisation(jpeg.LUMA, 90), jpeg.quantisation(jpeg.CHROMA, 90)]
    blocks = np.stack([jpeg._blocks(p, quant[min(i, 1)]).reshape(-1, 64) for i, p in enumerate(planes)], axis=1)
    component = np.tile(np.arange(3), 4)
    parts = [jpeg._bits(blocks[i : i + 4].reshape(-1, 64), component > 0, component) for i in range(0, 16, 4)]
    scan = b"".join(p + (bytes([0xFF, 0xD0 + i]) if i < 3 else b"") for i, p in enumerate(parts))
    file = head + b"\xff\xdd\0\4\0\4" + data[:14] + scan + b"\xff\xd9"
    assert (jpeg.decode(file) == jpeg.decode(whole)).all()
    with pytest.raises(ValueError):
        jpeg.decode(file[: -len(parts[3]) - 4])


def test_what_is_no_picture():
    good = jpeg.jpeg(picture())
    for bad in (b"", b"x", b"\xff\xd8", good[:200], good[: len(good) // 2], good.replace(b"\xff\xc0", b"\xff\xc2"), b"\x89PNG\r\n\x1a\nxx", vision.png(picture())[:60]):
        assert images.read(bad) is None
    assert images.read(good).shape == picture().shape and (images.read(vision.png(noise())) == noise()).all()


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    pixels = noise(7, 5).astype(int)[..., ::-1]
    up, left = np.pad(pixels, ((1, 0), (0, 0), (0, 0)))[:-1], np.pad(pixels, ((0, 0), (1, 0), (0, 0)))[:, :-1]
    corner = np.pad(pixels, ((1, 0), (1, 0), (0, 0)))[:-1, :-1]
    p = left + up - corner
    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
    guess = [0 * p, left, up, (left + up) // 2, np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))][kind]
    lines = ((pixels - guess) & 255).astype(np.uint8).reshape(7, -1)
    part = lambda k, body: struct.pack(">I", len(body)) + k + body + struct.pack(">I", zlib.crc32(k + body))
    raw = b"".join(bytes([kind]) + line.tobytes() for line in lines)
    content = b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", 5, 7, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")
    assert (images.read(content) == noise(7, 5)).all()


# recordings


def box(name: str, *parts: bytes, wide: bool = False) -> bytes:
    body = b"".join(parts)
    if wide:
        return struct.pack(">I4sQ", 1, name.encode(), len(body) + 16) + body
    return struct.pack(">I4s", len(body) + 8, name.encode()) + body


def table(name: str, *numbers: int, count: int | None = None) -> bytes:
    return box(name, struct.pack(f">II{len(numbers)}I", 0, len(numbers) if count is None else count, *numbers))


def recording(frames: list[bytes], timescale: int = 30000, delta: int = 1001, codec: bytes = b"jpeg", first: bool = False, version: int = 0, wide: bool = False, per_chunk: int = 3) -> bytes:
    """An MP4 with a sound track before the video track; the header stands before or after the media data."""
    chunks = [frames[i : i + per_chunk] for i in range(0, len(frames), per_chunk)]

    def header(at: int) -> bytes:
        offsets, place = [], at
        for c in chunks:
            offsets.append(place)
            place += sum(map(len, c)) + 5  # something else lies between chunks
        runs = [1, per_chunk, 1] + ([len(chunks), len(chunks[-1]), 1] if len(chunks) > 1 and len(chunks[-1]) != per_chunk else [])
        times = struct.pack(">IIII", 0, 0, timescale, delta * len(frames)) if version == 0 else struct.pack(">QQIQ", 0, 0, timescale, delta * len(frames))
        entry = box(codec.decode(), bytes(6) + struct.pack(">H", 1) + bytes(16) + struct.pack(">HH", 64, 48) + bytes(50))
        places = box("co64", struct.pack(f">II{len(offsets)}Q", 0, len(offsets), *offsets)) if wide else table("stco", *offsets)
        stbl = box(
            "stbl", box("stsd", struct.pack(">II", 0, 1), entry), table("stts", len(frames) - 1, delta, 1, delta, count=2), table("stsc", *runs, count=len(runs) // 3),
            box("stsz", struct.pack(f">III{len(frames)}I", 0, 0, len(frames), *map(len, frames))), places,
        )
        handler = lambda kind: box("hdlr", bytes(8) + kind + bytes(13))
        media = box("mdia", box("mdhd", bytes([version]) + bytes(3) + times + bytes(4)), handler(b"vide"), box("minf", stbl))
        sound = box("trak", box("mdia", handler(b"soun")))
        return box("moov", box("mvhd", bytes(100)), sound, box("trak", box("tkhd", bytes(84)), media))

    data = b"".join(b"".join(c) + b"other" for c in chunks)
    start = box("ftyp", b"isom\0\0\2\0")
    head = 16 if wide else 8
    if first:
        size = len(start) + len(header(0)) + head
        return start + header(size) + box("mdat", data, wide=wide)
    return start + box("mdat", data, wide=wide) + header(len(start) + head)


def ring_frames(n: int) -> list[np.ndarray]:
    out = []
    for i in range(n):
        frame = np.full((48, 64, 3), 30, np.uint8)
        frame[10:20, 5 + i % 40 : 15 + i % 40] = (60, 220, 60)
        out.append(frame)
    return out


@pytest.mark.parametrize("first", [False, True])
@pytest.mark.parametrize("version", [0, 1])
@pytest.mark.parametrize("wide", [False, True])
def test_mp4_says(tmp_path, first, version, wide):
    frames = [jpeg.encode(f, 90) for f in ring_frames(7)]
    (tmp_path / "a.mp4").write_bytes(recording(frames, first=first, version=version, wide=wide))
    for path in (str(tmp_path / "a.mp4"), f"file:{tmp_path}/a.mp4", f"file://{tmp_path}/a.mp4"):
        found = mp4.info(path)
        assert (round(found.fps, 3), found.total_frames, found.width, found.height, found.codec) == (29.97, 7, 64, 48, "jpeg")
        assert found.duration_s == pytest.approx(7 * 1001 / 30000) and found.sizes.tolist() == [len(f) for f in frames]
    content = (tmp_path / "a.mp4").read_bytes()
    assert [content[o : o + s] for o, s in zip(found.offsets, found.sizes, strict=True)] == frames


def test_mp4_frames_by_place(tmp_path):
    plain = ring_frames(10)
    frames = [jpeg.encode(f, 95, False) for f in plain]
    frames[8] = b"\xff\xd8 no picture"
    (tmp_path / "a.mp4").write_bytes(recording(frames))
    opened = video.recording(str(tmp_path / "a.mp4"))
    got = dict(opened.read(1, 10, 3))
    assert sorted(got) == [1, 4, 7] and all(np.abs(got[i].astype(int) - plain[i]).mean() < 1 for i in got)
    assert [i for i, _ in opened.read(6, 10, 1)] == [6, 7]  # ends at what cannot be decoded
    (tmp_path / "b.mp4").write_bytes(recording([b"\0\0\0\1abc"] * 3, codec=b"avc1"))
    with pytest.raises(NotImplementedError, match="avc1"):
        list(mp4.Mp4Decoder(str(tmp_path / "b.mp4")).read(0, 3, 1))
    for bad in (b"", b"no recording at all", recording(frames)[:-40], box("moov", box("trak", box("mdia")))):
        (tmp_path / "c.mp4").write_bytes(bad)
        with pytest.raises(ValueError):
            mp4.info(str(tmp_path / "c.mp4"))


def test_recordings_are_known_by_content(tmp_path):
    with (tmp_path / "a.mp4").open("wb") as f:
        np.save(f, np.zeros((3, 4, 4, 3), np.uint8))
    assert isinstance(video.recording(str(tmp_path / "a.mp4")), video.ArrayDecoder)
    (tmp_path / "b.mp4").write_bytes(b"YUV4MPEG2 W4 H3 F25:1\n")
    assert isinstance(video.recording(str(tmp_path / "b.mp4")), video.Y4mDecoder)


class CountingDecoder(video.ArrayDecoder):
    """Leaves a file for each decoded frame."""

    def read(self, start, stop, step):
        import pathlib

        for i, frame in super().read(start, stop, step):
            (pathlib.Path(self.folder) / str(i)).touch()
            yield i, frame

    def __init__(self, path):
        import os

        super().__init__(path)
        self.folder = os.path.join(os.path.dirname(path), "decoded")


@pytest.mark.parametrize(
    ("where", "want"),
    [
        ("frame_index between 430 and 500", [430, 460, 490]), ("frame_index > 430 and frame_index <= 460", [460]), ("frame_index in (460, 461, 580)", [460, 580]),
        ("frame_index = 490", [490]), ("frame_index < 401", [400]), ("frame_index >= 599", []), ("frame_index = 490 and width = 4", [490]),
        ("frame_index in (400, 430) and frame_index in (430, 460)", [430]), ("frame_index <> 400", None), ("frame_index > 480 or frame_index < 410", None),
    ],
)
def test_conditions_reach_the_source(spark, tmp_path, where, want):
    (tmp_path / "decoded").mkdir()
    with (tmp_path / "a.npy").open("wb") as f:
        np.save(f, np.zeros((600, 4, 4, 3), np.uint8))
    video.register(spark)
    read = spark.read.format("video_frames").option("decoder", "test_media:CountingDecoder").option("samples_per_task", 2).load(str(tmp_path / "a.npy"))
    every = [400, 430, 460, 490, 520, 550, 580]
    got = sorted(r.frame_index for r in read.where(where).collect())
    seen = sorted(int(p.name) for p in (tmp_path / "decoded").iterdir())
    if want is None:  # Spark filters what the source does not take
        assert seen == every and 0 < len(got) < 7
    else:
        assert got == want and seen == want
