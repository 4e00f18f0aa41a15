"""Detection in committed batches: crashes, limits, replayed batches, old position files, rebuilt archives."""

from __future__ import annotations

import pathlib

import numpy as np
import pytest

from framegrid.functions import jpeg, vision
from framegrid.operators import detect
from framegrid.plans import stage2
from framegrid.sources import frames as names_source
from framegrid.sources import sinks
from framegrid.streaming import resume

POSITIONS = "document string, file string, time_s double, status string, px int, py int"


def spot(x: int, y: int, size: int = 24) -> np.ndarray:
    image = np.zeros((size, size, 3), np.uint8)
    image[y - 2 : y + 3, x - 2 : x + 3] = (60, 220, 60)
    return image


def name(i: int) -> str:
    return f"frame_{i:04d}_{40 + 3 * i}.0s.jpg"


def write(folder: pathlib.Path, n: int, first: int = 0) -> None:
    folder.mkdir(exist_ok=True)
    content = [vision.png(spot(5 + k, 12)) for k in range(4)] + [vision.png(np.zeros((24, 24, 3), np.uint8))]
    for i in range(first, n):
        (folder / name(i)).write_bytes(content[i % 5])


class Counted:
    """Finds the green spot; leaves a line for each image, and stops at the image that a file names."""

    def __init__(self, folder: str) -> None:
        self.folder = pathlib.Path(folder)

    def __call__(self, image):
        with (self.folder / "seen").open("a") as f:
            f.write("x\n")
        if (self.folder / "stop").exists() and len((self.folder / "seen").read_text().split()) > 300:
            raise RuntimeError("the detector broke down")
        return vision.CentroidDetector()(image)


def counted(folder: str):
    def make():
        return Counted(folder)

    return make


def test_a_run_that_breaks_down_goes_on(spark, tmp_path):
    frames, out = tmp_path / "frames", str(tmp_path / "out")
    write(frames, 400)
    (tmp_path / "stop").touch()
    with pytest.raises(Exception, match="broke down"):
        stage2.detect_frames(spark, str(frames), out, counted(str(tmp_path)), "d", workers=2, files_per_batch=50)
    done = resume.recorded(spark, out).count()
    assert done == 300  # six batches of fifty
    (tmp_path / "stop").unlink()
    (tmp_path / "seen").unlink()
    result = stage2.detect_frames(spark, str(frames), out, counted(str(tmp_path)), "d", workers=2, files_per_batch=50)
    assert len((tmp_path / "seen").read_text().split()) == 100 and (result["new"], result["remaining"]) == (100, 0)
    rows = resume.recorded(spark, out).collect()
    assert sorted(r.file for r in rows) == [name(i) for i in range(400)]
    assert all((r.status, r.px, r.time_s) == (("empty", None) if int(r.ord) % 5 == 4 else ("found", 5 + int(r.ord) % 5)) + (40.0 + 3 * int(r.ord),) for r in rows)
    again = stage2.detect_frames(spark, str(frames), out, counted(str(tmp_path)), "d")
    assert again["new"] == 0 and again["found"] == 320 and again["empty"] == 80


def test_a_batch_is_committed_once(spark, tmp_path):
    out = str(tmp_path)
    rows = spark.createDataFrame([("d", name(0), 40.0, "found", 1, 2)], POSITIONS)
    others = spark.createDataFrame([("d", name(1), 43.0, "found", 1, 2), ("d", name(2), 46.0, "empty", None, None)], POSITIONS)
    assert resume.commit(rows, out, 0, 0) == 1 and resume.commit(others, out, 0, 0) == 0  # the same batch again
    assert resume.commit(others, out, 0, 1) == 2 and resume.recorded(spark, out).count() == 3
    (tmp_path / "recorded/run=000000/batch=000001/_SUCCESS").unlink()  # as a crash leaves it
    assert resume.recorded(spark, out).count() == 1
    assert resume.next_run(out) == 1 and not (tmp_path / "recorded/run=000000/batch=000001").exists()
    assert resume.commit(others, out, 1, 0) == 2 and resume.recorded(spark, f"file://{out}").count() == 3


def test_limit_takes_the_first_names(spark, tmp_path):
    frames, out = tmp_path / "frames", str(tmp_path / "out")
    write(frames, 30, first=10)
    first = stage2.detect_frames(spark, str(frames), out, vision.CentroidDetector, "d", limit=7, files_per_batch=5)
    assert first["new"] == 7 and {r.file for r in resume.recorded(spark, out).collect()} == {name(i) for i in range(10, 17)}
    write(frames, 10)  # earlier names turn up later
    second = stage2.detect_frames(spark, str(frames), out, vision.CentroidDetector, "d", limit=4, files_per_batch=5)
    assert second["new"] == 4 and {r.file for r in resume.recorded(spark, out).collect()} == {name(i) for i in [*range(4), *range(10, 17)]}
    assert stage2.detect_frames(spark, str(frames), out, vision.CentroidDetector, "d", limit=0)["new"] == 0
    rest = stage2.detect_frames(spark, str(frames), out, vision.CentroidDetector, "d", workers=3)
    assert rest["new"] == 19 and rest["remaining"] == 0


def test_many_names(spark, tmp_path, monkeypatch):
    """A hundred thousand names: dealt out in batches, the limit kept, nothing collected."""
    folder = tmp_path / "frames"
    folder.mkdir()
    for i in range(100_000):
        (folder / f"frame_{i:06d}_1.0s.jpg").touch()
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda self: pytest.fail("collected"))
    new = resume.run(spark, str(folder), str(tmp_path / "out"), vision.CentroidDetector, "d", limit=2500, files_per_batch=1000)
    monkeypatch.undo()
    rows = resume.recorded(spark, str(tmp_path / "out"))
    assert new == 2500 and rows.where("status = 'unreadable'").count() == 2500
    assert rows.selectExpr("max(file) as m").first().m == "frame_002499_1.0s.jpg"


def test_offsets_of_the_names():
    def reader(folder, **options):
        return names_source.FrameNamesReader({"path": folder, "document": "d", **{k: str(v) for k, v in options.items()}})

    import tempfile

    with tempfile.TemporaryDirectory() as folder:
        for i in range(25):
            pathlib.Path(folder, name(i)).touch()
        pathlib.Path(folder, "thumb_1.jpg").touch()
        source = reader(folder, files_per_batch=10, files_per_task=4)
        start = source.initialOffset()
        end = source.latestOffset()
        assert source.latestOffset() == end == {"after": name(9)}  # not reached yet, so not admitted further
        parts = source.partitions(start, end)
        assert [len(p.names) for p in parts] == [4, 4, 2] and [r for p in parts for r in source.read(p)] == [("d", name(i)) for i in range(10)]
        assert source.latestOffset() == {"after": name(19)}
        assert [n for p in reader(folder, files_per_batch=3).partitions(start, {"after": name(19)}) for n in p.names] == [name(i) for i in range(20)]  # replayed under other options
        source.partitions({"after": name(9)}, {"after": name(24)})
        assert source.latestOffset() == {"after": name(24)}
        pathlib.Path(folder, name(30)).touch()
        assert source.latestOffset() == {"after": name(30)}
    assert reader("/nowhere/at/all").latestOffset() == {"after": ""}


def test_an_old_position_file_counts(spark, tmp_path):
    frames, out = tmp_path / "frames", tmp_path / "out"
    write(frames, 12)
    out.mkdir()
    lines = [f"{name(i)},{40 + 3 * i}.0,found,{i},7" if i % 2 else f"{name(i)},{40 + 3 * i}.0,empty,," for i in range(8)]
    (out / "hero_position.csv").write_text("﻿file,time_s,status,px,py\r\n" + "\r\n".join(lines) + "\r\n", encoding="utf-8")
    result = stage2.detect_frames(spark, str(frames), str(out), vision.CentroidDetector, "d")
    rows = {r.file: r for r in resume.recorded(spark, str(out)).collect()}
    assert result["new"] == 4 and len(rows) == 12 and (rows[name(3)].px, rows[name(3)].py, rows[name(2)].status) == (3, 7, "empty")
    assert stage2.detect_frames(spark, str(frames), str(out), vision.CentroidDetector, "d")["new"] == 0


def test_unreadable_and_missing_files(spark, tmp_path):
    frames = tmp_path / "frames"
    write(frames, 3)
    (frames / name(3)).write_bytes(b"no image")
    (frames / name(4)).write_bytes(jpeg.jpeg(spot(9, 12)))
    result = stage2.detect_frames(spark, str(frames), str(tmp_path / "out"), vision.CentroidDetector, "d")
    rows = {r.file: r for r in resume.recorded(spark, str(tmp_path / "out")).collect()}
    assert rows[name(3)].status == "unreadable" and abs(rows[name(4)].px - 9) <= 1 and result["found"] == 4 and result["remaining"] == 0
    named = spark.createDataFrame([("d", "frame_0009_1.0s.jpg")], "document string, file string")
    with pytest.raises(Exception, match="frame_0009"):  # a file that went away is an error, not an empty frame
        detect.detect_files(named, str(frames), vision.CentroidDetector, lambda x: None).collect()


def test_lines_of_progress(spark, tmp_path):
    frames, lines = tmp_path / "frames", []
    write(frames, 60)
    stage2.detect_frames(spark, str(frames), str(tmp_path / "out"), vision.CentroidDetector, "d", workers=2, files_per_batch=20, say=lines.append)
    assert lines and int(lines[-1].split()[0]) == 60


def test_a_rebuilt_folder_is_whole(tmp_path):
    folder = str(tmp_path / "EM")

    def build(text: str, fails: bool = False):
        def to(path: str) -> int:
            sinks.write_file(f"{path}/a.txt", text.encode())
            if fails:
                raise OSError("the disk is full")
            sinks.write_file(f"{path}/b.txt", text.encode())
            return 2

        return to

    def held() -> dict:
        return {str(p.relative_to(tmp_path)): p.read_text() for p in tmp_path.rglob("*") if p.is_file()}

    assert sinks.rebuild(folder, build("one")) == 2 and held() == {"EM/a.txt": "one", "EM/b.txt": "one"}
    with pytest.raises(OSError, match="full"):
        sinks.rebuild(folder, build("two", fails=True))
    assert held() == {"EM/a.txt": "one", "EM/b.txt": "one"}
    (tmp_path / "EM").rename(tmp_path / "_EM.before")  # as a run leaves it that ends between the two moves
    with pytest.raises(OSError, match="full"):
        sinks.rebuild(folder, build("two", fails=True))
    assert held() == {"EM/a.txt": "one", "EM/b.txt": "one"}
    sinks.rebuild(f"file://{folder}", build("three"))
    assert held() == {"EM/a.txt": "three", "EM/b.txt": "three"}
