"""Sources, sinks, image primitives, the resumable stream and a whole run on made-up frames."""

from __future__ import annotations

import math
import random
import re
import zipfile

import numpy as np
import pytest

from framegrid.functions import vision
from framegrid.operators import fill, forest, locate
from framegrid.plans import pipeline, stage2, train
from framegrid.sources import files, sheets, sinks, video
from framegrid.streaming import cells, windows


def spot(x: int, y: int, size: int = 64) -> np.ndarray:
    image = np.zeros((size, size, 3), np.uint8)
    image[y - 1 : y + 2, x - 1 : x + 2] = (60, 220, 60)
    return image


def centre():
    return vision.CentroidDetector()


def test_csv(spark, tmp_path):
    (tmp_path / "map.md").write_text("﻿行,列,符号\n0,1, a \n0,1,b\n0,2,\n", encoding="utf-8")
    got = {(r.row, r.col): r.symbol for r in locate.last_symbols(files.symbols(spark, str(tmp_path / "map.md"))).collect()}
    assert got == {(0, 1): "b", (0, 2): ""}
    (tmp_path / "p.csv").write_text("﻿file,time_s,status,px,py\r\nf,41.5,found,93,3\r\ng,41.0,empty,,\r\n", encoding="utf-8")
    rows = locate.typed_positions(files.positions(spark, str(tmp_path / "p.csv"), "d")).orderBy("ord").collect()
    assert [(r.file, r.time_s, r.px) for r in rows] == [("f", 41.5, 93), ("g", 41.0, None)]
    sinks.csv(spark.createDataFrame([("a", None)], "x string, y int"), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("*.csv")).read_bytes()
    assert text == "﻿x,y\na,\n".encode()


def test_one_video(spark, tmp_path):
    folder = tmp_path / "video_footage"
    with pytest.raises(FileNotFoundError):
        files.one_video(spark, str(tmp_path))
    folder.mkdir()
    (folder / "a.mp4").write_bytes(b"x")
    assert files.one_video(spark, str(tmp_path)).endswith("a.mp4")
    (folder / "b.mp4").write_bytes(b"x")
    with pytest.raises(RuntimeError):
        files.one_video(spark, str(tmp_path))


def test_sheet(tmp_path):
    base, out = str(tmp_path / "base.xlsx"), str(tmp_path / "out.xlsx")
    sheets.fill(None, base, [(0, 1, "old")], (["00:40", "02:10"], ["1", "2", "3"]))
    assert sheets.axes(base) == sheets.axes(f"file://{base}") == (2, 3)
    with pytest.raises(KeyError, match="Sheet1"):  # what there is instead
        sheets._cells(base, "Sheet2")
    sheets.fill(base, out, [(1, 2, "a_b<&")])
    cells = sheets._cells(out)
    assert cells[4, 3] == "a_b<&" and cells[3, 2] == "old" and cells[1, 2] == "00:40"


def test_other_sheets_and_styles_stay(tmp_path):
    base, out = str(tmp_path / "base.xlsx"), str(tmp_path / "out.xlsx")
    sheets.fill(None, base, [(0, 0, "old"), (2, 1, "far")], (["00:40", "02:10"], ["1", "2"]))
    with zipfile.ZipFile(base) as z:
        parts = {n: z.read(n) for n in z.namelist()}
    parts["xl/worksheets/sheet2.xml"] = parts["xl/worksheets/sheet1.xml"]  # the table is in the second part, under its name
    parts["xl/worksheets/sheet1.xml"] = parts["xl/worksheets/sheet1.xml"].replace(b"old", b"notes")
    parts["xl/workbook.xml"] = parts["xl/workbook.xml"].replace(b"<sheets>", b'<sheets><sheet name="Notes" sheetId="7" r:id="r1"/>').replace(b'sheetId="1" r:id="r1"', b'sheetId="1" r:id="r9"')
    parts["xl/_rels/workbook.xml.rels"] = parts["xl/_rels/workbook.xml.rels"].replace(b"<Relationship Id=", b'<Relationship Id="r9" Type="sheet" Target="worksheets/sheet2.xml"/><Relationship Id=', 1)
    with zipfile.ZipFile(base, "w") as z:
        for n, content in parts.items():
            z.writestr(n, content)
    sheets.fill(base, out, [(1, 0, "new"), (0, 0, "over"), (0, 3, "below")])
    assert sheets._cells(out) == sheets._cells(base) | {(2, 3): "new", (2, 2): "over", (5, 2): "below"}
    assert sheets._cells(out, "Notes") == sheets._cells(base, "Notes") and "notes" in sheets._cells(out, "Notes").values()
    with zipfile.ZipFile(out) as z:
        assert z.read("xl/worksheets/sheet1.xml") == parts["xl/worksheets/sheet1.xml"] and z.read("xl/styles.xml").count(b'numFmtId="49"') == 2
        row = re.search(rb'<row r="2".*?</row>', z.read("xl/worksheets/sheet2.xml"), re.S)[0]
        assert re.findall(rb'r="([A-Z]+)2"', row) == [b"A", b"B", b"C"]


def test_stream_of_windows(spark, tmp_path):
    rows = spark.sql("select timestamp_seconds(id) as ts, id % 2 as user_id from range(0, 60)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = windows.tumbling(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("tumbled").collect())) == sorted(map(tuple, windows.tumbling(rows).collect()))


def test_streamed_cells(spark, tmp_path):
    """Batches in any order of time, late rows among them: the cells are the batch's own; what is later than allowed is left out."""
    rng = random.Random(3)
    fields = "document long, ord long, file string, time_s double, status string, px int, py int"
    rows = [(i % 3, i, f"f{i}", round(30 + i * 1.7 + rng.random() * 5, 1), "found" if i % 4 else "empty", (i * 37) % 186, (i * 53) % 186) for i in range(600)]
    symbols = spark.createDataFrame([(r, c, f"s{r}{c}" if (r + c) % 3 else "", 20 * r + c) for r in range(20) for c in range(20)], "row int, col int, symbol string, ord long")
    after = (9, 10_000, "end", 5000.0, "empty", None, None)  # outside of the table: it only moves the watermark
    (tmp_path / "in").mkdir()
    got = None
    for k in range(0, 600, 100):
        part = rows[k : k + 100]
        rng.shuffle(part)
        spark.createDataFrame(part, fields).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = cells.cells(spark.readStream.schema(fields).parquet(str(tmp_path / "in")), symbols, late="1 minute")
        before, got = got, cells.run(stream, str(tmp_path / "out"), str(tmp_path / "state")).count()
        assert before is None or got > before  # cells are given as they close
    late = (0, 700, "late", 45.0, "found", 5, 5)
    spark.createDataFrame([late, after], fields).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    result = cells.run(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    samples = spark.createDataFrame(rows, fields)
    want = fill.cell_strings(locate.placed(locate.events(samples, symbols)))
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, want.collect()))


def test_streamed_cells_are_kept_until_they_close(spark, tmp_path):
    """A position behind the watermark is kept while its cell is open, and no Python runs for a cell."""
    fields = "document long, ord long, file string, time_s double, status string, px int, py int"
    symbols = spark.createDataFrame([(0, 0, "a", 0)], "row int, col int, symbol string, ord long")
    (tmp_path / "in").mkdir()
    got = []
    for part in ([(1, 0, "f", 41.0, "found", 5, 5), (1, 1, "f", 50.0, "empty", None, None)], [(1, 2, "f", 45.0, "found", 99, 99)], [(1, 3, "f", 55.0, "empty", None, None)],
                 [(1, 4, "f", 54.9, "found", 5, 5), (2, 5, "f", 5000.0, "empty", None, None)]):
        spark.createDataFrame(part, fields).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = cells.cells(spark.readStream.schema(fields).parquet(str(tmp_path / "in")), symbols, late="0 seconds")
        got.append(sorted(map(tuple, cells.run(stream, str(tmp_path / "out"), str(tmp_path / "state")).collect())))
    assert got == [[], [], [(1, 0, 0, "a_UN_EM")], [(1, 0, 0, "a_UN_EM"), (1, 0, 1, "EM")]]  # 54.9 comes after its cell was given
    assert "Python" not in stream._jdf.queryExecution().toString()


def test_frame_plan():
    assert video.plan(60.4, 50000, pipeline.Sampling())[2] == 181
    assert video.plan(0, 3000, pipeline.Sampling()) == (1200, 3000, 90)


def test_image_primitives():
    image = np.arange(10 * 12 * 3, dtype=np.uint8).reshape(10, 12, 3)
    assert (vision.crop_resize(image, (0, 0, 9, 9), 10) == image[:, :10]).all()
    for size in (5, 7, 20, 24):  # other sizes against worked weights, one place at a time
        got = vision.crop_resize(image, (1, 2, 9, 8), size)
        part = image[2:9, 1:10].astype(float)

        def weight(d):
            d = abs(d)
            return 1.25 * d**3 - 2.25 * d**2 + 1 if d <= 1 else -0.75 * d**3 + 3.75 * d**2 - 6 * d + 3 if d < 2 else 0.0

        for y, x in ((0, 0), (size // 2, size // 3), (size - 1, size - 1)):
            v, u = (y + 0.5) * 7 / size - 0.5, (x + 0.5) * 9 / size - 0.5
            a, b = math.floor(v), math.floor(u)
            sums = sum(
                weight(v - i) * weight(u - j) * part[min(max(i, 0), 6), min(max(j, 0), 8)] for i in range(a - 1, a + 3) for j in range(b - 1, b + 3)
            )
            assert (np.abs(np.clip(sums, 0, 255) - got[y, x]) <= 0.5 + 1e-9).all()
    ring = np.zeros((60, 60), bool)
    yy, xx = np.mgrid[:60, :60]
    ring[np.abs(np.hypot(yy - 30, xx - 25) - 12) < 1] = True
    best = vision.peaks(*vision.ring_coverage(ring))[0]
    assert best[:2] == (25, 30) and best[2] > 0.9
    hole = np.ones((5, 5), bool)
    hole[2, 2] = False
    assert vision.closing(hole).all()
    assert len(vision.roi_features(spot(20, 20))) == len(vision.roi_features(spot(5, 5, 9))) == 192 + 24 + 6 + 11


def whole_frame():
    return lambda frame: (0.0, 0.0, 1.0, 1.0)


def fails():
    def detector(image):
        raise AssertionError("detected again")

    return detector


def test_whole_run(spark, tmp_path):
    home = tmp_path / "doc/video_footage"
    home.mkdir(parents=True)
    frames = [spot(20, 30)] * 600
    frames[430] = np.zeros((64, 64, 3), np.uint8)
    with (home / "a.mp4").open("wb") as f:
        np.save(f, np.stack(frames))
    (tmp_path / "map.csv").write_text("行,列,符号\n9,6,s\n", encoding="utf-8")
    conf = pipeline.Conf(str(tmp_path), str(tmp_path / "map.csv"), predictor=whole_frame, detector=centre, limit=3)
    result = pipeline.run(spark, "doc", conf)
    assert {k: v for k, v in result["stage1"].items() if k != "seconds"} == {"total": 7, "anomaly": 0, "normal": 7}
    assert (result["stage2"]["found"], result["stage2"]["empty"], result["stage2"]["remaining"], result["stage2"]["new"]) == (2, 1, 4, 3)
    conf.limit = None
    result = pipeline.run(spark, "doc", conf)
    assert (result["stage2"]["found"], result["stage2"]["empty"], result["stage2"]["remaining"], result["stage2"]["new"]) == (6, 1, 0, 4)
    assert result["stage2"]["copied"] == 1 and [p.name for p in (tmp_path / "doc/subproject2/EM").glob("*.jpg")] == ["frame_0001_43.0s.jpg"]
    conf.detector = fails
    again = pipeline.run(spark, "doc", conf)
    assert again["stage2"]["new"] == 0 and again["stage2"]["found"] == 6 and again["seconds"] > 0
    assert result["stage3"]["filled_cells"] == 2 and result["stage3"]["un_count"] in (0, 6)
    assert result["stage3"]["copied"] == (6 if result["stage3"]["un_count"] else 0)
    cells = sheets._cells(str(tmp_path / "doc/subproject3/filled.xlsx"))
    assert sum(len(v.split("_")) for (r, c), v in cells.items() if r > 1 and c > 1) == 7


def test_no_frames(spark, tmp_path):
    (tmp_path / "frames").mkdir()
    for folder in ("frames", "nowhere"):
        with pytest.raises(FileNotFoundError):
            stage2.detect_frames(spark, str(tmp_path / folder), str(tmp_path / "out"), centre)


def test_end_and_default_rate_reach_the_reader(spark, tmp_path):
    with (tmp_path / "a.npy").open("wb") as f:
        np.save(f, np.stack([spot(20, 30)] * 600))
    video.register(spark)
    read = spark.read.format("video_frames").option("start_s", 40.0).option("interval_s", 3.0)
    assert sorted(r.frame_index for r in read.option("end_s", 46.0).load(str(tmp_path / "a.npy")).collect()) == [400, 430, 460]
    conf = pipeline.Conf("", "", predictor=whole_frame, sampling=pipeline.Sampling(end_s=46.0))
    assert pipeline.extract(spark, str(tmp_path / "a.npy"), "d", conf, str(tmp_path / "crops")).count() == 3
    assert video.VideoReader({"path": "x", "default_fps": "25.0"}).conf.default_fps == 25.0


def test_box_forest_in_the_run(spark, tmp_path):
    frames = [spot(20 + i % 5, 30) for i in range(600)]
    with (tmp_path / "a.npy").open("wb") as f:
        np.save(f, np.stack(frames))
    (tmp_path / "boxes.csv").write_text("frame_index,l,t,r,b\n" + "".join(f"{i},0.0,0.0,1.0,1.0\n" for i in range(0, 60, 3)))
    made = train.box(spark, str(tmp_path / "a.npy"), str(tmp_path / "boxes.csv"), str(tmp_path / "box.npz"), forest.Growth(trees=2, depth=2))
    assert made["trees"] == 2
    conf = pipeline.Conf("", "", forest=str(tmp_path / "box.npz"))
    rows = pipeline.extract(spark, str(tmp_path / "a.npy"), "d", conf, str(tmp_path / "crops")).collect()
    assert len(rows) == 7 and all(len(r.data) == 186 * 186 * 3 and not r.anomaly for r in rows)


def test_uncompressed_recording(tmp_path):
    def planes(y, u, v):
        return b"FRAME\n" + bytes([y]) * 12 + bytes([u]) * 4 + bytes([v]) * 4

    (tmp_path / "a.y4m").write_bytes(b"YUV4MPEG2 W4 H3 F30000:1001 Ip C420jpeg\n" + planes(16, 128, 128) + planes(235, 128, 128) + planes(81, 90, 240) + b"FRAME\ncut")
    opened = video.Y4mDecoder(f"file:{tmp_path / 'a.y4m'}")
    assert (opened.total_frames, round(opened.fps, 2)) == (3, 29.97)
    got = dict(opened.read(0, 9, 1))
    assert (got[0] == 0).all() and (got[1] == 255).all() and got[2].shape == (3, 4, 3)
    assert got[2][0, 0, 2] > 250 and got[2][0, 0, 0] < 5 and got[2][0, 0, 1] < 5  # red
    assert [i for i, _ in opened.read(0, 3, 2)] == [0, 2]
