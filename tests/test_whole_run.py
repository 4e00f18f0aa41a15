"""From labelled frames and an .mp4 to the filled table, by the command lines alone."""

from __future__ import annotations

import sys

import numpy as np

from framegrid.functions import jpeg
from framegrid.plans import pipeline, train
from framegrid.sources import sheets, sinks
from framegrid.streaming import resume
from test_media import recording

SIZE = 186
YY, XX = np.mgrid[:SIZE, :SIZE]
COLOURS = ((60, 220, 60), (220, 160, 40))


def scene(seed: int, centre: tuple[int, int] | None, colour: tuple[int, int, int]) -> np.ndarray:
    image = np.random.default_rng(seed).integers(0, 60, (SIZE, SIZE, 3), dtype=np.uint8)
    if centre:
        d = np.hypot(XX - centre[0], YY - centre[1])
        image[np.abs(d - 12) < 1.2] = colour
        image[d < 7] = (40, 40, 200)
    return image


def place(i: int) -> tuple[int, int] | None:
    return None if i % 6 == 5 else (25 + (i * 37) % 136, 25 + (i * 53) % 136)


def run(monkeypatch, module, *args: str) -> None:
    monkeypatch.setattr(sys, "argv", ["prog", *args])
    module.main()


def test_command_lines(spark, tmp_path, monkeypatch, capsys):
    home = tmp_path / "game/video_footage"
    home.mkdir(parents=True)
    seconds = 130  # a frame a second: 40, 43, ... 127 are sampled
    frames = [jpeg.encode(scene(i, place(i), COLOURS[i % 2]), 95, False) for i in range(seconds)]
    (home / "game.mp4").write_bytes(recording(frames, timescale=30, delta=30, per_chunk=7))

    (tmp_path / "boxes.csv").write_text("frame_index,l,t,r,b\n" + "".join(f"{i},0.0,0.0,{185 / 186},{185 / 186}\n" for i in range(0, 40, 4)))
    run(monkeypatch, train, "box", str(home / "game.mp4"), str(tmp_path / "boxes.csv"), str(tmp_path / "box.npz"), "--trees", "5", "--depth", "4")

    labels = ["file,time_s,status,px,py"]
    for i in range(200, 236):
        name, at = f"frame_{i:04d}_{i}.0s.jpg", place(i)
        sinks.write_file(str(tmp_path / "labelled" / name), jpeg.jpeg(scene(i, at, COLOURS[i % 2])))
        labels.append(f"{name},{i}.0," + (f"found,{at[0]},{at[1]}" if at else "empty,,"))
    (tmp_path / "labels.csv").write_text("\n".join(labels) + "\n")
    run(monkeypatch, train, "ring", str(tmp_path / "labelled"), str(tmp_path / "labels.csv"), str(tmp_path / "ring.npz"), "--trees", "20", "--depth", "5")

    (tmp_path / "map.csv").write_text("行,列,符号\n" + "".join(f"{r},{c},p{r}\n" for r in range(20) for c in range(20)), encoding="utf-8")
    args = ["--document", "game", "--apply-root", str(tmp_path), "--symbols", str(tmp_path / "map.csv"), "--forest", str(tmp_path / "box.npz"), "--model", str(tmp_path / "ring.npz")]
    run(monkeypatch, pipeline, *args, "--workers", "4")
    said = capsys.readouterr().out
    assert "30 rows" in said and "'normal': 30" in said and "'remaining': 0" in said, said

    crops = sorted((tmp_path / "game/subproject1").glob("frame_*.jpg"))
    assert len(crops) == 30
    assert all(p.read_bytes().startswith(b"\xff\xd8") for p in crops)  # JPEG by content, not by name alone
    rows = {round(r.time_s): r for r in resume.recorded(spark, str(tmp_path / "game/subproject2")).collect()}
    right = [t for t, r in rows.items() if (r.px is None if place(t) is None else r.px is not None and max(abs(r.px - place(t)[0]), abs(r.py - place(t)[1])) <= 2)]
    assert len(rows) == len(crops) and len(right) >= len(rows) - 1
    cells = sheets._cells(str(tmp_path / "game/subproject3/filled.xlsx"))
    events = [x for (r, c), v in cells.items() if r > 1 and c > 1 for x in v.split("_")]
    assert len(events) == len(rows) and events.count("EM") == sum(r.px is None for r in rows.values())
    run(monkeypatch, pipeline, *args)  # all is recorded
    assert "'new': 0" in capsys.readouterr().out
