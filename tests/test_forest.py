"""The forest of several outputs against a plain one, and the ring detector that is learned from labelled frames."""

from __future__ import annotations

import random
import sys

import numpy as np
import pytest

from framegrid.functions import jpeg, vision
from framegrid.operators import forest, ring_model, roi_model
from framegrid.plans import stage2, train
from framegrid.sources import models
from framegrid.streaming import resume

ROWS = "features array<double>, target array<double>"


def table(spark, n: int = 120, seed: int = 0):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [float(rng.randrange(8)) for _ in range(5)]
        rows.append((x, [x[0] / 8 + rng.randrange(3) / 64, (x[1] + x[2]) / 16, float(x[3] > 3)]))
    return spark.createDataFrame(rows, ROWS).repartition(4)


def plain_tree(rows: list[tuple[int, list[float], list[int]]], edges: list[list[float]], growth: forest.Growth, tree: int, node: int = 1, depth: int = 0):
    """(times drawn, features, outputs in steps) to nested splits: every cut of every feature is tried by whole sums."""
    total = [sum(n for n, _, _ in rows), *(sum(n * y[k] for n, _, y in rows) for k in range(3))]
    leaf = [t / total[0] / forest.STEP for t in total[1:]]
    if depth == growth.depth:
        return leaf
    best, chosen = None, None
    before = sum(t * t for t in total[1:]) / total[0]
    for f in growth.features(tree, node, len(edges)).tolist():
        for edge in edges[f]:
            low, high = [r for r in rows if r[1][f] <= edge], [r for r in rows if r[1][f] > edge]
            n_low, n_high = sum(r[0] for r in low), sum(r[0] for r in high)
            if n_low < growth.least_rows or n_high < growth.least_rows:
                continue
            score = sum(sum(r[0] * r[2][k] for r in part) ** 2 / n for part, n in ((low, n_low), (high, n_high)) for k in range(3))
            if best is None or score > best * (1 + 1e-14):
                best, chosen = score, (f, edge, low, high)
    if best is None or best <= before * (1 + 1e-12) + 1e-9:
        return leaf
    f, edge, low, high = chosen
    return f, edge, plain_tree(low, edges, growth, tree, 2 * node, depth + 1), plain_tree(high, edges, growth, tree, 2 * node + 1, depth + 1)


def nested(model: forest.Forest, at: int):
    if model.feature[at] < 0:
        return model.value[at].tolist()
    return int(model.feature[at]), float(model.threshold[at]), nested(model, model.left[at]), nested(model, model.right[at])


@pytest.mark.parametrize("least", [1, 6])
def test_against_a_plain_forest(spark, least):
    df = table(spark)
    growth = forest.Growth(trees=4, depth=4, least_rows=least, feature_share=0.6, seed=3)
    model = forest.train(df, growth)
    held = df.selectExpr("xxhash64(features, target) as key", "features", "target").collect()
    edges = [sorted({r.features[f] for r in held})[:-1] for f in range(5)]
    steps = [[round(v * forest.STEP) for v in r.target] for r in held]
    for t in range(4):
        draws = growth.draws(np.array([r.key for r in held]), t).tolist()
        rows = [(n, list(r.features), y) for n, r, y in zip(draws, held, steps, strict=True) if n]
        assert nested(model, int(model.roots[t])) == plain_tree(rows, edges, growth, t)


def test_places_of_growth_do_not_matter(spark, monkeypatch):
    df = table(spark, 200, 1)
    growth = forest.Growth(trees=3, depth=4, feature_share=0.6)
    whole = forest.train(df, growth).arrays()
    for small, cells in ((0, 1 << 22), (40, 1 << 22), (0, 1000)):  # histograms to the end, half and half, many passes
        monkeypatch.setattr(forest, "MOST_CELLS", cells)
        other = forest.train(df.repartition(7), growth, small_rows=small)
        x = np.array([r.features for r in df.collect()])
        assert np.allclose(forest.Forest(**whole).predict(x), other.predict(x), atol=1e-12) and len(other.feature) == len(whole["feature"])


def test_draws_are_poisson():
    growth = forest.Growth()
    n = growth.draws(np.arange(20000), 3)
    assert abs(n.mean() - 1) < 0.03 and abs(n.var() - 1) < 0.05 and (n != growth.draws(np.arange(20000), 4)).mean() > 0.5


def test_cases(spark, tmp_path):
    model = forest.train(table(spark), forest.Growth(trees=3, depth=3))
    forest.save(model, str(tmp_path / "m.npz"))
    back = forest.load(f"file:{tmp_path / 'm.npz'}")
    x = np.random.default_rng(0).random((9, 5)) * 8
    assert (back.predict(x) == model.predict(x)).all()
    one = forest.train(spark.createDataFrame([([1.0], [0.25, 0.5])] * 3, ROWS), forest.Growth(trees=8, depth=2))
    assert np.allclose(one.predict(np.array([[7.0]])), [[0.25, 0.5]])
    for bad in ([([1.0], [1.0]), ([1.0, 2.0], [1.0])], [([float("nan")], [1.0])], []):
        with pytest.raises(Exception, match="rows|null"):
            forest.train(spark.createDataFrame(bad, ROWS), forest.Growth(trees=2, depth=2))
    with pytest.raises(ValueError, match="byte"):
        forest.train(table(spark), forest.Growth(bins=300))


def test_box_forest(spark, tmp_path):
    rng = np.random.default_rng(0)
    frames, rows = [], []
    for i in range(60):  # the box's left edge follows the bright bar's place
        at = int(rng.integers(2, 40))
        frame = np.full((48, 64, 3), 20, np.uint8)
        frame[8:40, at : at + 12] = 220
        frames.append(frame)
        rows.append((i, at / 64, 8 / 48, (at + 12) / 64, 40 / 48))
    with (tmp_path / "a.npy").open("wb") as f:
        np.save(f, np.stack(frames))
    lines = [",".join(map(str, r)) for r in rows if r[0] % 3]
    (tmp_path / "boxes.csv").write_text("frame_index,l,t,r,b\n" + "\n".join(lines) + "\n")
    train.box(spark, str(tmp_path / "a.npy"), str(tmp_path / "boxes.csv"), str(tmp_path / "box.npz"), forest.Growth(trees=20, depth=8))
    predictor = roi_model.ship(spark, str(tmp_path / "box.npz"))()
    error = [abs(predictor(frames[i])[0] - rows[i][1]) for i in range(0, 60, 3)]
    assert max(abs(predictor(frames[0])[1] - 8 / 48), abs(predictor(frames[0])[3] - 40 / 48)) < 1e-3 and sum(error) / len(error) < 0.05


# rings

SIZE = 96
YY, XX = np.mgrid[:SIZE, :SIZE]


def scene(seed: int, centre: tuple[int, int] | None, colour: tuple[int, int, int] = (60, 220, 60), decoy: bool = False) -> np.ndarray:
    """Noise with the hero: a ring around a red and blue face; a decoy is the same ring around nothing."""
    rng = np.random.default_rng(seed)
    image = rng.integers(0, 60, (SIZE, SIZE, 3), dtype=np.uint8)
    if centre:
        x, y = centre
        d = np.hypot(XX - x, YY - y)
        image[np.abs(d - 12) < 1.2] = colour
        image[d < 7] = (40, 40, 200)
        image[(d < 7) & (YY < y)] = (200, 40, 40)
    if decoy:
        far = 25 if not centre or centre[0] > 48 else 70
        image[np.abs(np.hypot(XX - far, YY - far) - 12) < 1.2] = colour
    return image


CYAN = (220, 160, 40)


def places(n: int) -> list[tuple[int, int] | None]:
    rng = random.Random(4)
    return [(rng.randrange(18, 78), rng.randrange(18, 78)) if i % 4 else None for i in range(n)]


@pytest.fixture(scope="module")
def labelled(tmp_path_factory):
    folder = tmp_path_factory.mktemp("rings")
    (folder / "frames").mkdir()
    lines = []
    for i, at in enumerate(places(40)):
        name = f"frame_{i:04d}_{40 + 3 * i}.0s.jpg"
        image = scene(i, at, CYAN if i % 5 == 0 else (60, 220, 60), decoy=i % 2 == 0)
        (folder / "frames" / name).write_bytes(jpeg.encode(image, 95, False))
        lines.append(f"{name},{40 + 3 * i}.0," + (f"found,{at[0]},{at[1]}" if at else "empty,,"))
    (folder / "labels.csv").write_text("﻿file,time_s,status,px,py\n" + "\n".join(lines) + "\n", encoding="utf-8")
    return folder


GROWTH = forest.Growth(trees=30, depth=6, feature_share=0.3)


@pytest.fixture(scope="module")
def trained(spark, labelled):
    made = train.ring(spark, str(labelled / "frames"), str(labelled / "labels.csv"), str(labelled / "ring.npz"), GROWTH)
    return str(labelled / "ring.npz"), made


def test_scorers_are_needed():
    with pytest.raises(TypeError):
        vision.RingDetector()
    ring = scene(0, (40, 50))
    assert vision.RingDetector(lambda *_: 0.0, lambda *_: 0.0)(ring) is None  # 0.3 of coverage alone is below the least score
    assert vision.RingDetector(vision.TemplateScorer([vision.patch(ring, 40, 50)] * 5), lambda *_: 0.0)(ring) == (40, 50)


def test_both_colours_have_their_own_bar():
    for colour, share, want in (((60, 220, 60), 0.66, True), (CYAN, 0.66, False), (CYAN, 0.9, True)):
        image = np.zeros((SIZE, SIZE, 3), np.uint8)
        angle = (np.arctan2(YY - 48, XX - 48) + np.pi) / (2 * np.pi)
        image[(np.abs(np.hypot(XX - 48, YY - 48) - 12) < 1.2) & (angle < share)] = colour
        found = vision.candidates(image)
        assert bool(found) == want and (not want or max(abs(found[0][0] - 48), abs(found[0][1] - 48)) <= 4)


def test_coverage_is_a_plain_count():
    m = np.random.default_rng(1).random((30, 41)) < 0.3
    ring, inside = vision.ring_coverage(m)
    yy, xx = np.mgrid[-16:17, -16:17]
    padded = np.pad(m, 16)
    for y, x in ((0, 0), (15, 20), (29, 40), (3, 37)):
        part, d = padded[y : y + 33, x : x + 33], np.hypot(yy, xx)
        shares = [part[np.abs(d - r) < 0.5].mean() for r in vision.RADII]
        best = int(np.argmax(shares))
        assert ring[y, x] == pytest.approx(shares[best]) and inside[y, x] == pytest.approx(part[d < vision.RADII[best] - 3].mean())


def test_mining_finds_decoys(trained):
    assert trained[1]["templates"] > 20 and trained[1]["mined"][0] > 0 and trained[1]["mined"][-1] < trained[1]["mined"][0]


def test_the_trained_detector(trained):
    detect = ring_model.made(models.read_file(trained[0]))
    rng = random.Random(9)
    hits = decoys = 0
    for i in range(40):
        at = (rng.randrange(18, 78), rng.randrange(18, 78))
        colour = CYAN if i % 4 == 0 else (60, 220, 60)
        found = detect(scene(1000 + i, at, colour, decoy=i % 2 == 0))
        hits += found is not None and abs(found[0] - at[0]) <= 2 and abs(found[1] - at[1]) <= 2
        assert detect(scene(2000 + i, None)) is None  # nothing on noise
        decoys += detect(scene(3000 + i, None, colour, decoy=True)) is not None
    assert hits >= 38 and decoys < 20  # a decoy's ring alone brings it close to the least score
    assert detect(np.zeros((SIZE, SIZE, 3), np.uint8)) is None


def test_command_line(spark, labelled, trained, tmp_path, monkeypatch, capsys):
    argv = ["stage2", str(labelled / "frames"), str(tmp_path / "out"), "--workers", "2"]
    monkeypatch.setattr(sys, "argv", argv)
    with pytest.raises(SystemExit):  # no detector is named
        stage2.main()
    monkeypatch.setattr(sys, "argv", [*argv, "--model", trained[0]])
    stage2.main()
    assert "remaining 0" in capsys.readouterr().out
    rows = {int(r.ord): r for r in resume.recorded(spark, str(tmp_path / "out")).collect()}
    right = sum((rows[i].px is None) if at is None else (rows[i].px is not None and abs(rows[i].px - at[0]) <= 2) for i, at in enumerate(places(40)))
    assert len(rows) == 40 and right >= 38
