"""The ring detector's two scorers, learned from labelled frames: templates, and a forest that tells rings of the hero from others.

Rows are patches: those at labelled centres are positive, one place of each frame away from its centre and the candidates that
``mining`` finds are negative. Mining runs the detector that was fitted so far over the labelled frames and adds every place that
it accepts wrongly (further than ``TOLERANCE`` from the centre, or in a frame without one) to the rows; then the forest is fitted again,
until nothing new is accepted or the rounds end. Frames are read in tasks; the driver gets templates, splits and counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegrid.functions import images, vision
from framegrid.operators import forest
from framegrid.sources import models
from framegrid.sources.sinks import filesystem, write_file

#: Pixels within which a place counts as the labelled centre.
TOLERANCE = 4
#: Templates that are kept: of more labelled centres those of least hash.
MOST_TEMPLATES = 64
GROWTH = forest.Growth(trees=100, depth=10, feature_share=0.3)
ROWS = "features array<double>, target array<double>"


class Probability:
    """The forest's share for the place of a candidate."""

    def __init__(self, model: forest.Forest) -> None:
        self.model = model

    def __call__(self, image: np.ndarray, x: int, y: int) -> float:
        return float(self.model.predict(vision.patch_features(image, x, y)[None])[0, 0])


def detector(templates: np.ndarray, model: forest.Forest, accept: float = vision.ACCEPT) -> vision.RingDetector:
    return vision.RingDetector(vision.TemplateScorer(list(templates)), Probability(model), accept)


def _frames(part: pd.DataFrame, folder: str) -> Iterator[tuple[str, np.ndarray, tuple[int, int] | None]]:
    for row in part.itertuples():
        at, inside = filesystem(f"{folder}/{row.file}")
        with at.open_input_stream(inside) as f:
            image = images.read(f.read())
        if image is not None:
            yield row.file, image, None if pd.isna(row.px) else (int(row.px), int(row.py))


def _far(x: int, y: int, centre: tuple[int, int] | None) -> bool:
    return centre is None or (x - centre[0]) ** 2 + (y - centre[1]) ** 2 > TOLERANCE**2


def _labelled(parts: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = []
        for file, image, centre in _frames(part, folder):
            if centre:
                rows.append((vision.patch_features(image, *centre).tolist(), [1.0], vision.patch(image, *centre).tobytes()))
            draw = np.random.default_rng(np.frombuffer(file.encode(), np.uint8))
            for _ in range(8):  # a place away from the centre
                x, y = int(draw.integers(image.shape[1])), int(draw.integers(image.shape[0]))
                if _far(x, y, centre):
                    rows.append((vision.patch_features(image, x, y).tolist(), [0.0], None))
                    break
        yield pd.DataFrame(rows, columns=["features", "target", "patch"])


def _accepted(parts: Iterator[pd.DataFrame], folder: str, templates: np.ndarray, model: forest.Forest, accept: float) -> Iterator[pd.DataFrame]:
    detect = detector(templates, model, accept)
    for part in parts:
        rows = []
        for _, image, centre in _frames(part, folder):
            wrong = [(x, y) for score, x, y in detect.scored(image) if score >= accept and _far(x, y, centre)]
            rows += [(vision.patch_features(image, x, y).tolist(), [0.0]) for x, y in wrong]
        yield pd.DataFrame(rows, columns=["features", "target"])


def train(labels: DataFrame, folder: str, growth: forest.Growth = GROWTH, rounds: int = 3, accept: float = vision.ACCEPT) -> tuple[np.ndarray, forest.Forest, list[int]]:
    """From rows of (file, px, py), nulls where a frame has no hero: templates, the forest, and what each round of mining added."""
    named = labels.select("file", F.col("px").cast("double").alias("px"), F.col("py").cast("double").alias("py")).repartition("file")
    first = named.mapInPandas(partial(_labelled, folder=folder), f"{ROWS}, patch binary").persist()
    kept = first.where("patch is not null").select("patch").orderBy(F.xxhash64("patch"), "patch").limit(MOST_TEMPLATES).collect()
    if not kept:
        raise ValueError("no frame has a labelled centre")
    side = 2 * vision.PATCH + 1
    templates = np.stack([np.frombuffer(r.patch, np.uint8).reshape(side, side, 3) for r in kept])
    rows, held, mined = first.select("features", "target"), [first], []
    model = forest.train(rows, growth)
    for _ in range(rounds):
        wrong = named.mapInPandas(partial(_accepted, folder=folder, templates=templates, model=model, accept=accept), ROWS).distinct().persist()
        held.append(wrong)
        # what is already a row and is still accepted teaches nothing new
        new = wrong.join(rows.select("features"), "features", "left_anti").persist()
        held.append(new)
        mined.append(new.count())
        if not mined[-1]:
            break
        rows = rows.unionByName(new)
        model = forest.train(rows, growth)
    for df in held:
        df.unpersist()
    return templates, model, mined


def save(templates: np.ndarray, model: forest.Forest, path: str, accept: float = vision.ACCEPT) -> None:
    write_file(path, forest.packed(model.arrays() | {"templates": templates, "accept": np.array(accept)}))


def made(content: bytes) -> vision.RingDetector:
    held = forest.unpacked(content)
    templates, accept = held.pop("templates"), float(held.pop("accept"))
    return detector(templates, forest.Forest(**held), accept)


def ship(spark: SparkSession, path: str) -> Callable[[], vision.RingDetector]:
    """A stored detector as a factory: sent to each node once, made once in each worker."""
    return models.ship(spark, path, made)
