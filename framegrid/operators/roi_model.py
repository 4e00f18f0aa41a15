"""Boxes from features: one forest whose leaves hold all four fractions, trained by Spark, stored as a file, shipped to tasks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegrid.functions.vision import roi_features
from framegrid.operators import forest
from framegrid.sources import models

SIDES = ("l", "t", "r", "b")


def train(labelled: DataFrame, growth: forest.Growth = forest.Growth()) -> forest.Forest:
    """Fit on rows of (features array<double>, l, t, r, b)."""
    return forest.train(labelled.select("features", F.array(*SIDES).alias("target")), growth)


class BoxPredictor:
    """A frame to the four fractions of its box."""

    def __init__(self, model: forest.Forest) -> None:
        self.model = model

    def __call__(self, frame: np.ndarray) -> tuple[float, float, float, float]:
        return tuple(self.model.predict(roi_features(frame)[None])[0].tolist())


def made(content: bytes) -> BoxPredictor:
    return BoxPredictor(forest.Forest(**forest.unpacked(content)))


def ship(spark: SparkSession, path: str) -> Callable[[], BoxPredictor]:
    """A stored forest as a factory of predictors: sent to each node once, made once in each worker."""
    return models.ship(spark, path, made)
