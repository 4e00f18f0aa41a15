"""Crops of decoded frames; pixels move in small Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.accumulators import Accumulator
from pyspark.sql import DataFrame

from framegrid.functions.vision import crop_resize, roi_features

#: frame to the four fractions of its box
Predictor = Callable[[np.ndarray], tuple[float, float, float, float]]


def _pixels(row) -> np.ndarray:
    return np.frombuffer(row.data, np.uint8).reshape(row.height, row.width, 3)


def _predict(parts: Iterator[pd.DataFrame], make: Callable[[], Predictor]) -> Iterator[pd.DataFrame]:
    predictor = make()
    for part in parts:
        boxes = [predictor(_pixels(r)) for r in part.itertuples()]
        yield part.assign(**{c: [float(b[i]) for b in boxes] for i, c in enumerate("ltrb")})


def _features(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        yield part.assign(features=[roi_features(_pixels(r)).tolist() for r in part.itertuples()])


def _crop(parts: Iterator[pd.DataFrame], size: int, counter: Accumulator | None) -> Iterator[pd.DataFrame]:
    for part in parts:
        if counter is not None:
            counter.add(len(part))
        data = [crop_resize(_pixels(r), (r.box["l"], r.box["t"], r.box["r"], r.box["b"]), size).tobytes() for r in part.itertuples()]
        yield part[["document", "frame_index", "fps", "w", "h"]].assign(height=size, width=size, data=data)


def predict_boxes(frames: DataFrame, make: Callable[[], Predictor]) -> DataFrame:
    """Add the predicted fractions l, t, r, b; ``make`` is called once in each task."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frames.schema)
    return frames.mapInPandas(partial(_predict, make=make), f"{fields}, l double, t double, r double, b double")


def with_features(frames: DataFrame) -> DataFrame:
    """Add the features that a box forest reads."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frames.schema)
    return frames.mapInPandas(_features, f"{fields}, features array<double>")


def crop(boxed: DataFrame, size: int = 186, counter: Accumulator | None = None) -> DataFrame:
    """Rows of (document, frame_index, fps, box, w, h, width, height, data) to squares; whole frames go no further. ``counter`` is for progress."""
    narrow = boxed.select("document", "frame_index", "fps", "box", "w", "h", "width", "height", "data")
    return narrow.mapInPandas(partial(_crop, size=size, counter=counter), "document string, frame_index bigint, fps double, w int, h int, height int, width int, data binary")
