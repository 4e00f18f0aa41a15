"""Model artifacts: sent once to every node, made once in every worker."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable
from functools import partial

from pyspark import Broadcast
from pyspark.sql import SparkSession

from framegrid.sources.sinks import filesystem

#: A model is held by every node and worker, so its size has a bound.
MOST_BYTES = 1 << 28
#: Models that a worker holds.
MOST_HELD = 8

_held: dict[str, object] = {}


def read_file(path: str, most: int = MOST_BYTES) -> bytes:
    """A file of at most ``most`` bytes, on the file system that the path names."""
    at, inside = filesystem(path)
    with at.open_input_stream(inside) as f:
        content = f.read(most + 1)
    if len(content) > most:
        raise ValueError(f"{path} is over {most} bytes")
    return content


def ship(spark: SparkSession, path: str, make: Callable[[bytes], object] = pickle.loads) -> Callable[[], object]:
    """Send a file's content to all nodes; the result gives, inside a task, what ``make`` makes of it. Pickled files are the caller's own."""
    return partial(_load, uuid.uuid4().hex, spark.sparkContext.broadcast(read_file(path)), make)


def _load(name: str, shared: Broadcast, make: Callable[[bytes], object]) -> object:
    if name not in _held:
        if len(_held) >= MOST_HELD:
            _held.clear()
        _held[name] = make(shared.value)
    return _held[name]
