"""Writers of the stages' artifacts. Tables go out as Parquet; CSV and sheets are small, one document's worth."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

BOM = "﻿"


def overwrite(df: DataFrame, path: str) -> None:
    """Clear and rebuild; with a ``document`` column only the documents at hand are replaced."""
    writer = df.write.mode("overwrite")
    if "document" in df.columns:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("document")
    writer.parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def csv(df: DataFrame, path: str, header: list[str] | None = None) -> None:
    """A folder with one CSV in the frame's order, its header after a byte-order mark; nulls are empty."""
    names = header or df.columns
    named = df.toDF(BOM + names[0], *names[1:])
    named.coalesce(1).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of the session's shared one; in local mode, where the session names none, one of the machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{named or tempfile.mkdtemp(prefix='framegrid-')}/framegrid-core/{name}-{uuid.uuid4().hex}"


def filesystem(path: str):
    """The file system of a path or address, and the path in it; for tasks, so it must be one that all executors share."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_file(path: str, content: bytes) -> None:
    """Written under another name first, so that a task that is run twice leaves no half a file."""
    at, inside = filesystem(path)
    folder, _, name = inside.rpartition("/")
    at.create_dir(folder, recursive=True)
    half = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with at.open_output_stream(half) as f:
        f.write(content)
    at.move(half, inside)


def rebuild(folder: str, build: Callable[[str], int]) -> int:
    """Build a folder anew beside the old one and put it in its place; where ``build`` fails, the old one stays whole.

    The old folder is moved aside for the moment of the exchange; should a run end just there, the next one moves it back first.
    """
    at, inside = filesystem(folder)
    parent, _, name = inside.rpartition("/")
    aside = f"{parent}/_{name}.before"
    is_there = lambda path: at.get_file_info(path).type.name == "Directory"
    if is_there(aside):
        if is_there(inside):
            at.delete_dir(aside)
        else:
            at.move(aside, inside)
    made = f"_{name}.{uuid.uuid4().hex}"
    try:
        result = build(f"{folder.removesuffix(name)}{made}")
        if is_there(inside):
            at.move(inside, aside)
        at.move(f"{parent}/{made}", inside)
    except BaseException:
        if is_there(f"{parent}/{made}"):
            at.delete_dir(f"{parent}/{made}")
        raise
    if is_there(aside):
        at.delete_dir(aside)
    return result


def copy_files(names: DataFrame, source: str, target: str) -> int:
    """Copy the named files that exist from one folder to another; tasks copy, the driver only counts."""

    def copy(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            done = []
            for file in part["file"]:
                at, inside = filesystem(f"{source}/{file}")
                if at.get_file_info(inside).is_file:
                    with at.open_input_stream(inside) as f:
                        write_file(f"{target}/{file}", f.read())
                    done.append(file)
            yield pd.DataFrame({"file": done}, dtype="object")

    return names.select("file").distinct().mapInPandas(copy, "file string").count()


def save_images(images: DataFrame, target: str, encode: Callable[[np.ndarray], bytes]) -> int:
    """Write (file, height, width, data) rows as files by an encoder plug-in."""

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples():
                pixels = np.frombuffer(row.data, np.uint8).reshape(row.height, row.width, 3)
                write_file(f"{target}/{row.file}", encode(pixels))
            yield pd.DataFrame({"file": part["file"]})

    return images.select("file", "height", "width", "data").mapInPandas(write, "file string").count()
