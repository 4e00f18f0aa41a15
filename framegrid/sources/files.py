"""Readers of the stages' files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framegrid.schemas import SYMBOL_MAP_HEADER


def _text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header as text, a byte-order mark allowed; ``ord`` keeps the order of lines.

    Such files are small, one document's worth, and are read as one split each, files in order of their names.
    """
    whole = spark.read.option("header", True).option("multiLine", True).csv(path)
    numbered = whole.select("*", F.input_file_name().alias("_from")).withColumn("_line", F.monotonically_increasing_id())
    order = Window.orderBy("_from", "_line")
    return numbered.withColumn("ord", F.row_number().over(order).cast("long") - 1).drop("_from", "_line")


def positions(spark: SparkSession, path: str, document: str) -> DataFrame:
    """A position file as text columns, for ``locate.typed_positions``; empty fields are empty text."""
    raw = _text(spark, path)
    return raw.select(F.lit(document).alias("document"), "ord", *(F.coalesce(c, F.lit("")).alias(c) for c in ("file", "time_s", "status", "px", "py")))


def symbols(spark: SparkSession, path: str) -> DataFrame:
    """A symbol map with rows, columns and symbols under their Chinese headers."""
    raw = _text(spark, path).withColumnsRenamed(SYMBOL_MAP_HEADER)
    return raw.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.coalesce("symbol", F.lit("")).alias("symbol"), "ord")


def images(spark: SparkSession, folder: str, document: str, names: list[str] | None = None) -> DataFrame:
    """Decoded frames of a folder, or those named; what cannot be decoded has width -1."""
    at = folder if names is None else [f"{folder}/{n}" for n in names]
    read = spark.read.format("image").option("dropInvalid", False).option("pathGlobFilter", "frame_*.jpg").load(at)
    return read.select(F.lit(document).alias("document"), F.element_at(F.split("image.origin", "/"), -1).alias("file"), "image")


def frame_listing(spark: SparkSession, folder: str, document: str) -> DataFrame:
    """Names of the frames in a folder; their bytes are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "frame_*.jpg").load(folder)
    return found.select(F.lit(document).alias("document"), F.element_at(F.split("path", "/"), -1).alias("file"))


def one_video(spark: SparkSession, document_folder: str) -> str:
    """Path of the document's only recording."""
    from pyspark.errors import AnalysisException

    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.mp4").load(f"{document_folder}/video_footage")
        paths = [r.path for r in found.select("path").orderBy("path").limit(2).collect()]
    except AnalysisException:
        paths = []
    if not paths:
        raise FileNotFoundError(f"no recording in {document_folder}/video_footage")
    if len(paths) > 1:
        raise RuntimeError(f"several recordings in {document_folder}/video_footage")
    return paths[0]
