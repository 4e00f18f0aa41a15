"""What the operators share: stored intermediate tables, row keys, Arrow helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words; bytes.split() without arguments splits on exactly these six.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
#: Rows in an Arrow batch: documents can be long, so batches are kept well below Spark's default of 10,000.
BATCH_ROWS = 512

_stored: dict[str, SparkSession] = {}


def tune(spark: SparkSession) -> None:
    """Lower the Arrow batch size unless the caller already chose a smaller one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only in local mode where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if "local" not in _own:
        _own["local"] = tempfile.mkdtemp(prefix="framegrid-")
    return _own["local"]


_own: dict[str, str] = {}


def saved(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/framegrid/{name}-{uuid.uuid4().hex}"
    _stored[path] = spark
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored() -> set[str]:
    """Paths of the tables that are stored now."""
    return set(_stored)


def release(paths: set[str] | None = None) -> None:
    """Delete stored tables, all if none are named; call it once the results that read them have been written."""
    for path in stored() if paths is None else paths & stored():
        spark = _stored.pop(path)
        if (jvm := spark.sparkContext._jvm) is not None:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _at_exit() -> None:
    try:
        release()
    except Exception:  # the JVM may be gone already; then nothing can be deleted  # noqa: BLE001
        _stored.clear()


def digest(text: Column) -> Column:
    """128 bits that stand for a text; null for null."""
    return F.unhex(F.md5(text))


def row_key(doc_id: Column, text: Column) -> Column:
    """Equal for rows with equal doc_id and text, nulls included; 128 bits."""
    part = F.coalesce(doc_id.cast("string"), F.lit("\x02"))
    return F.unhex(F.md5(F.concat(part, F.lit("\x01"), F.coalesce(F.md5(text), F.lit("\x02")))))


def whole_row(df: DataFrame, doc_id: str, text: str) -> Column:
    """Equal for rows that are equal in all columns; 128 bits."""
    others = F.to_json(F.struct(F.lit(0), *(F.col(f"`{c}`") for c in df.columns if c not in (doc_id, text))))
    return F.unhex(F.md5(F.concat(F.hex(row_key(F.col(doc_id), F.col(text))), others)))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` begins with it, whatever its case."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name) for c in taken):
        name = "_" + name
    return name


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.large_binary()).to_pylist()


#: Copies of a row that one task makes out of a count.
EXPANDED = 1 << 16


def expanded(df: DataFrame, count: str, into: str, by: list[str] | None = None) -> DataFrame:
    """Each row as often as ``count`` says, with its number from 0 as ``into``; ``df`` is read twice, so it is a stored table.

    High counts are dealt out in parts, by the columns ``by`` and the part, so that no task makes all copies of a row.
    """
    part, first, step = unused(df, "part"), F.lit(0).cast("long"), F.lit(EXPANDED).cast("long")
    few = df.where(F.col(count) <= EXPANDED).withColumn(into, F.explode(F.sequence(first, F.col(count) - 1)))
    many = df.where(F.col(count) > EXPANDED).withColumn(part, F.explode(F.sequence(first, F.col(count) - 1, step)))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated, as adaptive execution would join such small rows into one task
    dealt = many.repartition(tasks, *(by or df.columns), part)
    last = F.least(F.col(part) + EXPANDED, F.col(count)) - 1
    return few.unionByName(dealt.withColumn(into, F.explode(F.sequence(F.col(part), last))).drop(part))


def crc(column: Column) -> Column:
    """crc32 of an id as text."""
    return F.crc32(column.cast("string"))


def batches(it: Iterator[pa.RecordBatch], max_bytes: int, column: str) -> Iterator[list[pa.RecordBatch]]:
    """Collect batches until their ``column`` holds about ``max_bytes``; a larger batch stands alone."""
    held, size = [], 0
    for batch in it:
        held.append(batch)
        size += batch.column(batch.schema.get_field_index(column)).nbytes
        if size >= max_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held
