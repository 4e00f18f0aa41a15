"""The engine's inputs derived from the driver's tables; all are narrow projections of pruned scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # a pattern, as a stream takes a file or a folder of files only by one
    return spark.readStream.schema(table.schema).parquet(f"{sf_dir}/{{{name}}}.parquet") if stream else table


def samples(spark: SparkSession, d: str, stream: bool = False) -> DataFrame:
    """Positions: a user is a document, event_id the line order, the time of day folded into 1,600 s."""
    seconds = F.expr("(unix_micros(cast(ts as timestamp)) div 100000) % 16000") / F.lit(10.0)
    pair = F.expr("event_id div 2")
    status = F.when(F.col("event_type") == "error", "empty").when(F.col("event_type") == "signup", "unreadable").otherwise("found")
    return read(spark, d, "events", stream).select(
        F.col("user_id").alias("document"), F.col("event_id").alias("ord"), seconds.alias("time_s"), status.alias("status"),
        F.expr("cast((event_id * 37) % 186 as int)").alias("px"), F.expr("cast((user_id * 53 + event_id * 11) % 186 as int)").alias("py"),
        F.concat(F.format_string("frame_%04d_", pair), (pair % 1600).cast("string"), F.lit(".0s.jpg")).alias("file"),
    )


def raw_positions(spark: SparkSession, d: str) -> DataFrame:
    """Positions as text, as a position file holds them."""
    found = F.col("status") == "found"
    padded = lambda c: F.concat(F.lit(" "), F.when(found, F.col(c)).otherwise(F.lit(None)).cast("string"))
    return samples(spark, d).select(
        "document", "ord", F.concat(F.col("file"), F.lit("　")).alias("file"), F.col("time_s").cast("string").alias("time_s"), "status",
        F.coalesce(padded("px"), F.lit("")).alias("px"), F.coalesce(padded("py"), F.lit(" ")).alias("py"),
    )


def symbols(spark: SparkSession, d: str) -> DataFrame:
    symbol = F.when(F.col("p_partkey") % 40 == 0, "").otherwise(F.concat(F.lit("s"), F.col("p_partkey").cast("string")))
    return read(spark, d, "part").where("p_partkey < 182").select(
        F.expr("cast(((p_partkey * 7) % 400) div 20 as int)").alias("row"), F.expr("cast(((p_partkey * 7) % 400) % 20 as int)").alias("col"),
        symbol.alias("symbol"), F.col("p_partkey").alias("ord"),
    )


def listing(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).where("(ord div 2) % 5 <> 0").select("document", "file").distinct()


def done(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).where("(ord div 2) % 3 = 0")


def file_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of a folder: frames and others."""
    name = F.when(F.col("ord") % 7 == 0, F.concat(F.lit("thumb_"), F.col("file"))).otherwise(F.col("file"))
    return samples(spark, d).select("document", name.alias("file")).distinct()


def frames(spark: SparkSession, d: str) -> DataFrame:
    """Decoded frames of 20 recordings with predicted boxes; a rate of 0 stands for an unknown one."""
    rate = F.expr("case document % 3 when 0 then 0D when 1 then 2.5D else 1D end")
    named = read(spark, d, "events").select(F.expr("user_id % 20").alias("document"), F.col("event_id").alias("frame_index"))
    part = lambda e: F.expr(e) / F.lit(1000.0)
    left, top = part("(frame_index * 13) % 100"), part("(frame_index * 17) % 100")
    return named.select(
        "document", "frame_index", rate.alias("fps"), (100000 / F.coalesce(F.nullif(rate, F.lit(0.0)), F.lit(30.0))).alias("duration_s"),
        F.lit(1280).alias("width"), F.lit(582).alias("height"), left.alias("l"), top.alias("t"),
        (left + part("140 + (frame_index * 7) % 11")).alias("r"), (top + part("320 + (frame_index * 5) % 13")).alias("b"),
    )


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("frame"), F.col("l_linenumber").alias("candidate"), (F.col("l_discount") * 10).alias("ncc"),
        (F.col("l_tax") * 10).alias("probability"), (F.col("l_quantity") / 50).alias("coverage"),
    )
