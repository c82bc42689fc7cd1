"""Text lines with their place in the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path) -> DataFrame:
    """(value, file, ord). ``ord`` sorts lines as they stand in their files.

    Within a block the running id rises line by line and blocks sort by their
    offset, so the order does not depend on how Spark packs the blocks.
    """
    return spark.read.text(path).select(
        "value",
        F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("ord"),
    )


def not_na(col: Column) -> Column:
    """NULL for the missing-value mark ``NA``."""
    return F.when(col != "NA", col)


def fields(names: list[str], parts: str = "parts") -> list[Column]:
    """One nullable text column per name, by position."""
    return [not_na(F.get(parts, F.lit(i))).alias(n) for i, n in enumerate(names)]


def split_tabs(lines: DataFrame) -> DataFrame:
    return lines.withColumn("parts", F.split("value", "\t"))
