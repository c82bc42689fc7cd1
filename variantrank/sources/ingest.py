"""Stored calls and sites: shuffled by variant once, at ingest, and joined afterwards without another shuffle.

Both are written as tables of the same number of buckets by variant, so a join on the variant, and the search for a person's
repeated calls of one variant, read bucket by bucket. Choose the number of buckets for the size of the calls (:func:`buckets_for`):
a bucket of each side is one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variantrank.functions.variants import VARIANT


ROWS_PER_BUCKET, LEAST_BUCKETS = 1_000_000, 8


def buckets_for(n_calls: int) -> int:
    """A number of buckets that keeps each within a task's memory, whatever the number of calls."""
    return max(LEAST_BUCKETS, -(-n_calls // ROWS_PER_BUCKET))


def store(rows: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Write ``rows`` (chr, start, ref, alt, ...) as the table ``name`` below ``path``, one file per bucket."""
    dealt = rows.repartition(buckets, *VARIANT)
    writer = dealt.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *VARIANT).sortBy(*VARIANT).saveAsTable(name)
    return rows.sparkSession.table(name)


def stored(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """A table that an earlier session stored, entered in this session's catalog if it is not there."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    by = ", ".join(VARIANT)
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{where}'"
    )
    return spark.table(name)
