"""Genome-wide source tables: laid out by position, and read only where there are sites.

A frequency, label or score table lists billions of positions, a cohort some millions of sites. Three steps keep the rest
of such a table out of every shuffle, each by itself exact:

* the layout: one folder per contig and bin of BIN_WIDTH positions, of which only those with a site are read;
* the keys: rows of other keys are dropped where they are read, by a semi-join with the broadcast site keys;
* sites too many to broadcast: a bitmap of their key hashes, which lets through few rows that meet no site.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from variantrank.operators.joins import MAX_BROADCAST_BYTES, data_bytes

#: Positions of one folder. A genome of three billion positions has some 3,100 bins, so MOST_BINS is never reached by one.
BIN_WIDTH = 1_000_000
MOST_BINS = 20_000
#: Bits for every site key, and of the whole bitmap at most (64 MB).
BITS_PER_KEY, MOST_BITS = 16, 1 << 29
BITS_PER_BUCKET = 8 * 4096
LAYOUT = ["contig", "pos_bin"]


def position_bin(start: str = "start") -> Column:
    return F.floor(F.col(start) / BIN_WIDTH).cast("long")


def write_source(source: DataFrame, path: str) -> None:
    """One-time layout of a source (chr, start, ...): folders by contig and bin, sorted by position in them."""
    placed = source.withColumns({"contig": F.coalesce("chr", F.lit("")), "pos_bin": F.coalesce(position_bin(), F.lit(-1))})
    placed = placed.repartition(*LAYOUT).sortWithinPartitions(*LAYOUT, "start")
    placed.write.mode("overwrite").partitionBy(*LAYOUT).parquet(path)


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """A laid-out source; contigs that look like numbers stay text."""
    found = spark.read.parquet(path).schema
    fields = [StructField("contig", StringType()) if f.name == "contig" else f for f in found.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


class SiteKeys:
    """The keys of the sites of a run, as sources are to be cut down to them."""

    def __init__(self, sites: DataFrame, on: list[str], max_bytes: int = MAX_BROADCAST_BYTES):
        self.sites, self.on = sites, on
        keys = sites.select(*on).dropna()
        self.keys = keys.distinct()
        self.bitmap = None if data_bytes(keys) <= max_bytes else self._bitmap()

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.on), F.lit(self.bits)) + 1

    def _bitmap(self) -> DataFrame:
        """(bucket, marks): one bit for each hash of a key."""
        wanted = BITS_PER_KEY * self.keys.count()
        self.bits = min(MOST_BITS, max(BITS_PER_BUCKET, 1 << wanted.bit_length()))
        slots = self.keys.select(self._slot().alias("slot"))
        return slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("marks")
        )

    def _read_bins(self, source: DataFrame) -> DataFrame:
        """The source without folders that hold no site, which are then not listed for reading."""
        bins = self.sites.select(F.col("chr").alias("contig"), position_bin().alias("pos_bin")).dropna().distinct()
        rows = bins.limit(MOST_BINS + 1).collect()
        if len(rows) > MOST_BINS:
            return source
        by_contig: dict[str, list[int]] = {}
        for row in rows:
            by_contig.setdefault(row["contig"], []).append(row["pos_bin"])
        here = [(F.col("contig") == c) & F.col("pos_bin").isin(sorted(b)) for c, b in sorted(by_contig.items())]
        return source.filter(reduce(lambda x, y: x | y, here, F.lit(False)))

    def meeting(self, source: DataFrame) -> DataFrame:
        """The rows of the source that meet a site and, with very many sites, a few that do not; never fewer."""
        if set(LAYOUT) <= set(source.columns):
            source = self._read_bins(source).drop(*LAYOUT)
        if self.bitmap is None:
            return source.join(F.broadcast(self.keys), self.on, "left_semi")
        place = F.bitmap_bit_position(self._slot())
        byte = F.conv(F.hex(F.substr("marks", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        marked = source.withColumn("bucket", F.bitmap_bucket_number(self._slot())).join(F.broadcast(self.bitmap), "bucket")
        return marked.filter(F.bit_get(byte, (place % 8).cast("int")) == 1).select(*source.columns)
