"""VCF text: sites, sample names and carrier genotypes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantrank.functions.variants import (
    has_alternate,
    holds_allele,
    info_keep,
    is_anchored,
    trimmed_allele,
    trimmed_start,
)
from variantrank.operators.joins import lookup_join
from variantrank.sources.heads import header_lines
from variantrank.sources.lines import read_lines

# The leading VCF columns.
SITE_FIELDS = ["chrom", "pos", "vcf_id", "ref", "alt", "qual", "filter", "info"]
FIRST_SAMPLE = 9


class Vcf(NamedTuple):
    sites: DataFrame
    samples: DataFrame
    calls: DataFrame


def _site_columns(parts: str):
    columns = [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(SITE_FIELDS)]
    columns[1] = F.get(parts, F.lit(1)).cast("long").alias("pos")
    return columns


def vcf_sites(lines: DataFrame) -> DataFrame:
    """The eight site columns; the sample part of a line is never split."""
    body = lines.filter(~F.col("value").startswith("#"))
    head = body.withColumn("_head", F.split("value", "\t", FIRST_SAMPLE))
    return head.select(*_site_columns("_head"), "ord")


def vcf_samples(lines: DataFrame) -> DataFrame:
    """(iid, sample_pos) from the column-name line."""
    header = lines.filter(F.col("value").startswith("#CHROM"))
    return header.select(
        F.posexplode(F.split("value", "\t")).alias("field", "iid"), "file"
    ).filter(F.col("field") >= FIRST_SAMPLE).select(
        "iid", (F.col("field") - FIRST_SAMPLE).alias("sample_pos"), "file"
    )


def _sample_fields(parts: str | Column) -> Column:
    count = F.greatest(F.size(parts) - FIRST_SAMPLE, F.lit(0))
    return F.slice(parts, F.lit(FIRST_SAMPLE + 1), count)


def sample_names(header: DataFrame) -> DataFrame:
    """(file, _names): the sample names of each file from its column-name line (value, file)."""
    return header.filter(F.col("value").startswith("#CHROM")).select("file", _sample_fields(F.split("value", "\t")).alias("_names"))


def unpivot_genotypes(lines: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """One row per site and carrier: the sample columns turned into rows.

    Non-carriers are removed inside the array, before it is exploded. ``names`` are the samples of every file
    (:func:`sample_names`); without them ``lines`` are searched for the column-name lines first.
    """
    if names is None:
        names = sample_names(lines)
    body = lines.filter(~F.col("value").startswith("#")).withColumn("_all", F.split("value", "\t")).drop("value")
    named = lookup_join(body, names, ["file"], "inner")
    genotypes = F.arrays_zip(F.col("_names").alias("iid"), _sample_fields("_all").alias("gt"))
    carriers = F.filter(genotypes, lambda g: has_alternate(g["gt"]))
    return named.select(*_site_columns("_all"), "ord", F.explode(carriers).alias("_g")).select(
        "_g.iid", *SITE_FIELDS, "_g.gt", "ord"
    )


def vcf_to_variant(df: DataFrame, first_alt_only: bool = False) -> DataFrame:
    """VCF positions and alleles to trimmed 1-based variants, one row per ALT allele.

    Of rows with a genotype only the ALT alleles that it names stay. ``first_alt_only`` takes the first ALT of a line
    alone, and genotypes as they stand.
    """
    rest = [c for c in df.columns if c not in ("chrom", "pos", "ref", "alt", "ord")]
    split = df.withColumns(
        {"_ord": F.col("ord")} if "ord" in df.columns else {"_ord": F.lit(0)}
    ).select("*", F.posexplode(F.split("alt", ",")).alias("_allele", "_alt"))
    if first_alt_only:
        split = split.filter("_allele = 0")
    elif "gt" in df.columns:
        split = split.filter(holds_allele(F.col("gt"), F.col("_allele") + 1))
    ref, alt, pos = F.col("ref"), F.col("_alt"), F.col("pos")
    anchored = is_anchored(ref, alt)
    new_ref = F.when(anchored, trimmed_allele(ref)).otherwise(ref)
    new_start = F.when(anchored, trimmed_start(pos, ref)).otherwise(pos)
    return split.select(
        F.col("chrom").alias("chr"),
        new_start.alias("start"),
        (new_start + F.length(new_ref) - 1).alias("end"),
        new_ref.alias("ref"),
        F.when(anchored, trimmed_allele(alt)).otherwise(alt).alias("alt"),
        *rest,
        F.struct(F.col("_ord").alias("line"), F.col("_allele").alias("allele")).alias("ord"),
    )


def info_keep_ac(df: DataFrame) -> DataFrame:
    """INFO cut to its allele count."""
    return df.withColumn("info", info_keep(F.col("info"), "AC"))


def parse_vcf(lines: DataFrame, first_alt_only: bool = False, header: DataFrame | None = None) -> Vcf:
    """``header`` holds the column-name line (value, file) of every file; without it ``lines`` are searched for them."""
    header = lines if header is None else header
    return Vcf(
        vcf_to_variant(vcf_sites(lines), first_alt_only),
        vcf_samples(header),
        vcf_to_variant(info_keep_ac(unpivot_genotypes(lines, sample_names(header))), first_alt_only),
    )


def read_vcf(spark: SparkSession, path, first_alt_only: bool = False) -> Vcf:
    """Variant sites, samples and carrier calls of plain or gzipped VCF text.

    The sample names come from the heads of the files, so that the calls read every file once. A gzipped file is one
    task; split large inputs by contig or unpack them.
    """
    found = header_lines(spark, path, lambda line: line.startswith("#CHROM"))
    header = spark.createDataFrame([(line, file) for file, line in found.items()], "value string, file string")
    return parse_vcf(read_lines(spark, path), first_alt_only, header)
