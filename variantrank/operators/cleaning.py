"""Cleaning steps on annotated, classified rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantrank.functions import filters
from variantrank.operators.calls import call_drops
from variantrank.operators.genes import flag_genes, keep_listed_genes
from variantrank.operators.sites import site_drops
from variantrank.profiles import Profile


def drop_blacklist(df: DataFrame) -> DataFrame:
    return df.filter(~filters.blacklisted(F.col("gene")))


def drop_af_discrepancy(df: DataFrame) -> DataFrame:
    return df.filter(~filters.af_discrepant(F.col("af"), F.col("kg"), F.col("esp")))


def keep_lookup_genes(df: DataFrame, lookup_genes: DataFrame, **join_options) -> DataFrame:
    return keep_listed_genes(df, lookup_genes, **join_options)


def drop_missing_geno(df: DataFrame) -> DataFrame:
    return df.filter(~filters.genotype_missing(F.col("geno"), F.col("status")))


def keep_coding_splice(df: DataFrame) -> DataFrame:
    return df.filter(filters.coding_or_splice(F.col("func"), F.col("exonic_func")))


def keep_scored(df: DataFrame) -> DataFrame:
    return df.filter(F.col("phred").isNotNull())


def keep_pass(df: DataFrame) -> DataFrame:
    return df.filter(filters.passes(F.col("filter")))


def joined_reasons(*parts) -> Column:
    """Comma-joined texts without the empty ones."""
    return F.concat_ws(",", *[F.when(part != "", part) for part in parts])


def drop_reasons(raw: DataFrame, lookup_genes: DataFrame, profile: Profile) -> DataFrame:
    """``drop_reason``: every rule a row fails, comma-joined; empty for a clean row."""
    flagged = flag_genes(raw, {"in_lookup": lookup_genes})
    return flagged.withColumn(
        "drop_reason", joined_reasons(site_drops(profile), call_drops(profile))
    ).drop("in_lookup")


def clean_variants(raw: DataFrame, lookup_genes: DataFrame, profile: Profile) -> DataFrame:
    """Rows that fail no rule."""
    return drop_reasons(raw, lookup_genes, profile).filter("drop_reason = ''").drop("drop_reason")
