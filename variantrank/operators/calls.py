"""Genotype calls: pedigree, annotations, classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantrank.functions import filters
from variantrank.functions.genotypes import genotype_class, item_of, sex_adjusted
from variantrank.functions.variants import BY_POSITION, VARIANT
from variantrank.operators.joins import lookup_join
from variantrank.profiles import Profile


def usable_people(pedigree: DataFrame) -> DataFrame:
    """One row per person who is listed once and whose sex is 1 or 2."""
    attributes = ["fam_id", "sex", "status", "eth"]
    return (
        pedigree.groupBy("iid")
        .agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in attributes])
        .filter((F.col("_n") == 1) & F.col("sex").isin(1, 2))
        .drop("_n")
    )


def rejected_people(
    pedigree: DataFrame, calls: DataFrame | None = None, samples: DataFrame | None = None
) -> DataFrame:
    """(iid, reason) of the people left out: ``duplicate``, ``sex``, ``not_in_vcf`` or ``missing``.

    ``samples`` (iid) are the sample columns of the VCF; a person of the pedigree who could take part but has none is
    ``not_in_vcf``. People with calls and no pedigree line are ``missing``.
    """
    listed = pedigree.groupBy("iid").agg(F.count("*").alias("n"), F.first("sex").alias("sex"))
    known_sex = F.coalesce(F.col("sex").isin(1, 2), F.lit(False))
    rejects = listed.select(
        "iid", F.when(F.col("n") > 1, "duplicate").when(~known_sex, "sex").alias("reason")
    ).filter("reason is not null")
    if samples is not None:
        absent = listed.join(rejects, "iid", "left_anti").join(samples.select("iid").distinct(), "iid", "left_anti")
        rejects = rejects.unionByName(absent.select("iid", F.lit("not_in_vcf").alias("reason")))
    if calls is None:
        return rejects
    called = calls.select("iid").distinct()
    missing = called.join(pedigree.select("iid").distinct(), "iid", "left_anti")
    return rejects.unionByName(missing.withColumn("reason", F.lit("missing")))


def join_pedigree(calls: DataFrame, people: DataFrame, **join_options) -> DataFrame:
    """Calls of the given people, with their family, sex, status and ancestry."""
    return lookup_join(calls, people, ["iid"], "inner", **join_options)


def first_call(calls: DataFrame, same_row: tuple = ()) -> DataFrame:
    """First call, in source order, of each person and variant (and ``same_row`` columns).

    Each task cuts its own groups to one row before the shuffle, unless the calls already lie by person.
    """
    order = Window.partitionBy("iid", *BY_POSITION, *same_row).orderBy("ord")
    return calls.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "ord")


def attach_annotations(
    calls: DataFrame, sites: DataFrame, unique_calls: bool = False, **join_options
) -> DataFrame:
    """First calls joined to their site rows: one row per (person, variant, gene).

    With one site row per (variant, gene), the first joined row of a (person,
    variant, gene) is the one of the first call, so the calls are cut before the
    join. ``unique_calls`` says no person has two calls of one variant.
    """
    first = calls.drop("ord") if unique_calls else first_call(calls)
    rows = lookup_join(first, sites, BY_POSITION, "inner", **join_options)
    return rows.select(*VARIANT, *[c for c in rows.columns if c not in VARIANT])


def annotations_of_carriers(sites: DataFrame, calls: DataFrame) -> DataFrame:
    """Sites at which anybody has a call."""
    return sites.join(calls.select(*VARIANT).distinct(), VARIANT, "left_semi")


def read_depths(df: DataFrame) -> DataFrame:
    """``alt_read`` (second item of the second GT field) and ``total_read`` (third field).

    The splits are columns of their own so that each runs once per row.
    """
    return (
        df.withColumn("_fields", F.split("gt", ":"))
        .withColumn("_depths", F.split(item_of(F.col("_fields"), 1), ","))
        .withColumn("alt_read", item_of(F.col("_depths"), 1))
        .withColumn("total_read", item_of(F.col("_fields"), 2))
        .drop("_fields", "_depths")
    )


def sex_adjust(df: DataFrame) -> DataFrame:
    """Apply the X/Y-gene rules to ``geno``; needs ``sex`` and ``is_xy``."""
    return df.withColumn(
        "geno", sex_adjusted(F.col("geno"), F.col("sex"), F.col("is_xy"), F.col("chr"))
    )


def call_drops(profile: Profile) -> Column:
    """Comma-joined reasons, known from the call, to leave a row out."""
    reasons = [F.when(filters.genotype_missing(F.col("geno"), F.col("status")), "missing_genotype")]
    if profile.pass_filter:
        reasons.append(F.when(~filters.passes(F.col("filter")), "filter"))
    return F.concat_ws(",", *reasons)


def read_genotypes(df: DataFrame, strict_gt: bool = False) -> DataFrame:
    """Read depths and the genotype class that the call alone gives."""
    return read_depths(df).withColumn("geno", genotype_class(F.col("gt"), strict_gt))


def classify(df: DataFrame, profile: Profile, strict_gt: bool = False) -> DataFrame:
    """Read depths, sex-adjusted genotype class and call-level drop reasons; ``gt`` goes."""
    df = read_genotypes(df, strict_gt)
    return sex_adjust(df).withColumn("call_drops", call_drops(profile)).drop("gt")
