"""Scores of insertions and deletions from a separate table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantrank.functions.filters import matches
from variantrank.functions.scores import clamped, score_norm
from variantrank.functions.variants import VARIANT, trimmed_allele, trimmed_start, variant_key
from variantrank.profiles import Profile


def _any(df: DataFrame, condition: Column) -> Column:
    return F.coalesce(df.agg(F.max(condition)).scalar(), F.lit(False))


def harmonize_contigs(indels: DataFrame, variants: DataFrame) -> DataFrame:
    """Prefix the indel contigs with ``chr`` if only the variants use that prefix."""
    prefixed = F.col("chr").contains("chr")
    add = _any(variants, prefixed) & ~_any(indels, prefixed)
    return indels.withColumn("chr", F.when(add, F.concat(F.lit("chr"), "chr")).otherwise(F.col("chr")))


def has_dashes(indels: DataFrame) -> Column:
    """TRUE if any allele of the table is already written with ``-``."""
    return _any(indels, F.col("ref").contains("-") | F.col("alt").contains("-"))


def left_trim(indels: DataFrame, unless: Column | None = None) -> DataFrame:
    """Drop the anchor base of both alleles; deletions start one base later."""
    trim = F.lit(True) if unless is None else ~unless
    rest = [c for c in indels.columns if c not in ("start", "ref", "alt")]
    start, ref, alt = F.col("start"), F.col("ref"), F.col("alt")
    return indels.select(
        *rest,
        F.when(trim, trimmed_start(start, ref)).otherwise(start).alias("start"),
        F.when(trim, trimmed_allele(ref)).otherwise(ref).alias("ref"),
        F.when(trim, trimmed_allele(alt)).otherwise(alt).alias("alt"),
    )


def prepare_indels(indels: DataFrame, variants: DataFrame, profile: Profile) -> DataFrame:
    """Indel table in the convention of ``variants``, without repeated rows."""
    if profile.harmonize_contigs:
        indels = harmonize_contigs(indels, variants)
    unless = has_dashes(indels) if profile.guard_dashes else None
    return left_trim(indels, unless).select(*VARIANT, "raw_score", "phred").distinct()


def rescore_indels(df: DataFrame, prepared: DataFrame | None, profile: Profile) -> DataFrame:
    """Replace the score of rows of the profile's pattern by the indel table's.

    An unlisted row loses its score. One conditional left join: the other rows
    keep theirs and never multiply. ``rescored`` marks the replaced rows.
    """
    if prepared is None:
        return df.withColumn("rescored", F.lit(False))
    exempt = F.col("rescore_exempt") if "rescore_exempt" in df.columns else F.lit(False)
    df = df.withColumn("rescored", matches(F.col("exonic_func"), profile.rescore_pattern) & ~exempt)
    if profile.indel_join == "key":
        new = prepared.select(variant_key().alias("_key"), *_new_scores())
        df = df.withColumn("_own", variant_key())
        on = df["_own"] == new["_key"]
    else:
        new = prepared.select(*[F.col(c).alias(f"_{c}") for c in VARIANT], *_new_scores())
        on = (
            (df["chr"] == new["_chr"])
            & (df["start"] == new["_start"])
            & (df["ref"] == new["_ref"])
            & (df["alt"] == new["_alt"])
        )
    joined = df.join(new, on & df["rescored"], "left")
    return joined.select(
        *[c for c in df.columns if c not in ("raw_score", "phred", "_own")],
        F.when(df["rescored"], F.col("_raw_score")).otherwise(df["raw_score"]).alias("raw_score"),
        F.when(df["rescored"], F.col("_phred")).otherwise(df["phred"]).alias("phred"),
    )


def _new_scores():
    return F.col("raw_score").alias("_raw_score"), F.col("phred").alias("_phred")


def normalize_scores(df: DataFrame) -> DataFrame:
    """Clamp ``phred`` to the calibrated range and add ``score_norm``."""
    return df.withColumn("score_norm", score_norm(F.col("phred"))).withColumn(
        "phred", clamped(F.col("phred"))
    )


def mark_scored(df: DataFrame, prepared: DataFrame | None, profile: Profile) -> DataFrame:
    """``has_score``: the row would have a score after :func:`rescore_indels`; rows never multiply."""
    own = F.col("phred").isNotNull()
    if prepared is None:
        return df.withColumn("has_score", own)
    listed = prepared.filter("phred is not null").select(*VARIANT).distinct()
    exempt = F.col("rescore_exempt") if "rescore_exempt" in df.columns else F.lit(False)
    rescored = matches(F.col("exonic_func"), profile.rescore_pattern) & ~exempt
    return df.join(listed.withColumn("_listed", F.lit(True)), VARIANT, "left").withColumn(
        "has_score", F.when(rescored, F.coalesce("_listed", F.lit(False))).otherwise(own)
    ).drop("_listed")
