"""Work done once per variant site, before any genotype is touched."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantrank.functions import filters
from variantrank.functions.variants import VARIANT, variant_key
from variantrank.operators.genes import first_site, flag_genes, split_fusion_genes
from variantrank.profiles import Profile
from variantrank.sources.genome import SiteKeys


def annotate_sites(sites: DataFrame, sources: dict[str, DataFrame], **key_options) -> DataFrame:
    """Left join each source by exact variant; its value columns are NULL when absent.

    Sources are cut down to the sites' keys before they are shuffled. All joins share one key, so the sites are
    shuffled once for the whole chain.
    """
    on = ["chr", "start", "end", "ref", "alt"]
    keys = SiteKeys(sites, on, **key_options)
    return reduce(lambda df, source: df.join(one_per_key(keys.meeting(source), on), on, "left"), sources.values(), sites)


def annotate_scores(sites: DataFrame, scores: DataFrame, **key_options) -> DataFrame:
    """Left join (chr, start, ref, alt, raw_score, phred); unscored sites stay, with NULL.

    Of the score table only rows that meet a site are shuffled (:class:`SiteKeys`).
    """
    met = SiteKeys(sites, VARIANT, **key_options).meeting(scores)
    return sites.join(one_per_key(met.select(*VARIANT, "raw_score", "phred"), VARIANT), VARIANT, "left")


def one_per_key(source: DataFrame, on: list[str]) -> DataFrame:
    """The source with one row per key: of a key listed more than once the least row, so that sites never multiply.

    It shuffles by the key of the join that follows, which then needs no shuffle of its own for this side.
    """
    rest = [c for c in source.columns if c not in on]
    least = source.groupBy(*on).agg(F.min(F.struct(*rest)).alias("_row"))
    return least.select(*on, *[F.col(f"_row.{c}").alias(c) for c in rest])


def site_drops(profile: Profile) -> Column:
    """Comma-joined reasons, known from the site alone, to leave a row out."""
    gene = F.col("gene")
    reasons = [
        F.when(filters.blacklisted(gene), "blacklist"),
        F.when(~F.col("in_lookup"), "not_in_lookup"),
        F.when(~filters.coding_or_splice(F.col("func"), F.col("exonic_func")), "non_coding"),
    ]
    if profile.af_filter:
        reasons.append(
            F.when(
                filters.af_discrepant(F.col("af"), F.col("kg"), F.col("esp")), "af_discrepancy"
            )
        )
    return F.concat_ws(",", *reasons)


def flag_variants(
    df: DataFrame,
    xy_genes: DataFrame,
    lookup_genes: DataFrame,
    profile: Profile,
    **join_options,
) -> DataFrame:
    """Add the key, the gene-list flags and the site-level drop reasons."""
    lists = {"is_xy": xy_genes, "in_lookup": lookup_genes}
    return (
        flag_genes(df.withColumn("key", variant_key()), lists, **join_options)
        .withColumn("is_splice", filters.is_splice(F.col("func")))
        .withColumn("site_drops", site_drops(profile))
    )


def prepare_sites(
    sites: DataFrame,
    xy_genes: DataFrame,
    lookup_genes: DataFrame,
    profile: Profile,
    **join_options,
) -> DataFrame:
    """Annotated sites to one flagged row per (variant, gene)."""
    rows = first_site(split_fusion_genes(sites)).drop("ord")
    return flag_variants(rows, xy_genes, lookup_genes, profile, **join_options)
