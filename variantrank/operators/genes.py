"""Gene lists and multi-gene rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from variantrank.functions.variants import VARIANT
from variantrank.operators.joins import lookup_join


def split_fusion_genes(sites: DataFrame) -> DataFrame:
    """One row per gene of a ``;``-separated gene field; all other fields repeat."""
    others = [c for c in sites.columns if c != "gene"]
    return sites.select(
        *others, F.posexplode_outer(F.split("gene", ";")).alias("gene_pos", "gene")
    )


def first_site(sites: DataFrame) -> DataFrame:
    """First row of each (variant, gene), in source order."""
    order = Window.partitionBy(*VARIANT, "gene").orderBy("ord", "gene_pos")
    return (
        sites.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "gene_pos")
    )


def merged_lists(lists: dict[str, DataFrame]) -> DataFrame:
    """One row per gene with a boolean column per list."""
    flags = list(lists)
    marked = [
        genes.select("gene", *[F.lit(f == flag).alias(f) for f in flags])
        for flag, genes in lists.items()
    ]
    merged = reduce(DataFrame.unionByName, marked).filter("gene is not null")
    return merged.groupBy("gene").agg(*[F.max(f).alias(f) for f in flags])


def flag_genes(df: DataFrame, lists: dict[str, DataFrame], **join_options) -> DataFrame:
    """One boolean column per gene list of ``lists``: the row's gene is on it.

    The lists are merged into one table of genes first, so there is one join.
    """
    listed = merged_lists(lists)
    joined = lookup_join(df, listed, ["gene"], "left", **join_options)
    return joined.withColumns({f: F.coalesce(f, F.lit(False)) for f in lists})


def keep_listed_genes(df: DataFrame, genes: DataFrame, **join_options) -> DataFrame:
    listed = genes.select("gene").distinct()
    return lookup_join(df, listed, ["gene"], "left_semi", **join_options)
