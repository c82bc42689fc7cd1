"""Copy-number calls as ordinary rows of the variant table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantrank.functions.genotypes import cnv_sex_adjusted
from variantrank.operators.genes import flag_genes
from variantrank.operators.joins import lookup_join

# The exonic function a copy-number call is given.
EXONIC_FUNC = {"del": "frameshift deletion", "dup": "frameshift insertion"}


def cnv_union(dels: DataFrame | None, dups: DataFrame | None) -> DataFrame | None:
    """Deletions before duplications, either may be missing; ``cnv_ord`` keeps the order."""
    parts = [
        table.withColumn("exonic_func", F.lit(EXONIC_FUNC[kind]))
        .withColumn("filter", F.lit("PASS"))
        .withColumn("cnv_ord", F.struct(F.lit(rank).alias("table"), F.col("ord").alias("row")))
        .drop("ord")
        for rank, (kind, table) in enumerate((("del", dels), ("dup", dups)))
        if table is not None
    ]
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def cnv_sex_adjust(cnv: DataFrame) -> DataFrame:
    return cnv.withColumn(
        "geno", cnv_sex_adjusted(F.col("geno"), F.col("sex"), F.col("is_xy"), F.col("chr"))
    )


def join_people(cnv: DataFrame, people: DataFrame, **join_options) -> DataFrame:
    """Copy-number calls of the given people, with their family, sex, status and ancestry."""
    return lookup_join(cnv, people, ["iid"], "inner", **join_options)


def prepare_cnv(
    dels: DataFrame | None, dups: DataFrame | None, people: DataFrame, xy_genes: DataFrame
) -> DataFrame | None:
    """Copy-number calls of the given people with sex-adjusted genotypes."""
    cnv = cnv_union(dels, dups)
    if cnv is None:
        return None
    return cnv_sex_adjust(flag_genes(join_people(cnv, people), {"is_xy": xy_genes}))


def merge_cnv(raw: DataFrame, cnv: DataFrame | None) -> DataFrame:
    """Append the copy-number rows, cut to the columns of ``raw``."""
    if cnv is None:
        return raw
    shared = [c for c in raw.columns if c in cnv.columns]
    return raw.unionByName(cnv.select(*shared), allowMissingColumns=True)
