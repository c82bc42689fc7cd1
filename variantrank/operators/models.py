"""Inheritance models: candidate rows, the worst per gene, their probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantrank.functions.genotypes import (
    compound_geno,
    disease_model,
    mapped,
    takes_part,
    zygosity,
)
from variantrank.functions.variants import VARIANT, variant_key
from variantrank.operators.nulls import MODELS, null_lookup


def severity() -> list[Column]:
    """Total order of a gene's rows: score first, then the fixed tie order.

    Re-scored rows come after the others, splice rows before the rest,
    copy-number rows last; then the key, or for re-scored rows its parts.
    """
    return [
        F.col("score_norm").desc(),
        F.col("rescored").asc(),
        F.col("is_splice").desc(),
        F.col("is_cnv").asc(),
        F.when(~F.col("rescored"), variant_key()).asc(),
        *[F.col(c).asc() for c in VARIANT],
        F.col("cnv_ord").asc(),
    ]


GROUP = ["iid", "gene", "zyg"]


def _ranked(df: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` worst rows per person, gene and zygosity as ``rank`` 1, 2, ...

    A rank limit right on the window lets each task cut its groups to ``keep``
    rows before the shuffle, so no group arrives whole anywhere.
    """
    order = Window.partitionBy(*GROUP).orderBy(*severity())
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def with_zygosity(df: DataFrame) -> DataFrame:
    """Rows that take part in a model, with ``zyg`` het, hom or hem."""
    return df.filter(takes_part(F.col("geno"))).withColumn("zyg", zygosity(F.col("geno")))


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("dz_model", disease_model(F.col("geno"), F.col("chr")))


def _single(df: DataFrame, nulls: DataFrame, zyg: str, report_all: bool) -> DataFrame:
    rows = with_zygosity(df).filter(F.col("zyg") == zyg)
    if not report_all:
        rows = _ranked(rows, 1).drop("rank")
    return _labelled(null_lookup(rows, nulls, zyg)).drop("zyg")


def model_het(df: DataFrame, nulls: DataFrame, report_all: bool = False) -> DataFrame:
    """Dominant (or X-linked) heterozygous rows with their probability."""
    return _single(df, nulls, "het", report_all)


def model_hom(df: DataFrame, nulls: DataFrame, report_all: bool = False) -> DataFrame:
    """Recessive (or X-linked) homozygous rows with their probability."""
    return _single(df, nulls, "hom", report_all)


def model_hem(df: DataFrame, nulls: DataFrame, report_all: bool = False) -> DataFrame:
    """Hemizygous rows of males with their probability."""
    return _single(df, nulls, "hem", report_all)


def worst_per_gene(df: DataFrame) -> DataFrame:
    """The worst row per person, gene and zygosity."""
    return _ranked(with_zygosity(df), 1).drop("rank", "zyg")


def chet_genes(df: DataFrame) -> DataFrame:
    """(iid, gene, n): genes with two or more heterozygous rows of a person."""
    het = with_zygosity(df).filter("zyg = 'het'")
    return het.groupBy("iid", "gene").agg(F.count("*").alias("n")).filter("n >= 2")


def worst_pair(df: DataFrame) -> DataFrame:
    """The two worst heterozygous rows of each gene that has at least two, as ``rank`` 1 and 2."""
    het = with_zygosity(df).filter("zyg = 'het'")
    pairs = _ranked(het, 2).withColumn("_n", F.max("rank").over(Window.partitionBy(*GROUP)))
    return pairs.filter("_n = 2").drop("_n").withColumn("geno", compound_geno(F.col("geno")))


def pair_prob(pairs: DataFrame) -> DataFrame:
    """Give both members of a pair the second member's probability."""
    second = F.max(F.when(F.col("rank") == 2, F.col("prob"))).over(Window.partitionBy(*GROUP))
    return pairs.withColumn("prob", second)


def _group_size() -> Column:
    """Rows of the same person, gene and zygosity: a gene's variants, which one person has few of."""
    return F.count("*").over(Window.partitionBy(*GROUP))


def _compound_rows(df: DataFrame) -> DataFrame:
    """Every heterozygous row of the genes that have two or more."""
    het = df.filter("zyg = 'het'").withColumn("_n", _group_size())
    return het.filter("_n >= 2").drop("_n").withColumn("geno", compound_geno(F.col("geno")))


def model_chet(df: DataFrame, nulls: DataFrame, report_all: bool = False) -> DataFrame:
    """Compound-heterozygous pairs with the probability of the second member."""
    if report_all:
        return _labelled(null_lookup(_compound_rows(with_zygosity(df)), nulls, "chet")).drop("zyg")
    pairs = pair_prob(null_lookup(worst_pair(df), nulls, "chet"))
    return _labelled(pairs).drop("zyg", "rank")


def probabilities(cells: Column | str, zyg: Column) -> dict[str, Column]:
    """``prob`` and ``prob_chet`` of a row of this zygosity, out of the cells of its ancestry."""
    places = {m: MODELS.index(m) for m in ("het", "hom", "hem")}
    chet = F.get(cells, F.lit(MODELS.index("chet")))
    return {"prob": F.get(cells, mapped(zyg, places)), "prob_chet": F.when(zyg == "het", chet)}


def own_probabilities(df: DataFrame) -> DataFrame:
    """``zyg``, and the row's ``prob`` and ``prob_chet`` out of its ``cells``."""
    rows = df.withColumn("zyg", zygosity(F.col("geno")))
    return rows.withColumns(probabilities("cells", F.col("zyg"))).drop("cells")


def rank_models(rows: DataFrame, report_all: bool = False) -> DataFrame:
    """All models of rows that carry ``zyg`` and their probabilities, in one pass over them and one shuffle.

    The worst dominant row and the worst pair of a gene come from the same two
    heterozygous rows, so one top-2 serves every model. With ``report_all`` each row stands for itself and,
    in a gene with two heterozygous rows or more, for a compound too.
    """
    compound = compound_geno(F.col("geno")).alias("geno")
    if report_all:
        top = rows.withColumn("_n", _group_size())
        single = F.struct(F.col("geno"), F.col("prob"))
        own = F.struct(compound, F.col("prob_chet").alias("prob"))
    else:
        group = Window.partitionBy(*GROUP)
        top = (
            _ranked(rows, 2)
            .withColumn("_n", F.max("rank").over(group))
            .withColumn("_second", F.max(F.when(F.col("rank") == 2, F.col("prob_chet"))).over(group))
        )
        single = F.when(F.col("rank") == 1, F.struct(F.col("geno"), F.col("prob")))
        own = F.struct(compound, F.col("_second").alias("prob"))
    paired = F.when((F.col("zyg") == "het") & (F.col("_n") >= 2), own)
    # A filter behind the explosion, where array_compact() would keep the whole step out of generated code.
    roles = top.withColumn("_role", F.explode(F.array(single, paired))).filter("_role is not null")
    rest = [c for c in rows.columns if c not in ("geno", "zyg", "prob", "prob_chet")]
    return _labelled(roles.select(*rest, "_role.geno", "_role.prob"))
