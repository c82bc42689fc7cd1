"""Null-table cells: the population probability of a score at least as high."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantrank.functions.genotypes import AFRICAN, ANCESTRIES, EUROPEAN, GENERIC
from variantrank.functions.scores import BINS, bin_index
from variantrank.operators.joins import lookup_join

MODELS = ("het", "hom", "chet", "hem")


def table_bytes(nulls: DataFrame) -> int:
    """Size of a null table from its row count; the cells themselves are not read."""
    width = 8 * len(MODELS) * len(ANCESTRIES) + 64 if is_cell_table(nulls) else BINS * 8
    return nulls.select("gene").count() * width


def only(row, name: Column) -> Column:
    """Aggregate: the one value of a group, NULL if there is none; more than one stops the run."""
    value = F.col(row) if isinstance(row, str) else row
    twice = F.raise_error(F.concat(F.lit("null row listed more than once: "), name))
    return F.when(F.count(value) > 1, twice).otherwise(F.first(value, ignorenulls=True))


def cell_table(nulls: DataFrame) -> DataFrame:
    """(gene, bin, cells): one narrow row per gene and score bin, with the probability of every ancestry and model.

    A one-time conversion (see ``sources.tables.write_null_cells``). A site then meets the one row of its own bin, a hundred
    bytes, where the row of its gene holds the cells of all bins, twelve times eleven kilobytes.
    """
    bins = F.transform(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        lambda b: F.struct(b.alias("bin"), F.array(*[F.array(*[F.get(f"_{e}_{m}", b) for m in MODELS]) for e in ANCESTRIES]).alias("cells")),
    )
    return _by_gene(nulls).select("gene", F.inline(bins))


def _by_gene(nulls: DataFrame) -> DataFrame:
    """One row per gene with the null row of every ancestry and model."""
    rows = [
        only(
            F.when((F.col("model") == m) & (F.col("eth") == e), F.col("p")), F.concat_ws(" ", F.lit(m), F.lit(e), "gene")
        ).alias(f"_{e}_{m}")
        for e in ANCESTRIES
        for m in MODELS
    ]
    return nulls.groupBy("gene").agg(*rows)


def is_cell_table(nulls: DataFrame) -> bool:
    return "cells" in nulls.columns


def null_lookup(df: DataFrame, nulls: DataFrame, model: str, **join_options) -> DataFrame:
    """Add ``prob``: the cell of (model, ancestry, gene, score bin); NULL for an unlisted gene.

    ``nulls`` are null rows, or the narrow rows of :func:`cell_table`.
    """
    position = bin_index(F.col("score_norm"))
    if is_cell_table(nulls):
        joined = _meet_cells(df.withColumn("_bin", position), nulls, **join_options)
        return joined.withColumn("prob", F.get(own_cells("_cells"), F.lit(MODELS.index(model)))).select(*df.columns, "prob")
    own = nulls.filter(F.col("model") == model).groupBy("eth", "gene")
    table = own.agg(only("p", F.concat_ws(" ", F.lit(model), "eth", "gene")).alias("p"))
    size = table_bytes(nulls.filter(F.col("model") == model))
    joined = lookup_join(df, table, ["eth", "gene"], "left", small_bytes=size, **join_options)
    return joined.withColumn("prob", F.get("p", position)).drop("p")


def _meet_cells(df: DataFrame, cells: DataFrame, **join_options) -> DataFrame:
    """``df`` with the ``_cells`` of its gene and ``_bin``."""
    narrow = cells.select("gene", F.col("bin").alias("_bin"), F.col("cells").alias("_cells"))
    if join_options.get("small_bytes") is None:
        join_options["small_bytes"] = table_bytes(cells)
    return lookup_join(df, narrow, ["gene", "_bin"], "left", **join_options)


def attach_nulls(variants: DataFrame, nulls: DataFrame, **join_options) -> DataFrame:
    """Add ``cells`` to scored variants: per ancestry, the probability under each model.

    Done per site, so the null rows never meet the far larger call table. ``nulls`` are null rows, or the narrow rows of
    :func:`cell_table`, of which a shuffle moves a hundred bytes per site and bin instead of whole rows of genes.
    """
    placed = variants.withColumn("_bin", bin_index(F.col("score_norm")))
    if is_cell_table(nulls):
        joined = _meet_cells(placed, nulls, **join_options)
        none = F.array(*[F.array(*[F.lit(None).cast("double")] * len(MODELS))] * len(ANCESTRIES))
        return joined.select(*variants.columns, F.coalesce("_cells", none).alias("cells"))
    if join_options.get("small_bytes") is None:
        join_options["small_bytes"] = table_bytes(nulls)
    joined = lookup_join(placed, _by_gene(nulls), ["gene"], "left", **join_options)
    cells = F.array(
        *[F.array(*[F.get(f"_{e}_{m}", F.col("_bin")) for m in MODELS]) for e in ANCESTRIES]
    )
    return joined.select(*variants.columns, cells.alias("cells"))


def own_cells(cells: Column | str = "cells") -> Column:
    """The part of ``cells`` that belongs to the row's ancestry."""
    eth = F.col("eth")
    places = {e: i for i, e in enumerate(ANCESTRIES)}
    place = F.when(eth == AFRICAN, places[AFRICAN]).when(eth == EUROPEAN, places[EUROPEAN])
    return F.get(cells, place.otherwise(places[GENERIC]))


def repeated_null_rows(nulls: DataFrame) -> DataFrame:
    """(model, eth, gene) listed more than once; must be empty."""
    return nulls.groupBy("model", "eth", "gene").count().filter("count > 1")
