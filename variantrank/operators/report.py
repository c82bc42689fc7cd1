"""What was left out, row counts by stage, and candidates shared by affected people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantrank.functions.variants import has_alternate, variant_key
from variantrank.operators.joins import lookup_join

MAX_P = 1e-3
MIN_CASES = 2


def dropped_variants(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """Distinct raw rows of a person whose key is in none of that person's kept rows."""
    keys = kept.select("iid", "key").distinct()
    return raw.join(keys, ["iid", "key"], "left_anti").distinct()


def stage_audit(raw: DataFrame, ranked: DataFrame) -> DataFrame:
    """Per person: raw rows, clean rows, rows taking part in a model, ranked rows.

    ``raw`` carries ``drop_reason``; both sides are counted before they meet.
    """
    clean = F.col("drop_reason") == ""
    carrier = F.col("geno").isin("het", "hom", "hem", "het_female", "hom_female")
    before = raw.groupBy("iid").agg(
        F.count("*").alias("n_raw"),
        F.count_if(clean).alias("n_clean"),
        F.count_if(clean & carrier).alias("n_candidate"),
    )
    after = ranked.groupBy("iid").agg(F.count("*").alias("n_ranked"))
    return before.join(after, "iid", "left").fillna(0, ["n_ranked"])


def shared_by_affected(ranked: DataFrame, pedigree: DataFrame, max_p: float = MAX_P, min_cases: int = MIN_CASES) -> DataFrame:
    """(key, gene, dz_model, n_cases): variants ranked below ``max_p`` in ``min_cases`` affected people or more."""
    cases = lookup_join(
        ranked.filter(F.col("prob") < max_p).select("iid", "key", "gene", "dz_model"),
        pedigree.filter("status = 2").select("iid"),
        ["iid"],
        "left_semi",
    )
    return (
        cases.groupBy("key", "gene", "dz_model")
        .agg(F.count_distinct("iid").alias("n_cases"))
        .filter(F.col("n_cases") >= min_cases)
    )


def unseen_in_unaffected(
    shared: DataFrame, observed: DataFrame, pedigree: DataFrame, rejected_calls: DataFrame | None = None, measured: bool = False
) -> DataFrame:
    """``shared`` without the variants that an unaffected person carries.

    ``observed`` holds the (iid, key, gene, geno) of the cohort, at least those of the shared keys. Only its rows of a
    shared variant are looked at, and these shrink to distinct (key, gene) within each task before they are shuffled.
    ``rejected_calls`` are calls of people who take no part in the run (of unknown sex, say): a
    variant of which an unaffected one of them carries an alternate allele is no candidate either.
    ``measured`` says that ``shared`` is read from a file, so that its size can be asked for.
    """
    unaffected = pedigree.filter("status = 1").select("iid")

    def carried_by_unaffected(rows: DataFrame, on: list[str]) -> DataFrame:
        wanted = shared.select(*on).distinct()
        found = lookup_join(rows, wanted, on, "left_semi") if measured else rows.join(wanted, on, "left_semi")
        return lookup_join(found, unaffected, ["iid"], "left_semi").select(*on).distinct()

    carriers = observed.filter(~F.col("geno").isin("ref", "miss")).select("iid", "key", "gene")
    found = shared.join(carried_by_unaffected(carriers, ["key", "gene"]), ["key", "gene"], "left_anti")
    if rejected_calls is None:
        return found
    carried = rejected_calls.filter(has_alternate(F.col("gt"))).withColumn("key", variant_key()).select("iid", "key")
    return found.join(carried_by_unaffected(carried, ["key"]), "key", "left_anti")


def candidate_report(
    ranked: DataFrame,
    observed: DataFrame,
    pedigree: DataFrame,
    max_p: float = MAX_P,
    min_cases: int = MIN_CASES,
    rejected_calls: DataFrame | None = None,
) -> DataFrame:
    """Variants ranked below ``max_p`` in ``min_cases`` affected people and seen in no unaffected."""
    shared = shared_by_affected(ranked, pedigree, max_p, min_cases)
    return unseen_in_unaffected(shared, observed, pedigree, rejected_calls)
