"""Checks that stop a run before it starts or set people aside."""

from __future__ import annotations

from pyspark.sql import DataFrame


def missing_sources(required: DataFrame, available: DataFrame) -> DataFrame:
    """Required annotation sources (``source``) that are not available."""
    return required.select("source").distinct().join(
        available.select("source").distinct(), "source", "left_anti"
    )


def require_sources(required: DataFrame, available: DataFrame) -> None:
    """Raise if any required source is missing."""
    lacking = [r["source"] for r in missing_sources(required, available).collect()]
    if lacking:
        raise ValueError(f"missing annotation sources: {sorted(lacking)}")


def samples_not_in_vcf(pedigree: DataFrame, samples: DataFrame) -> DataFrame:
    """Pedigree people without a sample column."""
    return pedigree.join(samples.select("iid").distinct(), "iid", "left_anti")
