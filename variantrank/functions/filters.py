"""Row predicates of the cleaning step; every one is TRUE or FALSE, never NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gene-name prefixes that are never reported; frequency limit.
BLACKLIST = ("HLA", "MUC", "KRT", "TRBV")
MAX_DISCREPANT_AF = 0.05


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def blacklisted(gene: Column) -> Column:
    return _true(gene.rlike("^(" + "|".join(BLACKLIST) + ")"))


def af_discrepant(af: Column, kg: Column, esp: Column) -> Column:
    """Unseen in the main frequency source but common in one of the other two."""
    return _true(af.isNull() & ((kg > MAX_DISCREPANT_AF) | (esp > MAX_DISCREPANT_AF)))


def coding_or_splice(func: Column, exonic_func: Column) -> Column:
    return _true(func.contains("splic")) | exonic_func.isNotNull()


def is_splice(func: Column) -> Column:
    return _true(func.contains("splic"))


def genotype_missing(geno: Column, status: Column) -> Column:
    """No genotype class for a person whose status is known."""
    return _true((status > 0) & geno.isNull())


def passes(filter_field: Column) -> Column:
    return _true(filter_field.isin("PASS", "."))


def matches(exonic_func: Column, pattern: str) -> Column:
    return _true(exonic_func.rlike(pattern))
