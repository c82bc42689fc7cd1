"""Variant identity, allele trimming and VCF field expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VARIANT = ["chr", "start", "ref", "alt"]
#: The same columns in the order to sort by: positions differ far more often than contigs, and compare as numbers.
BY_POSITION = ["start", "chr", "ref", "alt"]


def variant_key(chrom="chr", start="start", ref="ref", alt="alt") -> Column:
    """``chr:start_ref>alt``; a missing part reads ``NA``."""

    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("NA"))

    return F.concat(text(chrom), F.lit(":"), text(start), F.lit("_"), text(ref), F.lit(">"), text(alt))


def trimmed_start(pos: Column, ref: Column) -> Column:
    return F.when(F.length(ref) > 1, pos + 1).otherwise(pos)


def trimmed_allele(allele: Column) -> Column:
    """Allele without its first (anchor) base; ``-`` when nothing is left."""
    return F.when(F.length(allele) > 1, F.substring(allele, 2, 2147483647)).otherwise(
        F.when(allele.isNotNull(), F.lit("-"))
    )


def is_anchored(ref: Column, alt: Column) -> Column:
    """A VCF allele pair that carries a shared leading base to trim away."""
    return ((F.length(ref) > 1) | (F.length(alt) > 1)) & (
        F.substring(ref, 1, 1) == F.substring(alt, 1, 1)
    )


def info_keep(info: Column, name: str) -> Column:
    """INFO reduced to one key; ``.`` when the key is absent."""
    kept = F.filter(F.split(info, ";"), lambda item: item.startswith(f"{name}=") | (item == name))
    return F.when(F.size(kept) > 0, F.array_join(kept, ";")).when(info.isNotNull(), F.lit("."))


def has_alternate(gt: Column) -> Column:
    """At least one non-reference allele in the GT sub-field."""
    return F.coalesce(F.substring_index(gt, ":", 1).rlike("[1-9]"), F.lit(False))


def holds_allele(gt: Column, number: Column) -> Column:
    """The GT sub-field names this allele; 0 is the reference, 1 the first ALT."""
    alleles = F.split(F.substring_index(gt, ":", 1), r"[/|]")
    return F.coalesce(F.array_contains(alleles, number.cast("string")), F.lit(False))
