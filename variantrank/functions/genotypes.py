"""Genotype classes, sex adjustment, read depths and ancestry groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MALE, FEMALE = 1, 2

# Ancestry groups and the codes of the two pedigree forms.
GENERIC, AFRICAN, EUROPEAN = "ALL", "AFR", "NFE"
ANCESTRIES = (GENERIC, AFRICAN, EUROPEAN)

# Genotype classes, their sex-specific forms, their models.
CLASSES = {"ref": "ref", "het": "het", "hom": "hom", "miss": "miss"}
MALE_XY = {"ref": "ref", "het": "ref", "hom": "hem", "miss": "miss"}
FEMALE_XY = {"ref": "ref", "het": "het_female", "hom": "hom_female", "miss": "miss"}
ZYGOSITY = {"het": "het", "het_female": "het", "hom": "hom", "hom_female": "hom", "hem": "hem"}
COMPOUND = {"het": "chet", "het_female": "chet_female"}
DISEASE_MODEL = {
    "het": "DOM-het",
    "het_female": "X-linked-het",
    "hom": "REC-hom",
    "hom_female": "X-linked-hom",
    "chet": "REC-chet",
    "chet_female": "X-linked-chet",
}


def table_of(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def mapped(col: Column, mapping: dict) -> Column:
    """Value of a fixed table, NULL for an unlisted or NULL ``col``.

    ``col`` appears once in the expression, where a chain of WHENs would repeat it.
    """
    return F.try_element_at(table_of(mapping), col)


def item_of(parts: Column, index: int) -> Column:
    """Item ``index`` of a split text; a final empty item counts as absent."""
    item = F.get(parts, F.lit(index))
    return F.when((item != "") | (F.size(parts) > index + 1), item)


def genotype_class(gt: Column, strict: bool = False) -> Column:
    """``ref``/``het``/``hom``/``miss`` from a GT field, NULL for a NULL field.

    By default only characters 1 and 3 are compared, so a haploid call reads as
    ``het``; ``strict`` splits the alleles instead.
    """
    if strict:
        alleles = F.split(F.substring_index(gt, ":", 1), r"[/|]")
        return (
            F.when(F.array_contains(alleles, "."), "miss")
            .when(F.size(F.array_distinct(alleles)) > 1, "het")
            .when(F.get(alleles, F.lit(0)) != "0", "hom")
            .when(F.get(alleles, F.lit(0)) == "0", "ref")
        )
    first, second = F.substring(gt, 1, 1), F.substring(gt, 3, 1)
    return (
        F.when((first == ".") | (second == "."), "miss")
        .when(first != second, "het")
        .when(first != "0", "hom")
        .when(first == "0", "ref")
    )


def on_y(chrom: Column) -> Column:
    return F.coalesce(chrom.isin("Y", "chrY"), F.lit(False))


def sex_adjusted(geno: Column, sex: Column, is_xy: Column, chrom: Column) -> Column:
    """Genotype class after the X/Y-gene rules for males and females."""
    forms = (
        F.when((sex == MALE) & is_xy, table_of(MALE_XY))
        .when((sex == FEMALE) & is_xy, table_of(FEMALE_XY))
        .otherwise(table_of(CLASSES))
    )
    return F.when((sex == FEMALE) & on_y(chrom), "ref").otherwise(F.try_element_at(forms, geno))


def cnv_sex_adjusted(geno: Column, sex: Column, is_xy: Column, chrom: Column) -> Column:
    """As :func:`sex_adjusted`, but every male X/Y-gene copy-number call is ``hem``."""
    return F.when((sex == MALE) & is_xy, "hem").otherwise(
        sex_adjusted(geno, F.when(sex != MALE, sex), is_xy, chrom)
    )


def cnv_genotype(kind: str, last_field: Column | None = None) -> Column:
    """Deletion: ``hom`` when the last raw field is 0, else ``het``; duplication: ``het``."""
    if kind == "dup":
        return F.lit("het")
    return F.when(F.coalesce(last_field.try_cast("double") == 0, F.lit(False)), "hom").otherwise("het")


def takes_part(geno: Column) -> Column:
    """The class belongs to some inheritance model."""
    return F.coalesce(geno.isin(*ZYGOSITY), F.lit(False))


def zygosity(geno: Column) -> Column:
    """Genotype class folded over sex: ``het``, ``hom``, ``hem`` or NULL."""
    return mapped(geno, ZYGOSITY)


def compound_geno(geno: Column) -> Column:
    return mapped(geno, COMPOUND)


def disease_model(geno: Column, chrom: Column) -> Column:
    """Inheritance-model label; a ``hem`` call off X and Y has none."""
    hem = F.when(chrom.isin("X", "chrX"), "X-linked-hem").when(chrom.isin("Y", "chrY"), "Y-linked-hem")
    return F.when(geno == "hem", hem).otherwise(mapped(geno, DISEASE_MODEL))


def ancestry_from_code(code: Column) -> Column:
    """Numeric pedigree code: 2 African, 3 non-Finnish European, else generic."""
    return F.when(code == "2", AFRICAN).when(code == "3", EUROPEAN).otherwise(GENERIC)


def ancestry_from_label(label: Column) -> Column:
    """Pedigree label: AFR, EUR, else generic."""
    return F.when(label == "AFR", AFRICAN).when(label == "EUR", EUROPEAN).otherwise(GENERIC)


def table_suffix(eth: Column) -> Column:
    """File-name suffix of the ancestry's null tables."""
    return F.when(eth.isin(AFRICAN, EUROPEAN), F.concat(F.lit("_"), eth)).otherwise("")
