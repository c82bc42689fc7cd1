"""Analysis profiles: the annotation set, its column names and the filter switches."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Gene-model release by genome build, annotation column names.
GENCODE = {
    "cadd16": {"hg38": "wgEncodeGencodeBasicV35", "other": "wgEncodeGencodeBasicV19"},
    "cadd13": {"hg38": "wgEncodeGencodeBasicV20", "other": "wgEncodeGencodeBasicV19"},
}
CADD16_AF = (("af", "AF"), ("af_afr", "AF_afr"), ("af_nfe", "AF_nfe"))
CADD13_AF = (
    ("af", "gnomAD_exome_ALL"),
    ("af_afr", "gnomAD_exome_AFR"),
    ("af_nfe", "gnomAD_exome_NFE"),
    ("exac", "ExAC_ALL"),
    ("kg", "1000g2015aug_all"),
    ("esp", "esp6500siv2_all"),
)
# Annotation sources that must be present before a cohort is annotated.
SOURCES = {
    "cadd16": ("gene_model", "gene_model_mrna", "gnomad_exome", "clinvar"),
    "cadd13": (
        "1000g2015aug_all",
        "cadd13",
        "esp6500siv2_all",
        "gene_model_mrna",
        "gene_model",
        "exac03",
        "gnomad_exome",
        "clinvar",
    ),
}


@dataclass(frozen=True)
class Profile:
    """One annotation set with its switches.

    ``rescore_pattern`` selects, by exonic function, the rows whose score is
    replaced by the indel table; ``indel_join`` is the join key of that table.
    """

    name: str
    gencode: dict
    score_column: str
    raw_score_column: str
    af_columns: tuple
    sources: tuple
    pedigree_form: str
    rescore_pattern: str = "^frameshift"
    indel_join: str = "fields"
    harmonize_contigs: bool = False
    guard_dashes: bool = False
    af_filter: bool = False
    pass_filter: bool = False
    build: str = "hg38"

    def with_build(self, build: str) -> "Profile":
        return replace(self, build=build)

    @property
    def gene_model(self) -> str:
        return self.gencode.get(self.build, self.gencode["other"])

    @property
    def gene_columns(self) -> tuple:
        """(canonical, annotated) names of the five gene-model columns."""
        g = self.gene_model
        return (
            ("gene", f"Gene.{g}"),
            ("func", f"Func.{g}"),
            ("exonic_func", f"ExonicFunc.{g}"),
            ("aa_change", f"AAChange.{g}"),
            ("gene_detail", f"GeneDetail.{g}"),
        )

    @property
    def annotation_columns(self) -> tuple:
        """(canonical, annotated) names of every annotation column relied on."""
        return (
            (("chr", "Chr"), ("start", "Start"), ("end", "End"), ("ref", "Ref"), ("alt", "Alt"))
            + self.gene_columns
            + self.af_columns
            + (
                ("raw_score", self.raw_score_column),
                ("phred", self.score_column),
                ("clnsig", "CLNSIG"),
                ("clndn", "CLNDN"),
            )
        )

    @property
    def variant_columns(self) -> tuple:
        """(canonical, reported) names of the variant columns shared by both reports."""
        return (
            (
                ("iid", "ID"),
                ("key", "Key"),
                ("chr", "Chr"),
                ("start", "Start"),
                ("ref", "Ref"),
                ("alt", "Alt"),
                ("total_read", "Total_Read"),
                ("alt_read", "Alt_Read"),
            )
            + self.gene_columns
            + self.af_columns
            + (("phred", self.score_column), ("clnsig", "CLNSIG"), ("clndn", "CLNDN"))
        )

    @property
    def ranked_columns(self) -> tuple:
        # The reported names of the three ranking columns.
        return self.variant_columns + (("geno", "Geno"), ("dz_model", "Dz.Model"), ("prob", "PSAP"))

    @property
    def dropped_columns(self) -> tuple:
        return self.variant_columns + (("geno", "Geno"),)


CADD16 = Profile(
    name="cadd16",
    gencode=GENCODE["cadd16"],
    score_column="CADD16phred",
    raw_score_column="CADD16raw",
    af_columns=CADD16_AF,
    sources=SOURCES["cadd16"],
    pedigree_form="wide",
    harmonize_contigs=True,
    guard_dashes=True,
)
CADD13_V14 = Profile(
    name="cadd13_v14",
    gencode=GENCODE["cadd13"],
    score_column="CADD13_PHRED",
    raw_score_column="CADD13_RawScore",
    af_columns=CADD13_AF,
    sources=SOURCES["cadd13"],
    pedigree_form="readme",
    af_filter=True,
    pass_filter=True,
)
CADD13_V13 = replace(CADD13_V14, name="cadd13_v13", rescore_pattern="shift", indel_join="key")

PROFILES = {p.name: p for p in (CADD16, CADD13_V14, CADD13_V13)}
