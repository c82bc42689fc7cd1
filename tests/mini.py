"""A hand-worked cohort of two people."""

from pyspark.sql import functions as F

from variantrank.functions.scores import BINS
from variantrank.plans.pipeline import Cohort

SITE_SCHEMA = (
    "chr string, start long, end long, ref string, alt string, func string, gene string, "
    "gene_detail string, exonic_func string, aa_change string, af double, af_afr double, "
    "af_nfe double, exac double, kg double, esp double, raw_score double, phred double, "
    "clnsig string, clndn string, ord long"
)
CALL_SCHEMA = "iid string, chr string, start long, ref string, alt string, filter string, gt string, ord long"
PED_SCHEMA = "fam_id string, iid string, pat_id string, mat_id string, sex int, status int, eth string"

SNV = "nonsynonymous SNV"
SITES = {
    "a": ("chr1", 100, "A", "G", "exonic", "G1", SNV, 31.0),
    "b": ("chr1", 200, "A", "T", "exonic", "G1", SNV, 24.8),
    "c": ("chr1", 300, "A", "C", "splicing", "G1;G2", None, 31.0),
    "d": ("chr2", 50, "A", "G", "intronic", "G2", None, 40.0),
    "e": ("chr6", 10, "A", "G", "exonic", "HLA-A", SNV, 30.0),
    "f": ("chr7", 10, "C", "T", "exonic", "NOPE", SNV, 30.0),
    "g": ("chrX", 500, "A", "G", "exonic", "XG1", "stopgain", 70.0),
    "h": ("chrX", 600, "A", "G", "exonic", "XG1", SNV, 12.4),
    "i": ("chrY", 700, "A", "G", "exonic", "YG1", SNV, 20.0),
    "j": ("chr3", 900, "A", "G", "exonic", "ODD1", SNV, 20.0),
    "k": ("chr4", 10, "A", "G", "exonic", "G3", SNV, None),
    "l": ("chr4", 20, "A", "G", "exonic", "NOTBL", SNV, 10.0),
    "m": ("chr5", 10, "A", "-", "exonic", "G3", "frameshift deletion", 5.0),
    "n": ("chr9", 10, "A", "G", "exonic", "G4", SNV, 33.0),
    "o": ("chr9", 20, "A", "G", "exonic", "G4", SNV, 12.4),
}
CALLS = {
    "P1": dict(a="0/1:10,8:18", b="0|1", c="1/0", d="0/1", e="0/1", f="0/1", g="1/1", h="0/1",
               i="1/1", j="1/1", k="0/1", l="1/2", m="1/1", n="0/1", o="0/1"),
    "P2": dict(a="1/1", b="./.", c="0/0", g="0/1", h="1/1", i="1/1", l="1", m="0/1"),
}
LOOKUP = "G1 G2 G3 G4 XG1 YG1 ODD1 NOTBL HLA-A".split()
XY = "XG1 YG1 ODD1".split()
WEIGHT = {"het": 1000, "chet": 500, "hom": 100, "hem": 10}
ETH = {"ALL": 3, "AFR": 2, "NFE": 1}


def key(site):
    chrom, start, ref, alt = SITES[site][:4]
    return f"{chrom}:{start}_{ref}>{alt}"


def site_row(chrom, start, ref, alt, func, gene, exonic, phred, ord=0, **af):
    values = {"af": 0.01, "af_afr": 0.01, "af_nfe": 0.01, "exac": None, "kg": None, "esp": None, **af}
    return (chrom, start, start, ref, alt, func, gene, None, exonic, None, *values.values(), None, phred, None, None, ord)


def sites(spark, rows=None):
    rows = rows if rows is not None else [site_row(*v, ord=i) for i, v in enumerate(SITES.values())]
    return spark.createDataFrame(rows, SITE_SCHEMA)


def calls(spark, rows=None):
    if rows is None:
        rows = [
            (iid, *SITES[s][:4], "PASS", gt, i)
            for iid, gts in CALLS.items()
            for i, (s, gt) in enumerate(gts.items())
        ]
    return spark.createDataFrame(rows, CALL_SCHEMA)


def pedigree(spark, rows=None):
    rows = rows or [("F1", "P1", "0", "0", 1, 2, "ALL"), ("F2", "P2", "0", "0", 2, 1, "AFR")]
    return spark.createDataFrame(rows, PED_SCHEMA)


def genes(spark, names):
    return spark.createDataFrame([(n,) for n in names], "gene string")


def nulls(spark, names=None):
    names = names or [g for g in LOOKUP if g != "NOTBL"]
    rows = [(m, e, g, w * x) for g in names for m, w in WEIGHT.items() for e, x in ETH.items()]
    p = F.transform(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        lambda k: ((F.lit(BINS - 1) - k) * F.col("w")).cast("double") / F.lit(4203000.0),
    )
    return spark.createDataFrame(rows, "model string, eth string, gene string, w int").select(
        "model", "eth", "gene", p.alias("p")
    )


def indels(spark):
    return spark.createDataFrame(
        [("5", 9, "TA", "T", 3.3, 33.0)] * 2,
        "chr string, start long, ref string, alt string, raw_score double, phred double",
    )


def cohort(spark, **changes):
    tables = dict(
        calls=calls(spark),
        sites=sites(spark),
        pedigree=pedigree(spark),
        xy_genes=genes(spark, XY),
        lookup_genes=genes(spark, LOOKUP),
        nulls=nulls(spark),
        indels=indels(spark),
    )
    return Cohort(**{**tables, **changes})
