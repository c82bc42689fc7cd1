"""Pedigree, annotated sites, calls, gene lists, null tables, indel scores, copy-number calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantrank.functions.genotypes import (
    ancestry_from_code,
    ancestry_from_label,
    cnv_genotype,
)
from variantrank.functions.scores import BINS
from variantrank.operators.nulls import cell_table
from variantrank.profiles import Profile
from variantrank.sources.heads import read_by_header
from variantrank.sources.lines import fields, not_na, read_lines, split_tabs

# Field names of the call file and of the copy-number additions.
CALL_FIELDS = (
    "chr start end ref alt c2 s2 vcf_id r2 a2 qual filter site_info format gt".split()
)
CNV_FIELDS = {
    "del": "type region info filter qual alt_read total_read".split(),
    "dup": "type info filter qual alt_read total_read".split(),
}
INDEL_HEADER = ("#chrom", "pos", "ref")
# Pedigree fields by position: family, person, father, mother, sex, status, ancestry.
PEDIGREE_POSITIONS = {"readme": (0, 1, 2, 3, 4, 5, 6), "wide": (0, 1, 2, 3, 4, 5, 12)}


def parse_pedigree(lines: DataFrame, form: str = "readme", header: str | None = None) -> DataFrame:
    """(fam_id, iid, pat_id, mat_id, sex, status, eth) of either pedigree form."""
    if form not in PEDIGREE_POSITIONS:
        raise ValueError(f"unknown pedigree form {form!r}")
    if header is not None:
        lines = lines.filter(F.col("value") != header)
    text, pattern = (F.trim("value"), r"\s+") if form == "readme" else (F.col("value"), "\t")
    parts = lines.filter(F.trim("value") != "").select(F.split(text, pattern).alias("parts"))
    fam, iid, pat, mat, sex, status, eth = [
        F.get("parts", F.lit(i)) for i in PEDIGREE_POSITIONS[form]
    ]
    group = ancestry_from_code(eth) if form == "readme" else ancestry_from_label(eth)
    return parts.select(
        fam.alias("fam_id"),
        iid.alias("iid"),
        pat.alias("pat_id"),
        mat.alias("mat_id"),
        sex.try_cast("int").alias("sex"),
        status.try_cast("int").alias("status"),
        group.alias("eth"),
    )


def read_pedigree(
    spark: SparkSession, path, form: str = "readme", header: bool = False
) -> DataFrame:
    """Pedigree lines; with ``header`` the first line of every file is left out."""
    if not header:
        return parse_pedigree(read_lines(spark, path), form)
    return read_by_header(spark, path, lambda lines, first: parse_pedigree(lines, form, first))


def parse_annotations(lines: DataFrame, header: list[str], profile: Profile) -> DataFrame:
    """Annotated sites under their canonical names; junk in a number column is NULL.

    Columns are found by name, so the annotator's trailing columns do not matter.
    """
    missing = [name for _, name in profile.annotation_columns if name not in header]
    if missing:
        raise ValueError(f"annotated sites lack columns {missing}")
    body = split_tabs(lines.filter(F.col("value") != "\t".join(header)))
    numbers = {c for c, _ in profile.af_columns} | {"raw_score", "phred"}

    def column(canonical: str, name: str):
        text = not_na(F.get("parts", F.lit(header.index(name))))
        if canonical in ("start", "end"):
            text = text.try_cast("long")
        elif canonical in numbers:
            text = text.try_cast("double")
        return text.alias(canonical)

    return body.select(*[column(c, n) for c, n in profile.annotation_columns], "ord")


def read_annotations(spark: SparkSession, path, profile: Profile) -> DataFrame:
    """Annotated sites; files may differ in the order and number of their columns."""
    return read_by_header(spark, path, lambda lines, first: parse_annotations(lines, first.split("\t"), profile))


def parse_calls(lines: DataFrame, iid=None) -> DataFrame:
    """Calls of the 15 fixed fields; the person is ``iid`` or the file's stem."""
    person = F.regexp_extract("file", r"([^/]+)\.avinput(?:\.gz)?$", 1) if iid is None else iid
    parts = split_tabs(lines.withColumn("iid", person)).select("iid", "ord", "parts")
    wanted = [c for c in fields(CALL_FIELDS)]
    rows = parts.select("iid", *wanted, "ord")
    return rows.withColumn("start", F.col("start").try_cast("long")).withColumn(
        "end", F.col("end").try_cast("long")
    )


def read_calls(spark: SparkSession, path) -> DataFrame:
    return parse_calls(read_lines(spark, path))


def prune_calls(calls: DataFrame) -> DataFrame:
    """Calls cut to the variant, the quality fields, FORMAT and GT."""
    return calls.select("iid", "chr", "start", "ref", "alt", "qual", "filter", "format", "gt", "ord")


def parse_gene_list(lines: DataFrame) -> DataFrame:
    """Distinct names, whatever white space separates them."""
    names = lines.select(F.explode(F.split(F.trim("value"), r"\s+")).alias("gene"))
    return names.filter("gene <> ''").distinct()


def read_gene_list(spark: SparkSession, path) -> DataFrame:
    return parse_gene_list(read_lines(spark, path))


def parse_null_table(lines: DataFrame, model, eth) -> DataFrame:
    """(model, eth, gene, p): gene and one probability per score bin."""
    parts = lines.select(
        F.split(F.trim("value"), r"\s+").alias("parts"),
        model.alias("model"),
        eth.alias("eth"),
    )
    parts = parts.select(
        "model",
        "eth",
        F.get("parts", F.lit(0)).alias("gene"),
        F.size("parts").alias("width"),
        F.transform(F.slice("parts", 2, BINS), lambda x: x.try_cast("double")).alias("p"),
    )
    wrong = F.raise_error(F.format_string(f"null table row of %s has %d fields, not {BINS + 1}", "gene", "width"))
    whole = parts.filter("gene <> ''")
    return whole.withColumn("p", F.when(F.col("width") == BINS + 1, F.col("p")).otherwise(wrong)).drop("width")


def read_null_tables(spark: SparkSession, paths: dict) -> DataFrame:
    """Null tables from ``{(model, eth): path}``."""
    tables = [
        parse_null_table(read_lines(spark, path), F.lit(model), F.lit(eth))
        for (model, eth), path in paths.items()
    ]
    nulls = tables[0]
    for table in tables[1:]:
        nulls = nulls.unionByName(table)
    return nulls


def write_null_tables(nulls: DataFrame, path: str) -> None:
    """One-time conversion: a gzipped text table is one task, its Parquet form is not."""
    (
        nulls.repartition("model", "eth", F.pmod(F.xxhash64("gene"), F.lit(16)))
        .write.mode("overwrite")
        .partitionBy("model", "eth")
        .parquet(path)
    )


def write_null_cells(nulls: DataFrame, path: str) -> None:
    """One-time conversion to a narrow row per gene and score bin (``operators.nulls.cell_table``), which a run may be given
    as its null table."""
    cell_table(nulls).write.mode("overwrite").parquet(path)


def parse_indel_scores(lines: DataFrame, header: list[str]) -> DataFrame:
    """(chr, start, ref, alt, raw_score, phred) as written, comment lines dropped."""
    names = [h.strip().lower() for h in header]
    if tuple(names[:3]) != INDEL_HEADER:
        raise ValueError(f"indel scores must start with #Chrom, Pos, Ref; found {header[:3]}")
    missing = [n for n in ("alt", "rawscore", "phred") if n not in names]
    if missing:
        raise ValueError(f"indel scores lack columns {missing}")
    body = split_tabs(lines.filter(~F.col("value").startswith("#")))

    def at(name):
        return not_na(F.get("parts", F.lit(names.index(name))))

    return body.select(
        at("#chrom").alias("chr"),
        at("pos").try_cast("long").alias("start"),
        at("ref").alias("ref"),
        at("alt").alias("alt"),
        at("rawscore").try_cast("double").alias("raw_score"),
        at("phred").try_cast("double").alias("phred"),
    )


def read_indel_scores(spark: SparkSession, path) -> DataFrame:
    """Indel scores, plain or gzipped, with or without leading ``##`` lines; only the heads of the files are read for it."""

    def parse(lines: DataFrame, header: str) -> DataFrame:
        return parse_indel_scores(lines, header.split("\t"))

    return read_by_header(spark, path, parse, lambda line: line.startswith("#") and not line.startswith("##"))


def parse_cnv(lines: DataFrame, header: list[str], kind: str, profile: Profile) -> DataFrame:
    """Copy-number calls: annotated fields (the last one is the person) plus the fixed additions.

    Surplus fields are cut off, but the last raw field still decides het or hom.
    """
    names = header[:-1] + ["ID"] + CNV_FIELDS[kind]
    body = split_tabs(lines.filter(F.col("value") != "\t".join(header)))
    wanted = [(c, n) for c, n in profile.annotation_columns if n in names]
    numbers = {c for c, _ in profile.af_columns} | {"raw_score", "phred"}

    def column(canonical, name):
        text = not_na(F.get("parts", F.lit(names.index(name))))
        if canonical in ("start", "end"):
            text = text.try_cast("long")
        elif canonical in numbers:
            text = text.try_cast("double")
        return text.alias(canonical)

    added = [column(n, n) for n in CNV_FIELDS[kind] if n != "region"]
    last = F.element_at("parts", -1)
    return body.select(
        column("iid", "ID"),
        *[column(c, n) for c, n in wanted],
        *added,
        cnv_genotype(kind, last).alias("geno"),
        "ord",
    )


def read_cnv(spark: SparkSession, path, kind: str, profile: Profile) -> DataFrame:
    """Copy-number calls; files may differ in the order and number of their annotated columns."""
    return read_by_header(spark, path, lambda lines, first: parse_cnv(lines, first.split("\t"), kind, profile))
