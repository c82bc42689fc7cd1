"""The benchmark tables seen as a cohort.

Parts are variant sites, order lines are genotype calls, customers are people.
Every expression is whole-number arithmetic on the keys, so another engine gets
the same values. Nothing is sampled or cut: the cohort grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantrank.functions.genotypes import (
    AFRICAN,
    ANCESTRIES,
    EUROPEAN,
    GENERIC,
    ancestry_from_label,
    cnv_genotype,
)
from variantrank.functions.scores import BINS
from variantrank.operators.genes import split_fusion_genes
from variantrank.plans.pipeline import Cohort
from variantrank.profiles import CADD16, Profile

# Weights of the synthetic null tables and their common divisor.
MODEL_WEIGHT = {"het": 1000, "chet": 500, "hom": 100, "hem": 10}
ANCESTRY_WEIGHT = {GENERIC: 3, AFRICAN: 2, EUROPEAN: 1}
NULL_DIVISOR = 29421000.0


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _chr(k: Column) -> Column:
    g = k % 40
    return (
        F.when(g.between(5, 12), "chrX")
        .when(g.between(13, 14), "chrY")
        .otherwise(F.concat(F.lit("chr"), (1 + g % 22).cast("string")))
    )


def _start(k: Column) -> Column:
    return 1000 + 10 * k


def _ref(k: Column) -> Column:
    return F.when(k % 10 == 1, "-").otherwise("A")


def _alt(k: Column) -> Column:
    return F.when(k % 10 == 0, "-").when(k % 10 == 1, "T").otherwise("G")


def variant_of(k: Column) -> list[Column]:
    return [_chr(k).alias("chr"), _start(k).alias("start"), _ref(k).alias("ref"), _alt(k).alias("alt")]


def _gene(k: Column) -> Column:
    g = k % 40
    own = (
        F.when(g == 0, "HLA-A")
        .when(g == 1, "MUC1")
        .when(g == 2, "KRT5")
        .when(g == 3, "TRBV9")
        .otherwise(F.concat(F.lit("GENE"), g.cast("string")))
    )
    second = F.concat(F.lit(";GENE"), ((g + 1) % 40).cast("string"))
    return F.when(k % 17 == 0, F.concat(own, second)).otherwise(own)


def _ratio(numerator: Column, divisor: int) -> Column:
    return numerator.cast("double") / F.lit(float(divisor))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated sites with the frequency columns of every profile."""
    k = F.col("p_partkey")
    exonic = (
        F.when(k % 10 == 0, "frameshift deletion")
        .when(k % 10 == 1, "frameshift insertion")
        .when(k % 10 == 2, "nonframeshift deletion")
        .when(k % 3 == 0, "synonymous SNV")
        .otherwise("nonsynonymous SNV")
    )
    phred = F.when(k % 29 == 0, None).when(k % 31 == 0, -1.5).otherwise(_ratio((37 * k) % 700, 10))
    af = F.when(k % 5 != 0, _ratio(k % 100, 1000))
    return table(spark, sf_dir, "part").select(
        *variant_of(k),
        _start(k).alias("end"),
        F.when(k % 7 == 0, "splicing").when(k % 7 == 1, "intronic").otherwise("exonic").alias("func"),
        _gene(k).alias("gene"),
        F.col("p_type").alias("gene_detail"),
        F.when(k % 7 > 1, exonic).alias("exonic_func"),
        F.col("p_brand").alias("aa_change"),
        af.alias("af"),
        af.alias("af_afr"),
        af.alias("af_nfe"),
        af.alias("exac"),
        F.when(k % 13 != 0, _ratio(k % 11, 100)).alias("kg"),
        F.when(k % 11 != 0, _ratio(k % 9, 100)).alias("esp"),
        (phred / 10).alias("raw_score"),
        phred.alias("phred"),
        F.when(k % 6 == 0, "Benign").alias("clnsig"),
        F.col("p_name").alias("clndn"),
        k.alias("ord"),
    )


def genotype_text(k_line: str = "l_linenumber") -> Column:
    line = F.col(k_line)
    diploid = F.create_map(
        *[
            F.lit(x)
            for pair in (
                ("AF", "0/1"),
                ("AO", "1/1"),
                ("NF", "0|1"),
                ("NO", "0/0"),
                ("RF", "./."),
                ("RO", "1/2"),
            )
            for x in pair
        ]
    )
    gt = F.when(
        line == 7, F.when(F.col("l_linestatus") == "F", "1").otherwise(".")
    ).otherwise(F.try_element_at(diploid, F.concat("l_returnflag", "l_linestatus")))
    qty, row = F.col("l_quantity").cast("int"), line.cast("int")
    depths = F.concat(
        F.lit(":"), qty.cast("string"), F.lit(","), row.cast("string"), F.lit(":"), (qty + row).cast("string")
    )
    return F.when(F.col("l_discount") == 0, gt).otherwise(F.concat(gt, depths))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call per order line; the order keys of a line are its place in the source."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"),
        "l_orderkey",
    )
    tax = F.col("l_tax")
    return lines.select(
        F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("iid"),
        *variant_of(F.col("l_partkey")),
        F.when(tax >= 0.08, "LowQual").when(tax == 0, ".").otherwise("PASS").alias("filter"),
        genotype_text().alias("gt"),
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_shipdate",
        "l_suppkey",
    ).select(
        "iid",
        "chr",
        "start",
        "ref",
        "alt",
        "filter",
        "gt",
        F.struct(
            "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate", "l_suppkey", "gt"
        ).alias("ord"),
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their region and the pedigree codes of both forms."""
    c = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return customers.join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("F"), F.col("c_nationkey").cast("string")).alias("fam_id"),
        F.concat(F.lit("S"), c.cast("string")).alias("iid"),
        F.lit("0").alias("pat_id"),
        F.lit("0").alias("mat_id"),
        F.when(c % 20 == 0, 0).otherwise(1 + c % 2).cast("int").alias("sex"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), 2)
        .when(F.col("c_mktsegment") == "HOUSEHOLD", 0)
        .otherwise(1)
        .alias("status"),
        F.when(F.col("r_name") == "AFRICA", "AFR")
        .when(F.col("r_name") == "EUROPE", "EUR")
        .otherwise("OTH")
        .alias("label"),
        F.when(F.col("r_name") == "AFRICA", "2")
        .when(F.col("r_name") == "EUROPE", "3")
        .otherwise("1")
        .alias("code"),
    )


def pedigree(spark: SparkSession, sf_dir: str) -> DataFrame:

    return people(spark, sf_dir).withColumn("eth", ancestry_from_label(F.col("label"))).drop("label", "code")


def _genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_fusion_genes(sites(spark, sf_dir).select("gene")).select("gene").distinct()


def gene_number() -> Column:
    return F.coalesce(F.regexp_extract("gene", "([0-9]+)", 1).try_cast("int"), F.lit(0))


def lookup_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _genes(spark, sf_dir).filter("gene <> 'GENE4'")


def xy_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _genes(spark, sf_dir).filter(F.col("gene").startswith("GENE") & gene_number().between(5, 15))


def nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null rows for every listed gene but GENE20, falling with the score bin."""
    cells = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"),
                F.lit(e).alias("eth"),
                F.lit(MODEL_WEIGHT[m] * ANCESTRY_WEIGHT[e]).alias("weight"),
            )
            for m in MODEL_WEIGHT
            for e in ANCESTRIES
        ]
    )
    listed = lookup_genes(spark, sf_dir).filter("gene <> 'GENE20'")
    rows = listed.select("gene", (1 + gene_number() % 7).alias("scale"), F.explode(cells).alias("c"))
    p = F.transform(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        lambda k: ((F.lit(BINS - 1) - k) * F.col("c.weight") * F.col("scale")).cast("double")
        / F.lit(NULL_DIVISOR),
    )
    return rows.select("c.model", "c.eth", "gene", p.alias("p"))


def indels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indel scores as delivered: no contig prefix, anchored alleles, each row twice."""
    k = F.col("p_partkey")
    phred = _ratio((13 * k) % 600, 10)
    deletion = k % 10 == 0
    once = table(spark, sf_dir, "part").filter((k % 10).isin(0, 1) & (k % 3 == 0))
    return once.select(
        F.substring(_chr(k), 4, 2).alias("chr"),
        F.when(deletion, _start(k) - 1).otherwise(_start(k)).alias("start"),
        F.when(deletion, "TA").otherwise("A").alias("ref"),
        F.when(deletion, "T").otherwise("AT").alias("alt"),
        (phred / 10).alias("raw_score"),
        phred.alias("phred"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("_copy"),
    ).drop("_copy")


def genome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every order key, those of urgent orders listed again with a greater one."""
    k = F.col("o_orderkey")
    again = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit(0), F.lit(7))).otherwise(F.array(F.lit(0)))
    rows = table(spark, sf_dir, "orders").select(*variant_of(k), k.alias("k"), F.explode(again).alias("more"))
    phred = _ratio((11 * F.col("k")) % 600 + F.col("more"), 10)
    return rows.select("chr", "start", "ref", "alt", (phred / 10).alias("raw_score"), phred.alias("phred"))


CNV_SEGMENTS = {"del": ["BUILDING", "FURNITURE"], "dup": ["MACHINERY", "FURNITURE"]}


def _cnv(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One copy-number call for every customer of the market segments of its kind."""
    c = F.col("c_custkey")
    none = F.lit(None)
    number = none.cast("double")
    return table(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin(CNV_SEGMENTS[kind])).select(
        F.concat(F.lit("S"), c.cast("string")).alias("iid"),
        _chr(c).alias("chr"),
        (500000 + c).alias("start"),
        (500000 + c).alias("end"),
        F.lit("N").alias("ref"),
        F.lit("0").alias("alt"),
        F.concat(F.lit("GENE"), (c % 40).cast("string")).alias("gene"),
        F.lit("exonic").alias("func"),
        none.cast("string").alias("exonic_func"),
        none.cast("string").alias("aa_change"),
        none.cast("string").alias("gene_detail"),
        *[number.alias(n) for n in ("af", "af_afr", "af_nfe", "exac", "kg", "esp", "raw_score")],
        F.lit(30.0).alias("phred"),
        none.cast("string").alias("clnsig"),
        none.cast("string").alias("clndn"),
        none.cast("string").alias("filter"),
        (c % 7).cast("string").alias("alt_read"),
        (c % 11).cast("string").alias("total_read"),
        (c % 3).cast("string").alias("last_field"),
        c.alias("ord"),
    )


def cnv_dels(spark: SparkSession, sf_dir: str) -> DataFrame:

    return _cnv(spark, sf_dir, "del").withColumn("geno", cnv_genotype("del", F.col("last_field"))).drop("last_field")


def cnv_dups(spark: SparkSession, sf_dir: str) -> DataFrame:

    return _cnv(spark, sf_dir, "dup").withColumn("geno", cnv_genotype("dup")).drop("last_field")


def cohort(
    spark: SparkSession, sf_dir: str, with_indels: bool = False, with_cnv: bool = False
) -> Cohort:
    return Cohort(
        calls=calls(spark, sf_dir),
        sites=sites(spark, sf_dir),
        pedigree=pedigree(spark, sf_dir),
        xy_genes=xy_genes(spark, sf_dir),
        lookup_genes=lookup_genes(spark, sf_dir),
        nulls=nulls(spark, sf_dir),
        indels=indels(spark, sf_dir) if with_indels else None,
        cnv_dels=cnv_dels(spark, sf_dir) if with_cnv else None,
        cnv_dups=cnv_dups(spark, sf_dir) if with_cnv else None,
    )


# Text forms, for the readers.


def _text(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("NA"))


def _lines(df: DataFrame, ord_column: str = "ord") -> DataFrame:
    return df.select("value", F.lit("cohort").alias("file"), F.col(ord_column).alias("ord"))


def annotation_header(profile: Profile) -> list[str]:
    return [n for _, n in profile.annotation_columns] + ["Otherinfo1", "Otherinfo2"]


def annotation_lines(spark: SparkSession, sf_dir: str, profile: Profile = CADD16) -> DataFrame:
    """Annotated-site text with two trailing columns; every 41st score is junk."""
    rows = sites(spark, sf_dir)
    score = F.when(F.col("ord") % 41 == 0, ".").otherwise(_text("phred"))
    columns = [score if c == "phred" else _text(c) for c, _ in profile.annotation_columns]
    return _lines(rows.withColumn("value", F.concat_ws("\t", *columns, F.lit("het"), F.lit("9"))))


def call_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = calls(spark, sf_dir)
    columns = [
        _text("chr"),
        _text("start"),
        _text("start"),
        _text("ref"),
        _text("alt"),
        *[F.lit(x) for x in ("c", "s", "rs", "r", "a", "50")],
        _text("filter"),
        F.lit("AC=1"),
        F.lit("GT:AD:DP"),
        _text("gt"),
    ]
    return rows.select(
        F.concat_ws("\t", *columns).alias("value"), F.lit("cohort").alias("file"), "ord", "iid"
    )


def pedigree_lines(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    rows = people(spark, sf_dir)
    first = [_text(c) for c in ("fam_id", "iid", "pat_id", "mat_id", "sex", "status")]
    if form == "readme":
        value = F.concat_ws(" ", *first[:2], F.concat(F.lit(" "), first[2]), *first[3:], _text("code"))
    else:
        value = F.concat_ws("\t", *first, *[F.lit("x")] * 6, _text("label"))
    return _lines(rows.withColumn("value", value).withColumn("ord", F.col("iid")))


def gene_list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sites(spark, sf_dir)
    return _lines(rows.withColumn("value", F.concat(F.lit(" "), F.translate("gene", ";", "\t"))))


def null_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nulls(spark, sf_dir)
    cells = F.array_join(F.transform("p", lambda x: x.cast("string")), " ")
    return rows.select(F.concat_ws(" ", "gene", cells).alias("value"), "model", "eth")


INDEL_HEADER = ["#Chrom", "Pos", "Ref", "Alt", "RawScore", "PHRED"]


def indel_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [_text(c) for c in ("chr", "start", "ref", "alt", "raw_score", "phred")]
    return _lines(
        indels(spark, sf_dir).withColumn("value", F.concat_ws("\t", *columns)), "start"
    )


def cnv_header(profile: Profile = CADD16) -> list[str]:
    return [n for _, n in profile.annotation_columns] + ["Otherinfo"]


def cnv_lines(spark: SparkSession, sf_dir: str, kind: str, profile: Profile = CADD16) -> DataFrame:
    """Copy-number text; deletions have one surplus field that holds the copy number."""
    rows = _cnv(spark, sf_dir, kind)
    annotated = [_text(c) for c, _ in profile.annotation_columns]
    added = [F.lit(kind.upper()), *([F.lit("r1")] if kind == "del" else []), F.lit("i"), F.lit("q"), F.lit("9")]
    surplus = [_text("last_field")] if kind == "del" else []
    value = F.concat_ws("\t", *annotated, _text("iid"), *added, _text("alt_read"), _text("total_read"), *surplus)
    return _lines(rows.withColumn("value", value))


def vcf_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head of the VCF: its version and the column names, one sample per nation."""
    names = table(spark, sf_dir, "nation").agg(F.sort_array(F.collect_set("n_nationkey")).alias("samples"))
    listed = names.select(F.array_join(F.transform("samples", lambda n: F.concat(F.lit("N"), n.cast("string"))), "\t").alias("names"))
    fixed = "\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT".split())
    return listed.select(
        F.explode(F.array(F.lit("##fileformat=VCFv4.2"), F.concat(F.lit(fixed + "\t"), "names"))).alias("value"),
        F.lit("cohort").alias("file"),
        F.lit(-1).cast("long").alias("ord"),
    )


def vcf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A VCF with one sample per supplier nation.

    A sample's genotype at a site is the least of the texts its order lines hold.
    """
    k = F.col("p_partkey")
    nation = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    lines = table(spark, sf_dir, "lineitem").join(nation, "l_suppkey")
    lines = lines.withColumn("gt", genotype_text())
    names = table(spark, sf_dir, "nation").agg(F.sort_array(F.collect_set("n_nationkey")).alias("samples"))
    own = lines.groupBy(F.col("l_partkey").alias("p_partkey"), "s_nationkey").agg(F.min("gt").alias("gt"))
    wide = own.groupBy("p_partkey").agg(F.map_from_entries(F.collect_list(F.struct("s_nationkey", "gt"))).alias("gts"))
    rows = table(spark, sf_dir, "part").select("p_partkey").join(wide, "p_partkey", "left").join(F.broadcast(names))
    genotypes = F.transform("samples", lambda n: F.coalesce(F.element_at("gts", n), F.lit("./.")))
    body = rows.select(
        F.concat_ws(
            "\t",
            _chr(k),
            F.when(k % 10 == 0, _start(k) - 1).otherwise(_start(k)).cast("string"),
            F.lit("."),
            F.when(k % 10 == 0, "TA").otherwise("A"),
            F.when(k % 10 == 0, "T").when(k % 10 == 1, "AT").when(k % 23 == 0, "G,C").otherwise("G"),
            F.lit("50"),
            F.lit("PASS"),
            F.concat(F.lit("AN=50;AC="), (k % 7).cast("string"), F.lit(";DB")),
            F.lit("GT:AD:DP"),
            F.array_join(genotypes, "\t"),
        ).alias("value"),
        F.lit("cohort").alias("file"),
        k.alias("ord"),
    )
    return vcf_header(spark, sf_dir).unionByName(body)


CONTIGS = [f"chr{i}" for i in [*range(1, 23), "X", "Y"]]
#: Site numbers of one text file of a contig.
SITES_PER_FILE = 1 << 17


def write_vcf(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The VCF as text files, one per contig and range of sites, each with the head."""
    part = F.coalesce(F.floor(F.col("ord") / SITES_PER_FILE), F.lit(0)).cast("long").alias("part")
    body = vcf_lines(spark, sf_dir).filter(~F.col("value").startswith("#"))
    body = body.select("value", "ord", F.substring_index("value", "\t", 1).alias("contig"), part)
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord")).select(part).distinct()
    files = parts.union(spark.range(1)).distinct().select("part", F.explode(F.array(*map(F.lit, CONTIGS))).alias("contig"))
    head = vcf_header(spark, sf_dir).select("value", "ord").crossJoin(files).select(*body.columns)
    lines = head.unionByName(body).repartition("contig", "part").sortWithinPartitions("contig", "part", "ord", "value")
    lines.select("value", "contig", "part").write.partitionBy("contig", "part").text(path)


def nation_pedigree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of the VCF as people: nations, by region."""
    n = F.col("n_nationkey")
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    label = F.when(F.col("r_name") == "AFRICA", "AFR").when(F.col("r_name") == "EUROPE", "EUR").otherwise("OTH")
    return nations.select(
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("fam_id"),
        F.concat(F.lit("N"), n.cast("string")).alias("iid"),
        F.lit("0").alias("pat_id"),
        F.lit("0").alias("mat_id"),
        (1 + n % 2).cast("int").alias("sex"),
        (1 + n % 3 % 2).cast("int").alias("status"),
        ancestry_from_label(label).alias("eth"),
    )
