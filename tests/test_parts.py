"""Expressions, joins, readers and writers one by one."""

import bisect
import math
import re

import pytest
from pyspark.sql import functions as F

import mini
from variantrank.functions import genotypes as g
from variantrank.functions.scores import BIN_WIDTH, BINS, bin_index, clamped
from variantrank.functions.variants import has_alternate, info_keep, variant_key
from variantrank.operators import joins
from variantrank.operators.calls import attach_annotations, read_depths
from variantrank.operators.genes import first_site, split_fusion_genes
from variantrank.operators.indels import harmonize_contigs, has_dashes, left_trim
from variantrank.operators.nulls import null_lookup, repeated_null_rows
from variantrank.plans.pipeline import Options, Run
from variantrank.profiles import CADD13_V14, CADD16
from variantrank.sinks import reports
from variantrank.sources import contracts, ingest, tables, vcf
from variantrank.sources.lines import read_lines


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_score_bin_next_to_breakpoints(spark):
    grid = [k * BIN_WIDTH for k in range(BINS)]
    values = [
        v for b in grid for v in (math.nextafter(b, -1), b, math.nextafter(b, 2)) if 0 <= v <= 1
    ] + [1.0]
    rows = one_column(spark, values, "double").select("x", bin_index(F.col("x")).alias("k")).collect()
    assert all(r["k"] == bisect.bisect_right(grid, r["x"]) - 1 for r in rows)


def test_clamp_keeps_null(spark):
    rows = one_column(spark, ["12.5", ".", "NA", "-1.5", "62", "70", None])
    got = [r[0] for r in rows.select(clamped(F.col("x").try_cast("double"))).collect()]
    assert got == [12.5, None, None, 0.0, 62.0, 62.0, None]


def test_genotype_class(spark):
    cases = {
        ".": ("miss", "miss"), "./.": ("miss", "miss"), "1": ("het", "hom"), "0": ("het", "ref"),
        "0|0": ("ref", "ref"), "10/1": ("het", "het"), "0/1": ("het", "het"), "1/1": ("hom", "hom"),
        "1/2:3": ("het", "het"), None: (None, None),
    }
    gt = F.col("x")
    rows = one_column(spark, list(cases)).select("x", g.genotype_class(gt), g.genotype_class(gt, True))
    assert {r[0]: (r[1], r[2]) for r in rows.collect()} == cases


def test_read_depths(spark):
    cases = {
        "0/1:10,8:18": ("8", "18"), "0/1": (None, None), "0/1:5:": (None, None),
        "0/1:5,:9": (None, "9"), "0/1:5,3::9": ("3", ""), None: (None, None),
    }
    rows = read_depths(one_column(spark, list(cases)).withColumnRenamed("x", "gt"))
    assert {r["gt"]: (r["alt_read"], r["total_read"]) for r in rows.collect()} == cases


def test_sex_rules(spark):
    rows = [(s, xy, c, geno) for s in (1, 2) for xy in (True, False) for c in ("chrX", "chrY")
            for geno in ("het", "hom", "ref", "miss", None)]
    df = spark.createDataFrame(rows, "sex int, is_xy boolean, chr string, geno string")
    args = F.col("geno"), F.col("sex"), F.col("is_xy"), F.col("chr")
    for r in df.select("*", g.sex_adjusted(*args).alias("a"), g.cnv_sex_adjusted(*args).alias("b")).collect():
        if r["sex"] == 1:
            male = {"hom": "hem", "het": "ref"} if r["is_xy"] else {}
            assert r["a"] == male.get(r["geno"], r["geno"])
            assert r["b"] == ("hem" if r["is_xy"] else r["geno"])
        else:
            female = {"hom": "hom_female", "het": "het_female"} if r["is_xy"] else {}
            assert r["a"] == r["b"] == ("ref" if r["chr"] == "chrY" else female.get(r["geno"], r["geno"]))


def test_variant_text(spark):
    df = spark.createDataFrame([("1", 5, "A", None)], "chr string, start long, ref string, alt string")
    assert df.select(variant_key()).first()[0] == "1:5_A>NA"
    info = one_column(spark, ["AN=2;AC=1;DB", "DB", "AC=1,2", None, "XAC=4"])
    assert [r[0] for r in info.select(info_keep(F.col("x"), "AC")).collect()] == ["AC=1", ".", "AC=1,2", None, "."]
    gts = one_column(spark, ["0/1", "0|0:1,2", "./.", "./2", ".", None, "10|0"])
    assert [r[0] for r in gts.select(has_alternate(F.col("x"))).collect()] == [
        True, False, False, True, False, False, True]


def test_contigs_and_trimming(spark):
    raw = mini.indels(spark)
    variants = mini.sites(spark).select("chr")
    bare = variants.withColumn("chr", F.substring("chr", 4, 2))
    prefixed = raw.withColumn("chr", F.lit("chr5"))
    for table, other, expected in (
        (raw, variants, "chr5"), (raw, bare, "5"), (prefixed, variants, "chr5"), (prefixed, bare, "chr5")
    ):
        assert harmonize_contigs(table, other).first()["chr"] == expected
    trimmed = left_trim(raw)
    assert tuple(trimmed.select("start", "ref", "alt").first()) == (10, "A", "-")
    again = left_trim(trimmed, has_dashes(trimmed))
    assert tuple(again.select("start", "ref", "alt").first()) == (10, "A", "-")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_paths_agree_on_a_hot_key(spark, how):
    big = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("row")
    )
    small = spark.range(-1, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = big.join(small, "k", how)
    for limit in (0, joins.MAX_BROADCAST_BYTES):
        other = joins.lookup_join(big, small, ["k"], how, max_bytes=limit)
        assert other.exceptAll(plain).isEmpty() and plain.exceptAll(other).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_files_that_look_small_are_measured(spark, tmp_path, how):
    """Spark would broadcast these ids, whose file is small; a table that measures too much is never broadcast."""
    wide = spark.range(2000).select(F.concat(F.lit("S"), "id").alias("k"), *[F.lit("").alias(f"c{i}") for i in range(9)])
    wide.write.parquet(str(tmp_path / "wide"))
    ids = spark.read.parquet(str(tmp_path / "wide")).groupBy("k").agg(F.max("c0").alias("v"))
    big = spark.range(5000).select(F.concat(F.lit("S"), F.col("id") % 3000).alias("k"), "id")
    plain = big.join(ids, "k", how)
    assert "BroadcastHashJoin" in plain._jdf.queryExecution().executedPlan().toString()
    joined = joins.lookup_join(big, ids, ["k"], how, max_bytes=1000)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_run_without_any_broadcast(spark, monkeypatch):
    expected = Run(mini.cohort(spark)).ranked().drop("fam_id").collect()
    monkeypatch.setattr(joins, "data_bytes", lambda df: 1 << 40)
    monkeypatch.setattr("variantrank.plans.pipeline.data_bytes", lambda df: 1 << 40)
    monkeypatch.setattr("variantrank.plans.pipeline.table_bytes", lambda df: 1 << 40)
    shuffled = Run(mini.cohort(spark)).ranked().drop("fam_id").collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, expected))


def test_plan_shape(spark):
    ranked = Run(mini.cohort(spark)).ranked()
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Both windows over calls cut their groups before the shuffle.
    assert len(re.findall(r"WindowGroupLimit \[iid.*Partial", plan)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\(iid", plan)) <= 3


def test_generated_code_stays_compilable(spark):
    """The JVM never compiles a method of more than 8000 bytes of byte code."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        run = Run(mini.cohort(spark))
        for frame in (run.ranked(), run.dropped()):
            plan = frame._jdf.queryExecution().executedPlan()
            stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
            for i in range(stages.size()):
                largest = int(re.search(r"\((\d+)", stages.apply(i)._3().toString()).group(1))
                assert largest < 8000
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
        spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_narrow_null_cells(spark, tmp_path):
    """A run on the narrow table gives the rows of a run on the null rows; a repeated null row stops the conversion."""
    cohort = mini.cohort(spark)
    tables.write_null_cells(cohort.nulls, str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    assert cells.count() == BINS * cohort.nulls.select("gene").distinct().count()
    for small in (0, 1 << 40):
        rows = Run(mini.cohort(spark, nulls=cells)).ranked()
        assert rows.exceptAll(Run(cohort).ranked()).isEmpty() and rows.count() == 17
        sites = spark.createDataFrame([("I", "G1", "AFR", 0.5), ("I", "NONE", "NFE", 0.5), ("I", "G1", "ALL", None)], "iid string, gene string, eth string, score_norm double")
        one, two = (null_lookup(sites, table, "chet", max_bytes=small).select(*sites.columns, "prob") for table in (cells, cohort.nulls))
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    with pytest.raises(Exception, match="more than once"):
        tables.write_null_cells(cohort.nulls.union(cohort.nulls.limit(1)), str(tmp_path / "twice"))


def test_stored_calls_join_without_a_shuffle(spark, tmp_path):
    calls, sites = mini.calls(spark), first_site(split_fusion_genes(mini.sites(spark))).drop("ord")
    paths = str(tmp_path / "calls"), str(tmp_path / "sites")
    try:
        ingest.store(calls, "stored_calls", paths[0], 4)
        ingest.store(sites, "stored_sites", paths[1], 4)
        for name in ("stored_calls", "stored_sites"):
            spark.sql(f"DROP TABLE {name}")
        kept = [ingest.stored(spark, f"stored_{n}", p, 4) for n, p in zip(("calls", "sites"), paths)]
        joined = attach_annotations(*kept, small_bytes=1 << 40)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan
        assert joined.exceptAll(attach_annotations(calls, sites)).isEmpty() and joined.count() == attach_annotations(calls, sites).count()
    finally:
        for name in ("stored_calls", "stored_sites"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_buckets_grow_with_the_calls():
    assert [ingest.buckets_for(n) for n in (0, 5_000_000, 36_000_000, 216_000_001)] == [8, 8, 36, 217]


def test_repeated_null_rows(spark):
    nulls = mini.nulls(spark, ["G1"])
    assert repeated_null_rows(nulls).isEmpty()
    assert repeated_null_rows(nulls.union(nulls)).count() == 12


def _write(path, text):
    path.write_text(text)
    return str(path)


VCF_TEXT = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tP1\tP2
chr1\t100\t.\tA\tG,C\t50\tPASS\tAC=1;AN=4\tGT\t0/1\t1|2
chr1\t200\t.\tTA\tT\t50\tPASS\tAN=4\tGT\t./.\t0/1
chr1\t300\t.\tA\tAT\t50\tPASS\tAC=0\tGT\t0/0\t0/0
chr1\t400\t.\tAT\tGC\t50\tPASS\tAC=2\tGT\t1\t.
"""


def test_vcf(spark, tmp_path):
    found = vcf.read_vcf(spark, _write(tmp_path / "x.vcf", VCF_TEXT))
    assert [(r["iid"], r["sample_pos"]) for r in found.samples.collect()] == [("P1", 0), ("P2", 1)]
    variants = {tuple(r) for r in found.sites.select("chr", "start", "end", "ref", "alt").collect()}
    assert variants == {
        ("chr1", 100, 100, "A", "G"), ("chr1", 100, 100, "A", "C"), ("chr1", 201, 201, "A", "-"),
        ("chr1", 300, 300, "-", "T"), ("chr1", 400, 401, "AT", "GC"),
    }
    calls = sorted(tuple(r) for r in found.calls.select("iid", "start", "alt", "info", "gt").collect())
    assert calls == [
        ("P1", 100, "G", "AC=1", "0/1"), ("P1", 400, "GC", "AC=2", "1"),
        ("P2", 100, "C", "AC=1", "1|2"), ("P2", 100, "G", "AC=1", "1|2"), ("P2", 201, "-", ".", "0/1"),
    ]
    people = spark.createDataFrame([("P1",), ("P7",)], "iid string")
    assert [r["iid"] for r in contracts.samples_not_in_vcf(people, found.samples).collect()] == ["P7"]


def test_lines_keep_their_order(spark, tmp_path):
    path = _write(tmp_path / "x.txt", "\n".join(f"{i:06d} some text to fill the line" for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        lines = read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 4
        values = [r["value"] for r in lines.repartition(5).orderBy("ord").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert values == sorted(values)


def test_annotations_and_calls(spark, tmp_path):
    for profile in (CADD16, CADD16.with_build("hg19"), CADD13_V14):
        names = [n for _, n in profile.annotation_columns]
        row = {n: "NA" for n in names} | {"Chr": "1", "Start": "5", "Ref": "T", "Alt": "T"}
        row |= {dict(profile.gene_columns)["gene"]: "G1;G2", profile.score_column: "."}
        text = "\t".join(["x", *names]) + "\n" + "\t".join(["#1", *row.values()]) + "\n"
        path = _write(tmp_path / f"{profile.name}{profile.build}.txt", text)
        found = tables.read_annotations(spark, path, profile).first()
        assert (found["chr"], found["start"], found["ref"], found["gene"]) == ("1", 5, "T", "G1;G2")
        assert found["phred"] is None and found["func"] is None
    with pytest.raises(ValueError, match="lack columns"):
        tables.parse_annotations(read_lines(spark, path), ["Chr"], CADD16)
    fields = "1 7 7 A G c s rs r a 50 PASS AC=1 GT:AD 0/1:3,4".split()
    calls = tables.read_calls(spark, _write(tmp_path / "P1.avinput", "\t".join(fields) + "\n"))
    row = tables.prune_calls(calls).first()
    assert (row["iid"], row["start"], row["filter"], row["gt"]) == ("P1", 7, "PASS", "0/1:3,4")


def test_small_tables(spark, tmp_path):
    ped = tables.read_pedigree(spark, _write(tmp_path / "a.ped", "F1 P1 0  0 1 2 2\n F1 P2 0 0 2 1 3\n\nF1 P3 0 0 x 1 1\n"))
    assert [(r["iid"], r["sex"], r["eth"]) for r in ped.collect()] == [
        ("P1", 1, "AFR"), ("P2", 2, "NFE"), ("P3", None, "ALL")]
    wide = "\n".join(["\t".join(f"V{i}" for i in range(1, 14)), "\t".join(["F", "P1", "0", "0", "1", "2", *"abcdef", "EUR"])])
    ped = tables.read_pedigree(spark, _write(tmp_path / "b.ped", wide), "wide", header=True)
    assert [(r["iid"], r["status"], r["eth"]) for r in ped.collect()] == [("P1", 2, "NFE")]
    names = tables.read_gene_list(spark, _write(tmp_path / "g.txt", "A B\tC\n A\n\n"))
    assert sorted(r["gene"] for r in names.collect()) == ["A", "B", "C"]
    null_path = _write(tmp_path / "n.txt", "G1 " + " ".join(str(i / 10) for i in range(BINS)) + "\n")
    nulls = tables.read_null_tables(spark, {("het", "AFR"): null_path, ("hom", "ALL"): null_path})
    tables.write_null_tables(nulls, str(tmp_path / "nulls"))
    back = spark.read.parquet(str(tmp_path / "nulls")).filter("model = 'het' and eth = 'AFR'").first()
    assert back["gene"] == "G1" and len(back["p"]) == BINS and back["p"][3] == 0.3
    indels = "## made elsewhere\n#Chrom\tPos\tRef\tAlt\tRawScore\tPHRED\n5\t9\tTA\tT\t3.3\t33\n"
    row = tables.read_indel_scores(spark, _write(tmp_path / "i.tsv", indels)).first()
    assert tuple(row) == ("5", 9, "TA", "T", 3.3, 33.0)
    with pytest.raises(ValueError, match="must start with"):
        tables.read_indel_scores(spark, _write(tmp_path / "j.tsv", "#Chrom\tRef\tPos\n"))
    header = [n for _, n in CADD16.annotation_columns] + ["Otherinfo"]
    base = ["9", "5", "6", "N", "0"] + ["NA"] * (len(header) - 6) + ["P1"]
    lines = ["\t".join(header)] + ["\t".join(base + ["DEL", "r", "i", "f", "q", "1", "2", n]) for n in ("0", "1", "")]
    cnv = tables.read_cnv(spark, _write(tmp_path / "d.txt", "\n".join(lines)), "del", CADD16)
    assert [(r["iid"], r["geno"], r["total_read"]) for r in cnv.collect()] == [
        ("P1", "hom", "2"), ("P1", "het", "2"), ("P1", "het", "2")]
    wanted = spark.createDataFrame([(s,) for s in CADD16.sources], "source string")
    with pytest.raises(ValueError, match="clinvar"):
        contracts.require_sources(wanted, wanted.filter("source <> 'clinvar'"))


def test_reports(spark, tmp_path):
    run = Run(mini.cohort(spark), options=Options(unique_calls=True))
    ranked = run.ranked()
    reports.write_tsv(ranked, str(tmp_path / "tsv"), CADD16)
    folder = tmp_path / "tsv" / "report=F1_P1_PSAP.txt"
    (part,) = list(folder.glob("part-*"))
    lines = part.read_text().rstrip("\n").split("\n")
    header = lines[0].split("\t")
    assert header == [n for _, n in CADD16.ranked_columns]
    rows = [dict(zip(header, line.split("\t"))) for line in lines[1:]]
    assert len(rows) == 12 and rows[-1]["Dz.Model"] == "NA"
    order = [r["Dz.Model"] for r in rows if r["Dz.Model"] != "NA"]
    assert order == sorted(order)
    assert {r["PSAP"] for r in rows if r["Gene.wgEncodeGencodeBasicV35"] == "NOTBL"} == {"NA"}
    reports.write_tsv(run.dropped(), str(tmp_path / "lost"), CADD16, "dropped")
    assert (tmp_path / "lost" / "report=F1_P1_missing_data.txt").is_dir()
    path = str(tmp_path / "parquet")
    reports.write_parquet(ranked, path)
    reports.write_parquet(ranked.filter("iid = 'P2'"), path)
    assert spark.read.parquet(path).count() == 17
    reports.write_done(run.people.filter("iid = 'P1'"), str(tmp_path / "done"))
    done = spark.read.parquet(str(tmp_path / "done"))
    assert [r["iid"] for r in reports.pending_people(mini.pedigree(spark), done).collect()] == ["P2"]
