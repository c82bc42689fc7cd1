"""Nothing is lost or misread without a word: writers, readers, contracts and alleles."""

import gzip
import re

import pytest
from pyspark.sql import functions as F

import mini
from variantrank.functions.scores import BINS
from variantrank.operators import joins
from variantrank.operators.calls import rejected_people
from variantrank.operators.nulls import null_lookup
from variantrank.operators.sites import annotate_scores
from variantrank.plans.pipeline import Run
from variantrank.profiles import CADD16
from variantrank.sinks import reports
from variantrank.sources import tables, vcf


@pytest.fixture(scope="module")
def ranked(spark):
    return Run(mini.cohort(spark)).ranked().cache()


def people(spark, *ids):
    return spark.createDataFrame([("F1" if i == "P1" else "F2", i) for i in ids], "fam_id string, iid string")


def test_text_reports_replace_only_their_people(spark, ranked, tmp_path):
    path = str(tmp_path / "tsv")
    one, two = ranked.filter("iid = 'P1'"), ranked.filter("iid = 'P2'")
    named = {r[0] for r in ranked.select(reports.report_name("ranked")).distinct().collect()}
    reports.write_tsv(one, path, CADD16, people=people(spark, "P1"))
    reports.write_tsv(two, path, CADD16)
    assert {f"report={n}" for n in named} == {p.name for p in (tmp_path / "tsv").iterdir() if p.is_dir()}
    own = ranked.select("fam_id", "iid").distinct()
    reports.write_tsv(two, path, CADD16, people=own)
    assert {p.name for p in (tmp_path / "tsv").iterdir() if p.is_dir()} == {f"report={n}" for n in named if "P2" in n}


def test_parquet_reports(spark, ranked, tmp_path):
    path = str(tmp_path / "parquet")
    odd = ranked.withColumn("iid", F.when(F.col("iid") == "P1", "001").otherwise("a=b %/c"))
    own = odd.select("fam_id", "iid").distinct()
    reports.write_parquet(odd, path, people=own)
    back = spark.read.parquet(path)
    assert dict(back.dtypes)["iid"] == "string"
    assert {r["iid"] for r in back.select("iid").collect()} == {"001", "a=b %/c"}
    reports.write_parquet(odd.filter("iid = '001'"), path, people=own)
    assert {r["iid"] for r in spark.read.parquet(path).select("iid").collect()} == {"001"}


def vcf_file(tmp_path, gts):
    head = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *[f"S{i}" for i in range(len(gts))]])
    line = "\t".join(["chr1", "100", ".", "A", "G,C", "50", "PASS", "AC=1", "GT:DP", *[f"{g}:9" for g in gts]])
    (tmp_path / "x.vcf").write_text(f"##fileformat=VCFv4.2\n{head}\n{line}\n")
    return str(tmp_path / "x.vcf")


def test_only_named_alleles_are_called(spark, tmp_path):
    path = vcf_file(tmp_path, ["0/1", "1/2", "2/2", "0|2", "./.", "0/0", "2"])
    got = {(r["iid"], r["alt"]) for r in vcf.read_vcf(spark, path).calls.collect()}
    assert got == {("S0", "G"), ("S1", "G"), ("S1", "C"), ("S2", "C"), ("S3", "C"), ("S6", "C")}
    first = vcf.read_vcf(spark, path, first_alt_only=True).calls.collect()
    assert {r["alt"] for r in first} == {"G"} and len(first) == 5


def test_tenth_allele(spark):
    rows = [("S", "chr1", 5, ".", "A", ",".join(["C", "G", "T"] + ["A" * k + "C" for k in range(2, 10)]), "0/11", 1)]
    calls = vcf.vcf_to_variant(spark.createDataFrame(rows, "iid string, chrom string, pos long, vcf_id string, ref string, alt string, gt string, ord long"))
    assert [r["alt"] for r in calls.collect()] == ["A" * 8 + "C"]


def annotated(columns, value):
    return "\t".join(columns) + "\n" + "\t".join(value.get(c, "NA") for c in columns) + "\n"


def test_files_with_headers_of_their_own(spark, tmp_path):
    """Each file is read by its own header, whatever the order of its columns and its name; empty files hold nothing."""
    columns = [n for _, n in CADD16.annotation_columns]
    (tmp_path / "a").mkdir()
    orders = {"1.txt": columns, "2 b%+.txt": columns, "3[x].txt": columns[::-1], "4.txt": ["more", *columns[3:], *columns[:3]]}
    for i, (name, order) in enumerate(orders.items()):
        value = {columns[0]: "chr1", columns[1]: str(i), CADD16.score_column: f"{i}.5", "more": "x"}
        (tmp_path / "a" / name).write_text(annotated(order, value))
    (tmp_path / "a" / "0.txt").write_text("")
    found = tables.read_annotations(spark, str(tmp_path / "a"), CADD16).collect()
    assert sorted((r["start"], r["phred"], r["chr"], r["gene"]) for r in found) == [(i, i + 0.5, "chr1", None) for i in range(4)]
    (tmp_path / "a" / "5.txt").write_text("other\tcolumns\n1\t2\n")
    with pytest.raises(ValueError, match="lack columns"):
        tables.read_annotations(spark, str(tmp_path / "a"), CADD16)
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "0.txt").write_text("")
    with pytest.raises(ValueError, match="no header"):
        tables.read_annotations(spark, str(tmp_path / "none"), CADD16)


def test_pedigrees_with_headers(spark, tmp_path):
    for name, head, person in (("a.ped", "FAM ID PAT MAT SEX STATUS ANC", "P1"), ("b.ped", "fam iid pat mat sex st eth", "P2"), ("c.ped", "", "")):
        (tmp_path / name).write_text(f"{head}\nF1 {person} 0 0 1 2 2\n" if head else "")
    found = tables.read_pedigree(spark, str(tmp_path), header=True)
    assert sorted(r["iid"] for r in found.collect()) == ["P1", "P2"]


def test_indel_scores_of_several_forms(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("## made elsewhere\n" * 9000 + "#Chrom\tPos\tRef\tAlt\tRawScore\tPHRED\n5\t9\tTA\tT\t3.3\t33\n")
    with gzip.open(tmp_path / "b.tsv.gz", "wt") as out:
        out.write("#Chrom\tPos\tRef\tPHRED\tAlt\tRawScore\n5\t10\tTA\t34\tT\t3.4\n")
    found = tables.read_indel_scores(spark, str(tmp_path)).collect()
    assert sorted((r["start"], r["raw_score"], r["phred"], r["alt"]) for r in found) == [(9, 3.3, 33.0, "T"), (10, 3.4, 34.0, "T")]
    (tmp_path / "c.tsv").write_text("5\t9\tTA\tT\t3.3\t33\n")
    for path in (tmp_path, tmp_path / "c.tsv"):
        with pytest.raises(ValueError, match="no header"):
            tables.read_indel_scores(spark, str(path))


def test_vcfs_with_samples_of_their_own(spark, tmp_path):
    """Names come from the heads of the files; the body is read once for the calls."""
    fixed = "#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT".split()
    for i, (name, people) in enumerate({"a b%.vcf": ["P1", "P2"], "b.vcf": ["P3"], "c.vcf": []}.items()):
        line = ["chr1", str(100 + i), ".", "A", "G", "50", "PASS", "AC=1", *["GT", *["0/1"] * len(people)][: 1 + len(people)]]
        text = "##fileformat=VCFv4.2\n" + "##contig=<ID=chr1>\n" * 5000 + "\t".join(fixed + people) + "\n" + "\t".join(line) + "\n"
        (tmp_path / name).write_text(text)
    (tmp_path / "empty.vcf").write_text("")
    found = vcf.read_vcf(spark, str(tmp_path))
    assert sorted((r["iid"], r["start"]) for r in found.calls.collect()) == [("P1", 100), ("P2", 100), ("P3", 102 - 1)]
    assert sorted((r["iid"], r["sample_pos"]) for r in found.samples.collect()) == [("P1", 0), ("P2", 1), ("P3", 0)]
    assert found.sites.count() == 3
    assert len(re.findall(r"Relation \[value", found.calls._jdf.queryExecution().optimizedPlan().toString())) == 1


def test_person_of_an_odd_file_name(spark, tmp_path):
    for name in ("S 1%a.avinput", "S+2.avinput"):
        (tmp_path / name).write_text("\t".join(["chr1", "5", "5", "A", "G"] + ["x"] * 10) + "\n")
    assert {r["iid"] for r in tables.read_calls(spark, str(tmp_path)).collect()} == {"S 1%a", "S+2"}


def test_null_rows_are_whole_and_unique(spark, tmp_path):
    (tmp_path / "n.txt").write_text("G1 " + " ".join(["0.5"] * (BINS + 1)) + "\n")
    with pytest.raises(Exception, match="fields"):
        tables.read_null_tables(spark, {("het", "ALL"): str(tmp_path / "n.txt")}).collect()
    nulls = spark.createDataFrame([("het", "ALL", "G1", [0.5]), ("het", "ALL", "G1", [0.6])], "model string, eth string, gene string, p array<double>")
    rows = spark.createDataFrame([("I", "chr1", 1, "A", "G", "ALL", "G1", 0.0)], "iid string, chr string, start long, ref string, alt string, eth string, gene string, score_norm double")
    with pytest.raises(Exception, match="more than once"):
        null_lookup(rows, nulls, "het").collect()
    cohort = mini.cohort(spark)
    twice = mini.Cohort(**{**cohort.__dict__, "nulls": cohort.nulls.union(cohort.nulls.limit(1))})
    with pytest.raises(Exception, match="more than once"):
        Run(twice).ranked().collect()


def test_repeated_scores_do_not_multiply_sites(spark):
    sites = spark.createDataFrame([("chr1", 1, "A", "G")], "chr string, start long, ref string, alt string")
    scores = spark.createDataFrame([("chr1", 1, "A", "G", 0.2, 3.0), ("chr1", 1, "A", "G", 0.1, 2.0)], "chr string, start long, ref string, alt string, raw_score double, phred double")
    assert [r["phred"] for r in annotate_scores(sites, scores).collect()] == [2.0]


def test_contracts_of_a_run(spark):
    pedigree = spark.createDataFrame([("A", 1), ("B", 0), ("C", 1), ("C", 1), ("D", 2)], "iid string, sex int")
    calls = spark.createDataFrame([("A",), ("E",)], "iid string")
    samples = spark.createDataFrame([("A",), ("E",)], "iid string")
    got = {tuple(r) for r in rejected_people(pedigree, calls, samples).collect()}
    assert got == {("B", "sex"), ("C", "duplicate"), ("D", "not_in_vcf"), ("E", "missing")}
    need = spark.createDataFrame([(f"s{i}",) for i in range(30)], "source string")
    cohort = mini.Cohort(**{**mini.cohort(spark).__dict__, "required_sources": need, "sources": need.filter("source = 's3'")})
    with pytest.raises(ValueError) as stop:
        Run(cohort)
    assert all(f"'s{i}'" in str(stop.value) for i in range(30) if i != 3)


def test_planning_runs_nothing_over_the_ranking(spark, monkeypatch):
    """With sites too large to broadcast, building the plan starts no job that joins."""
    monkeypatch.setattr("variantrank.plans.pipeline.data_bytes", lambda df: 1 << 40)
    run = Run(mini.cohort(spark))
    monkeypatch.setattr(joins, "data_bytes", lambda df: pytest.fail("a measure of derived rows"))
    assert run.ranked().count() == 17
