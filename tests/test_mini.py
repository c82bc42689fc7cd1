"""The hand-worked cohort and the properties every run must have."""

import pytest
from pyspark.sql import functions as F

import mini
from variantrank.operators import models
from variantrank.operators.report import candidate_report, dropped_variants
from variantrank.plans.pipeline import Options, Run, rank_variants
from variantrank.profiles import CADD13_V13, CADD13_V14, CADD16

EXPECTED = [
    ("P1", "DOM-het", "G1", "c", "het", 0.499643),
    ("P1", "DOM-het", "G2", "c", "het", 0.499643),
    ("P1", "DOM-het", "G4", "n", "het", 0.467523),
    ("P1", "DOM-het", "NOTBL", "l", "het", None),
    ("P1", "REC-hom", "G3", "m", "hom", 0.046752),
    ("P1", "REC-chet", "G1", "c", "chet", 0.249822),
    ("P1", "REC-chet", "G1", "a", "chet", 0.249822),
    ("P1", "REC-chet", "G4", "n", "chet", 0.399714),
    ("P1", "REC-chet", "G4", "o", "chet", 0.399714),
    ("P1", "X-linked-hem", "XG1", "g", "hem", 0.0),
    ("P1", "Y-linked-hem", "YG1", "i", "hem", 0.006774),
    ("P1", None, "ODD1", "j", "hem", 0.006774),
    ("P2", "DOM-het", "G3", "m", "het", 0.311682),
    ("P2", "DOM-het", "NOTBL", "l", "het", None),
    ("P2", "REC-hom", "G1", "a", "hom", 0.033310),
    ("P2", "X-linked-het", "XG1", "g", "het_female", 0.0),
    ("P2", "X-linked-hom", "XG1", "h", "hom_female", 0.053295),
]


def ranked_rows(df):
    rows = df.select("iid", "dz_model", "gene", "key", "geno", F.round("prob", 6).alias("p")).collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.fixture(scope="module")
def run(spark):
    return Run(mini.cohort(spark))


def test_ranked(run):
    expected = sorted(((i, m, g, mini.key(s), c, p) for i, m, g, s, c, p in EXPECTED), key=str)
    assert ranked_rows(run.ranked()) == expected


def test_ranked_values(run):
    row = run.ranked().filter("iid = 'P2' and gene = 'G1'").first()
    assert (row["alt_read"], row["total_read"], row["phred"]) == (None, None, 31.0)
    row = run.ranked().filter("iid = 'P1' and gene = 'G1' and key like '%100_A>G'").first()
    assert (row["alt_read"], row["total_read"], row["fam_id"]) == ("8", "18", "F1")
    assert run.ranked().filter("gene = 'XG1'").agg(F.max("phred")).first()[0] == 62.0


def test_dropped(run):
    rows = {(r["iid"], r["key"]): r["drop_reason"] for r in run.dropped().collect()}
    assert rows == {
        ("P1", mini.key("d")): "non_coding",
        ("P1", mini.key("e")): "blacklist",
        ("P1", mini.key("f")): "not_in_lookup",
        ("P1", mini.key("k")): "unscored",
    }


def test_dropped_agrees_with_general_form(run):
    raw = run.raw()
    general = dropped_variants(raw, raw.filter("drop_reason = ''"))
    assert general.select("iid", "key", "gene").exceptAll(run.dropped().select("iid", "key", "gene")).isEmpty()
    kept = raw.filter("key_kept").select("iid", "key").distinct()
    lost = run.dropped().select("iid", "key").distinct()
    assert kept.join(lost, ["iid", "key"]).isEmpty()
    assert kept.union(lost).distinct().count() == raw.select("iid", "key").distinct().count()


def test_report_all_contains_worst(spark, run):
    every = Run(mini.cohort(spark), options=Options(report_all=True)).ranked()
    columns = ["iid", "dz_model", "gene", "key", "geno"]
    worst = run.ranked()
    assert worst.select(columns).exceptAll(every.select(columns)).isEmpty()
    pair = every.filter("iid = 'P1' and gene = 'G4' and geno = 'chet'").orderBy("phred").collect()
    assert [round(r["prob"], 6) for r in pair] == [0.399714, 0.233762]
    assert every.filter("iid = 'P1' and gene = 'G1' and geno = 'chet'").count() == 3
    assert every.filter("iid = 'P1' and gene = 'G2' and geno = 'chet'").isEmpty()


def test_separate_models_agree_with_the_joint_plan(spark):
    cohort = mini.cohort(spark)
    rows = Run(cohort).candidates().drop("prob", "prob_chet", "zyg")
    rows = rows.join(cohort.pedigree.select("iid", "eth"), "iid")
    for report_all in (False, True):
        columns = ["iid", "dz_model", "gene", "key", "geno", "prob"]
        parts = [
            f(rows, cohort.nulls, report_all).select(columns)
            for f in (models.model_het, models.model_hom, models.model_chet, models.model_hem)
        ]
        union = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
        joint = Run(cohort, options=Options(report_all=report_all)).ranked()
        assert ranked_rows(union) == ranked_rows(joint)


def test_input_order_and_layout_do_not_matter(spark, run):
    shuffled = mini.cohort(
        spark,
        calls=mini.calls(spark).orderBy(F.desc("gt")).repartition(7),
        sites=mini.sites(spark).orderBy(F.desc("start")).repartition(3),
    )
    assert ranked_rows(Run(shuffled).ranked()) == ranked_rows(run.ranked())


def test_first_call_wins(spark):
    call = ("P1", "chr9", 10, "A", "G", "PASS")
    calls = mini.calls(spark, [(*call, "0/0", 1), (*call, "1/1", 2)])
    assert Run(mini.cohort(spark, calls=calls)).ranked().isEmpty()
    calls = mini.calls(spark, [(*call, "0/0", 2), (*call, "1/1", 1)])
    ranked = Run(mini.cohort(spark, calls=calls)).ranked()
    assert [r["dz_model"] for r in ranked.collect()] == ["REC-hom"]


def test_repeated_and_empty_genes(spark):
    rows = [
        mini.site_row("chr9", 10, "A", "G", "exonic", "G4;G4", mini.SNV, 20.0),
        mini.site_row("chr9", 20, "A", "G", "exonic", "G4;", mini.SNV, 10.0),
        mini.site_row("chr9", 30, "A", "G", "exonic", None, mini.SNV, 10.0),
    ]
    calls = [("P1", "chr9", s, "A", "G", "PASS", "0/1", s) for s in (10, 20, 30)]
    run = Run(mini.cohort(spark, sites=mini.sites(spark, rows), calls=mini.calls(spark, calls)))
    got = sorted((r["dz_model"], r["start"]) for r in run.ranked().collect())
    assert got == [("DOM-het", 10), ("REC-chet", 10), ("REC-chet", 20)]
    assert [r["start"] for r in run.dropped().collect()] == [30]


def test_nothing_to_exclude_keeps_all(spark):
    rows = [mini.site_row("chr9", 10, "A", "G", "exonic", "G4", mini.SNV, 20.0)]
    calls = mini.calls(spark, [("P1", "chr9", 10, "A", "G", "PASS", "0/1", 1)])
    run = Run(mini.cohort(spark, sites=mini.sites(spark, rows), calls=calls))
    assert run.ranked().count() == 1 and run.dropped().isEmpty()


def test_rejects(spark):
    people = [
        ("F1", "P1", "0", "0", 0, 2, "ALL"),
        ("F2", "P2", "0", "0", 2, 1, "AFR"),
        ("F2", "P2", "0", "0", 2, 1, "AFR"),
    ]
    calls = mini.calls(spark).union(mini.calls(spark, [("P9", "chr9", 10, "A", "G", "PASS", "0/1", 1)]))
    result = rank_variants(mini.cohort(spark, pedigree=mini.pedigree(spark, people), calls=calls))
    assert {tuple(r) for r in result.rejects.collect()} == {("P1", "sex"), ("P2", "duplicate"), ("P9", "missing")}
    assert result.ranked.isEmpty()


def test_profile_filters(spark):
    rows = [
        mini.site_row("chr9", 10, "A", "G", "exonic", "G4", mini.SNV, 20.0, af=None, kg=None, esp=0.06),
        mini.site_row("chr9", 20, "A", "G", "exonic", "G3", mini.SNV, 20.0, af=None),
        mini.site_row("chr9", 30, "A", "G", "exonic", "G2", mini.SNV, 20.0),
        mini.site_row("chr5", 10, "A", "-", "exonic", "G1", "nonframeshift deletion", 5.0),
    ]
    calls = [("P1", *r[:2], *r[3:5], "LowQual" if r[1] == 30 else ".", "0/1", 1) for r in rows]
    got = {}
    for profile in (CADD16, CADD13_V14, CADD13_V13):
        cohort = mini.cohort(
            spark, sites=mini.sites(spark, rows), calls=mini.calls(spark, calls),
            indels=mini.indels(spark).withColumn("chr", F.lit("chr5")),
        )
        got[profile.name] = {(r["gene"], r["phred"]) for r in Run(cohort, profile).ranked().collect()}
    assert got["cadd16"] == {("G4", 20.0), ("G3", 20.0), ("G2", 20.0), ("G1", 5.0)}
    assert got["cadd13_v14"] == {("G3", 20.0), ("G1", 5.0)}
    assert got["cadd13_v13"] == {("G3", 20.0), ("G1", 33.0)}


def test_two_scores_of_one_indel_make_two_rows(spark):
    rows = [mini.site_row("chr5", 10, "A", "-", "exonic", "G3", "frameshift deletion", 5.0)]
    calls = mini.calls(spark, [("P1", "chr5", 10, "A", "-", "PASS", "0/1", 1)])
    indels = mini.indels(spark).union(mini.indels(spark).withColumn("phred", F.lit(31.0)))
    run = Run(mini.cohort(spark, sites=mini.sites(spark, rows), calls=calls, indels=indels))
    got = sorted((r["dz_model"], r["phred"]) for r in run.ranked().collect())
    assert got == [("DOM-het", 33.0), ("REC-chet", 31.0), ("REC-chet", 33.0)]
    assert run.raw().count() == 1


def _cnv(spark, kind):
    row = mini.site_row("chr9", 70, "N", "0", "exonic", "G4", None, 30.0, ord=1)
    table = mini.sites(spark, [row]).withColumn("iid", F.lit("P1"))
    return table.select(
        "*", F.lit(None).cast("string").alias("filter"), F.lit("1").alias("alt_read"),
        F.lit("2").alias("total_read"), F.lit("hom" if kind == "del" else "het").alias("geno"),
    )


def test_copy_number_calls(spark):
    cohort = mini.cohort(spark, indels=None, cnv_dups=_cnv(spark, "dup"))
    rows = Run(cohort).ranked().filter("gene = 'G4'").collect()
    pair = sorted(r["phred"] for r in rows if r["dz_model"] == "REC-chet")
    assert pair == [30.0, 33.0]
    dup = next(r for r in rows if r["start"] == 70)
    assert (dup["exonic_func"], dup["alt_read"], dup["func"]) == ("frameshift insertion", "1", "exonic")
    both = mini.cohort(spark, cnv_dels=_cnv(spark, "del"))
    assert Run(both).ranked().filter("start = 70").isEmpty()
    assert Run(both).dropped().filter("start = 70").first()["drop_reason"] == "unscored"
    exempt = Run(both, options=Options(rescore_cnv=False)).ranked().filter("start = 70").collect()
    assert [(r["dz_model"], r["geno"]) for r in exempt] == [("REC-hom", "hom")]


def test_candidates(spark):
    people = [(f"F{i}", f"P{i}", "0", "0", 1, 2 if i < 4 else 1, "ALL") for i in range(1, 6)]
    calls = [(f"P{i}", *mini.SITES["g"][:4], "PASS", "1/1", i) for i in (1, 2)]
    calls += [(f"P{i}", *mini.SITES["i"][:4], "PASS", "1/1", i) for i in (1, 2, 5)]
    cohort = mini.cohort(spark, pedigree=mini.pedigree(spark, people), calls=mini.calls(spark, calls))
    run = Run(cohort)
    found = candidate_report(run.ranked(), run.raw(), cohort.pedigree, max_p=0.01).collect()
    assert [(r["key"], r["n_cases"]) for r in found] == [(mini.key("g"), 2)]


def test_empty_input_keeps_the_schema(spark):
    run = Run(mini.cohort(spark, calls=mini.calls(spark, [])))
    assert run.ranked().isEmpty()
    assert run.ranked().columns[:3] == ["fam_id", "iid", "key"]
