"""Runs that join once, and runs that may be broken off between any two steps."""

import re

import pytest
from pyspark.sql import functions as F

import mini
from variantrank.plans import pipeline
from variantrank.plans.pipeline import KeptRun, Options, Run, rank_variants
from variantrank.profiles import CADD13_V13, CADD13_V14, CADD16
from variantrank.sinks import ledger, reports, stages
from variantrank.sinks.ledger import Ledger, run_pending


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    return sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def cnv(spark, *rows):
    none = dict.fromkeys("exonic_func aa_change gene_detail af af_afr af_nfe exac kg esp raw_score clnsig clndn filter".split())
    base = dict(chr="chr9", start=5, end=6, ref="N", alt="0", func="exonic", phred=30.0, alt_read="1", total_read="2", **none)
    kinds = {"start": "long", "end": "long", "phred": "double", "ord": "int", **dict.fromkeys("af af_afr af_nfe exac kg esp raw_score".split(), "double")}
    made = [base | row | {"ord": i} for i, row in enumerate(rows)]
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in made[0])
    return spark.createDataFrame([tuple(r.values()) for r in made], schema)


def cohorts(spark):
    twice = mini.indels(spark).union(mini.indels(spark).withColumn("phred", F.lit(20.0)))
    odd_calls = [("P1", "chr9", 10, "A", "G", "LowQual", "0/1", 1), ("P1", "chr9", 10, "A", "G", "PASS", "1/1", 2), ("P3", *mini.SITES["a"][:4], "PASS", "0/1", 3)]
    null_gene = [mini.site_row("chr1", 5, "A", "G", "intergenic", None, None, 5.0), *[mini.site_row(*v, ord=i) for i, v in enumerate(mini.SITES.values())]]
    calls = mini.calls(spark).union(mini.calls(spark, [("P1", "chr1", 5, "A", "G", "PASS", "0/1", 99)]))
    people = mini.pedigree(spark, [("F1", "P1", "0", "0", 1, 2, "ALL"), ("F2", "P2", "0", "0", 2, 1, "AFR"), ("F3", "P3", "0", "0", 0, 1, "ALL"), ("F4", "P4", "0", "0", 1, 2, "NFE")])
    dels = cnv(spark, {"iid": "P1", "gene": "G4", "geno": "het"}, {"iid": "P2", "gene": "XG1", "geno": "hom"}, {"iid": "P1", "gene": "HLA-A", "geno": "het"})
    return {
        "scores listed twice": mini.cohort(spark, indels=twice),
        "null gene, unknown sex": mini.cohort(spark, sites=mini.sites(spark, null_gene), calls=calls.union(mini.calls(spark, odd_calls[2:])), pedigree=people),
        "repeated calls": mini.cohort(spark, calls=mini.calls(spark, odd_calls[:2])),
        "copy numbers": mini.cohort(spark, cnv_dels=dels, cnv_dups=dels.withColumn("start", F.lit(7).cast("long")), pedigree=people),
        "no indels, no calls": mini.cohort(spark, indels=None, calls=mini.calls(spark).filter("false")),
    }


@pytest.mark.parametrize("name", ["scores listed twice", "null gene, unknown sex", "repeated calls", "copy numbers", "no indels, no calls"])
def test_kept_run_equals_separate_plans(spark, tmp_path, name):
    cohort = cohorts(spark)[name]
    profile, options = {
        "scores listed twice": (CADD13_V13, Options(strict_gt=True)),
        "repeated calls": (CADD13_V14, Options(report_all=True)),
        "copy numbers": (CADD16, Options(rescore_cnv=False)),
    }.get(name, (CADD16, Options()))
    run, once = Run(cohort, profile, options), KeptRun(cohort, profile, options, str(tmp_path))
    assert same(run.ranked(), once.ranked())
    assert same(run.dropped(), once.dropped())
    assert same(run.audit(), once.audit())
    limits = {"max_p": 1.0, "min_cases": 1}
    if name in ("copy numbers", "null gene, unknown sex"):
        want = run.shared_candidates(**limits)
        assert same(want, once.shared_candidates(**limits)) and same(want, run.shared_candidates(str(tmp_path / "near"), **limits))
    columns = ["iid", "key", "gene", "geno", "phred", "is_cnv"]
    assert same(run.observed().select(columns), once.observed().select(columns))


def test_one_join_for_all_results(spark, tmp_path, monkeypatch):
    """Calls and sites meet once; every result reads the joined rows from files, and its plan holds no table of calls."""
    joins = []
    monkeypatch.setattr(pipeline, "attach_annotations", lambda *a, f=pipeline.attach_annotations, **b: joins.append(1) or f(*a, **b))
    mini.calls(spark).write.parquet(str(tmp_path / "calls"))
    cohort = mini.cohort(spark, calls=spark.read.parquet(str(tmp_path / "calls")))
    result = rank_variants(cohort, CADD16, Options(), str(tmp_path / "run"))
    for rows in (result.ranked, result.dropped, result.audit(), result.candidates(max_p=1.0, min_cases=1)):
        rows.collect()
        folders = {f.split("/")[-2] for f in rows.inputFiles()}
        assert "joined" in folders or any(f.startswith("shared-") for f in folders)
        assert "calls" not in folders or rows.columns[0] == "key"  # candidates look at the calls of rejected people
    assert len(joins) == 1


def test_report_all_reads_its_rows_once(spark, tmp_path):
    mini.calls(spark).write.parquet(str(tmp_path / "calls"))
    cohort = mini.cohort(spark, calls=spark.read.parquet(str(tmp_path / "calls")), indels=None)
    plan = Run(cohort, options=Options(report_all=True)).ranked_core()._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[iid", plan)) == 1


# Runs that are broken off.


class Stop(Exception):
    pass


def break_off(at):
    def step(name):
        if name == at:
            raise Stop

    return step


def valid(own, kind="ranked"):
    rows = own.read(kind)
    return [] if rows is None else sorted((r["iid"], r["key"], str(r["dz_model"]) if kind == "ranked" else "") for r in rows.collect())


@pytest.mark.parametrize("at", ["ranked", "dropped", "entered"])
def test_breaking_off_between_steps(spark, tmp_path, at):
    cohort, own = mini.cohort(spark), Ledger(spark, str(tmp_path / "reports"))
    whole = Run(cohort)
    first = cohort.pedigree.filter("iid = 'P1'")
    run_pending(ledger.of_people(cohort, first), own)
    before = valid(own)
    assert before and {r[0] for r in before} == {"P1"}
    with pytest.raises(Stop):
        run_pending(cohort, own, step=break_off(at))
    after = valid(own)
    assert after == before if at != "entered" else {r[0] for r in after} == {"P1", "P2"}
    left = {r["iid"] for r in own.pending(cohort.pedigree).collect()}
    assert left == ({"P2"} if at != "entered" else set())
    again = run_pending(cohort, own)
    assert (again is None) == (at == "entered")
    assert same(own.read("ranked"), whole.ranked()) and same(own.read("dropped"), whole.dropped())
    assert len(own.vacuum()) == (at != "entered") and own.vacuum() == []
    assert same(own.read("ranked"), whole.ranked())


def test_entry_that_was_broken_off(spark, tmp_path, monkeypatch):
    """A failed write of the manifest leaves its people pending."""
    cohort, own = mini.cohort(spark), Ledger(spark, str(tmp_path / "reports"))
    monkeypatch.setattr(Ledger, "commit", lambda *a: (_ for _ in ()).throw(Stop))
    with pytest.raises(Stop):
        run_pending(cohort, own)
    monkeypatch.undo()
    assert own.read("ranked") is None and own.pending(cohort.pedigree).count() == 2
    assert run_pending(cohort, own) and same(own.read("ranked"), Run(cohort).ranked())


def test_later_run_counts_and_people_without_rows(spark, tmp_path):
    cohort, own = mini.cohort(spark), Ledger(spark, str(tmp_path / "reports"))
    people = mini.pedigree(spark, [("F1", "P1", "0", "0", 1, 2, "ALL"), ("F9", "P9", "0", "0", 1, 2, "ALL")])
    assert run_pending(mini.cohort(spark, pedigree=people), own)
    assert own.pending(people).isEmpty() and {r[0] for r in valid(own)} == {"P1"}
    own.write("again", "ranked", Run(cohort).ranked().filter("iid = 'P1' and gene = 'G4'"))
    own.commit("again", people.filter("iid = 'P1'"))
    assert {r[1] for r in valid(own)} == {mini.key("n"), mini.key("o")} and valid(own, "dropped") == []
    own.export("ranked", str(tmp_path / "tsv"), CADD16, run="again")
    assert [p.name for p in (tmp_path / "tsv").glob("report=*")] == ["report=F1_P1_PSAP.txt"]


def test_runs_broadcast_nothing_that_measures_much(spark, tmp_path, monkeypatch):
    """Ids of people and keys of sites are read from files that look small to Spark; beyond the limit none is broadcast."""
    cohort, own = cohorts(spark)["copy numbers"], Ledger(spark, str(tmp_path / "reports"))
    run_pending(ledger.of_people(cohort, cohort.pedigree.filter("iid = 'P1'")), own)
    for module in ("operators.joins", "plans.pipeline"):
        monkeypatch.setattr(f"variantrank.{module}.data_bytes", lambda df: 1 << 40)
    left = own.pending(cohort.pedigree)
    run = KeptRun(ledger.of_people(cohort, stages.kept(left, str(tmp_path / "left"))), CADD16, Options(), str(tmp_path / "run"))
    for rows in (left, own.read("ranked"), run.cnv, run.dropped()):
        ids = [line for line in steps(rows) if re.search(r"Broadcast\w*Join \[(iid|key|fam_id)", line)]
        assert not ids
    assert {r["iid"] for r in left.collect()} == {"P2", "P3", "P4"}


def test_writers_rank_once(spark, tmp_path, monkeypatch):
    """With people= the rows are computed once, and what they need besides is read from files."""
    counted = spark.sparkContext.accumulator(0)
    rows = Run(mini.cohort(spark)).ranked().cache()
    rows.count()
    seen = rows.rdd.map(lambda r: (counted.add(1), r)[1])
    counting = spark.createDataFrame(seen, rows.schema)
    people = mini.pedigree(spark).select("fam_id", "iid")
    n = rows.count()
    for write in (lambda: reports.write_parquet(counting, str(tmp_path / "a"), people), lambda: reports.write_tsv(counting, str(tmp_path / "b"), CADD16, people=people)):
        before = counted.value
        write()
        assert counted.value - before == n


def test_shared_folder(spark):
    one, two = stages.new_folder(spark, "x"), stages.new_folder(spark, "x")
    assert one != two
    folder = spark.conf.get("spark.checkpoint.dir", None)
    assert folder is None or one.startswith(f"{folder}/x-")


def test_only_carriers_meet_the_sites(spark, monkeypatch):
    """Repeated calls are found before the sites are met, at which arrive the calls that can take part, without text or place."""
    met = []
    monkeypatch.setattr(pipeline, "lookup_join", lambda big, small, on, *a, f=pipeline.lookup_join, **b: met.append((big, on)) or f(big, small, on, *a, **b))
    again = [("P1", "chr9", 10, "A", "G", "PASS", "0/0", -1), ("P2", "chr9", 20, "A", "G", "PASS", "0/1", 98), ("P2", "chr9", 20, "A", "G", "PASS", "0/0", 99)]
    rows = Run(mini.cohort(spark, calls=mini.calls(spark).union(mini.calls(spark, again)), indels=None))._call_rows()
    (calls,) = [big for big, on in met if list(on) == ["chr", "start", "ref", "alt"]]
    assert not {"gt", "filter", "ord", "status"} & set(calls.columns)
    assert {r["geno"] for r in calls.select("geno").collect()} == {"het", "hom"}
    g4 = sorted((r["iid"], r["start"]) for r in rows.filter("gene = 'G4'").collect())
    assert g4 == [("P1", 20), ("P2", 20)]


def test_candidates_read_the_calls_once(spark, tmp_path, monkeypatch):
    """With a folder the calls are stored once; with many people, calls of the unaffected are left out before they are ranked."""
    mini.calls(spark).write.parquet(str(tmp_path / "calls"))
    run = Run(mini.cohort(spark, calls=spark.read.parquet(str(tmp_path / "calls")), indels=None))
    monkeypatch.setattr(pipeline, "MAX_BROADCAST_BYTES", 0)
    assert {r["iid"] for r in run._affected().cohort.calls.select("iid").collect()} == {r["iid"] for r in run.people.filter("status = 2").collect()}
    limits = {"max_p": 1.0, "min_cases": 1}
    rows = run.shared_candidates(str(tmp_path / "near"), **limits)
    folders = {f.split("/")[-2] for f in rows.inputFiles()}
    assert "calls" not in folders and any(f.startswith("calls-") for f in folders)
    assert same(rows, run.shared_candidates(**limits))


# What the outputs of one join cost.


def steps(df):
    """The lines of the physical plan, from the last step to the first."""
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def test_calls_are_sorted_once_for_the_first_of_each(spark, monkeypatch):
    """Calls go by person before first calls are looked for, and no step sorts them on the other side of that shuffle."""
    cohort = mini.cohort(spark)
    plan = steps(Run(cohort).raw())
    shuffle = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(iid" in line and "REPARTITION_BY_COL" in line]
    assert len(shuffle) == 1 and shuffle[0] > max(i for i, line in enumerate(plan) if "WindowGroupLimit [iid" in line)
    assert "REPARTITION_BY_COL" not in "".join(steps(Run(cohort, options=Options(unique_calls=True)).raw()))
    monkeypatch.setattr(Run, "people_bytes", 1 << 40)  # the join of the people shuffles by person then
    assert "REPARTITION_BY_COL" not in "".join(steps(Run(cohort).raw()))


def test_joined_calls_hold_what_results_read(spark, tmp_path):
    run = KeptRun(mini.cohort(spark), CADD16, Options(), str(tmp_path))
    assert len(run.joined.columns) == 16 and not {"sex", "status", "exonic_func", "is_xy", "is_cnv", "filter"} & set(run.joined.columns)
    assert run.joined.schema["scores"].dataType.elementType.names == ["phred", "score_norm", "rescored", "prob", "prob_chet"]


def test_copy_numbers_do_not_shuffle_calls(spark, tmp_path):
    """Calls meet the few copy-number rows that lie at a site by broadcast; those at a site still count."""
    site = dict(zip(("chr", "start", "ref", "alt"), mini.SITES["a"][:4]))
    rows = [{"iid": "P1", "gene": "G4", "geno": "het"}, {"iid": "P1", "gene": "HLA-A", "geno": "het"}]
    rows += [{"iid": p, "gene": g, "geno": "het", **site} for p in ("P1", "P2") for g in ("G4", "HLA-A")]
    run = KeptRun(mini.cohort(spark, cnv_dels=cnv(spark, *rows), indels=None), CADD16, Options(), str(tmp_path))
    plan = steps(run.dropped())
    calls = next(i for i, line in enumerate(plan) if "FileScan parquet [fam_id" in line)
    assert not any("Exchange" in line for line in plan[:calls])
    assert any(re.search(r"BroadcastHashJoin \[iid\S* key.*LeftSemi", line) for line in plan)
    assert same(run.dropped(), Run(run.cohort).dropped())
