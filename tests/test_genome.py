"""Genome-wide sources: only what meets a site is read, shuffled and aggregated."""

import random

import pytest
from pyspark.sql import functions as F

from variantrank.operators.sites import annotate_scores, annotate_sites
from variantrank.sources import genome
from workload import cohort

ON = ["chr", "start", "ref", "alt"]


def scores(spark, n=3000):
    k = F.col("id")
    chrom = F.concat(F.lit(""), (1 + k % 3).cast("string"))
    return spark.range(n).select(
        chrom.alias("chr"), (k * 7001).alias("start"), F.lit("A").alias("ref"), F.lit("G").alias("alt"), (k / 10).alias("raw_score"), k.cast("double").alias("phred")
    )


def sites(spark):
    rows = [(str(1 + k % 3), k * 7001, "A", "G") for k in (3, 4, 300, 301)] + [("1", 5, "A", "G"), (None, None, None, None), ("2", 4 * 7001, "A", "T")]
    return spark.createDataFrame(rows, "chr string, start long, ref string, alt string")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_rows_at_sites_are_aggregated(spark):
    both = scores(spark).union(scores(spark).withColumn("phred", F.col("phred") + 1))
    met = genome.SiteKeys(sites(spark), ON).meeting(both)
    assert met.count() == 8
    joined = annotate_scores(sites(spark), both)
    assert sorted(r["phred"] for r in joined.collect() if r["phred"] is not None) == [3.0, 4.0, 300.0, 301.0]
    assert joined.count() == 7
    plan = plan_of(joined)
    assert plan.index("Aggregate") < plan.index("LeftSemi")  # the aggregate stands above the semi-join


def test_bitmap_of_very_many_sites(spark):
    """Nothing that meets a site is lost, and few other rows pass."""
    pick = random.Random(1)
    keys = [(pick.choice("12"), pick.randrange(10**6) * 7, "A", "G") for _ in range(3000)]
    many = spark.createDataFrame(keys, "chr string, start long, ref string, alt string")
    wide = spark.range(200_000).select(
        F.concat(F.lit(""), (1 + F.col("id") % 2).cast("string")).alias("chr"), (F.col("id") * 35).alias("start"), F.lit("A").alias("ref"),
        F.lit("G").alias("alt"), F.lit(1.0).alias("raw_score"), F.col("id").cast("double").alias("phred"),
    )
    exact = genome.SiteKeys(many, ON).meeting(wide)
    coarse = genome.SiteKeys(many, ON, max_bytes=0).meeting(wide)
    assert exact.exceptAll(coarse).isEmpty()
    assert exact.count() <= coarse.count() < exact.count() + 0.12 * 200_000
    one, two = annotate_scores(many, wide), annotate_scores(many, wide, max_bytes=0)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


@pytest.mark.parametrize("max_bytes", [0, 1 << 30])
def test_layout(spark, tmp_path, max_bytes):
    path = str(tmp_path / "scores")
    odd = spark.createDataFrame([(None, None, "A", "G", 1.0, 1.0)], "chr string, start long, ref string, alt string, raw_score double, phred double")
    genome.write_source(scores(spark).union(odd), path)
    laid = genome.read_source(spark, path)
    assert dict(laid.dtypes)["contig"] == "string" and laid.count() == 3001
    joined = annotate_scores(sites(spark), laid, max_bytes=max_bytes)
    plain = annotate_scores(sites(spark), scores(spark))
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    keys = genome.SiteKeys(sites(spark), ON, max_bytes=max_bytes)
    files = {r[0] for r in keys.meeting(laid.withColumn("file", F.col("_metadata.file_path"))).select("file").distinct().collect()}
    assert 0 < len(files) <= 4 < laid.select("_metadata.file_path").distinct().count()
    scan = keys._read_bins(laid)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "pos_bin" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_no_sites(spark):
    none = sites(spark).filter("false")
    assert annotate_scores(none, scores(spark)).count() == 0
    assert genome.SiteKeys(none, ON, max_bytes=0).meeting(scores(spark)).count() in (0, 1)


def test_sources_of_several_columns(spark):
    on = ["chr", "start", "end", "ref", "alt"]
    here = sites(spark).withColumn("end", F.col("start"))
    af = scores(spark).withColumn("end", F.col("start")).select(*on, F.col("phred").alias("af"))
    label = af.filter("af < 100").select(*on, F.lit("Benign").alias("clnsig"))
    for size in (0, 1 << 30):
        found = annotate_sites(here, {"af": af, "label": label}, max_bytes=size)
        assert sorted((r["af"], r["clnsig"]) for r in found.dropna(subset=["af"]).collect()) == [
            (3.0, "Benign"), (4.0, "Benign"), (300.0, None), (301.0, None)]


def test_vcf_files_stay_small(spark, tmp_path, monkeypatch):
    """A contig is written to several files by range of sites, each with the head, and no site is lost."""
    rows = {
        "part": (range(1, 81), "long", ["id as p_partkey"]),
        "supplier": (range(1, 3), "long", ["id as s_suppkey", "cast(id as int) as s_nationkey"]),
        "nation": (range(1, 3), "long", ["cast(id as int) as n_nationkey"]),
        "lineitem": (range(1, 81), "long", ["id as l_partkey", "1 + id % 2 as l_suppkey", "1 as l_linenumber", "'F' as l_linestatus", "'A' as l_returnflag", "5.0 as l_quantity", "0.0 as l_discount"]),
    }
    for name, (ids, kind, columns) in rows.items():
        spark.createDataFrame([(i,) for i in ids], f"id {kind}").selectExpr(*columns).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(cohort, "SITES_PER_FILE", 10, raising=False)
    cohort.write_vcf(spark, str(tmp_path), str(tmp_path / "vcf"))
    bodies = []
    for file in (tmp_path / "vcf").rglob("part-*.txt"):
        lines = file.read_text().splitlines()
        assert lines[0].startswith("##fileformat") and lines[1].startswith("#CHROM")
        bodies.append(lines[2:])
    assert sum(map(len, bodies)) == 80 and max(map(len, bodies)) <= 10
