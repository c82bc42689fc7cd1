"""One query per operator, each over the whole cohort."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantrank.functions.filters import is_splice
from variantrank.functions.genotypes import disease_model, genotype_class, table_suffix
from variantrank.functions.scores import score_bin, score_norm
from variantrank.functions.variants import VARIANT, has_alternate, variant_key
from variantrank.operators import calls as call_ops
from variantrank.operators import cleaning, cnv, indels, models
from variantrank.operators.genes import first_site, flag_genes, split_fusion_genes
from variantrank.operators.nulls import null_lookup, repeated_null_rows
from variantrank.operators.sites import annotate_scores, annotate_sites
from variantrank.plans.pipeline import KeptRun, Options, Run
from variantrank.plans.pipeline import rank_variants as rank_variants_of
from variantrank.profiles import CADD13_V13, CADD13_V14, CADD16, PROFILES
from variantrank.sinks.ledger import Ledger, of_people, run_pending
from variantrank.sinks.reports import pending_people, ranked_report
from variantrank.sinks.stages import new_folder
from variantrank.sources import contracts, genome, ingest, tables, vcf
from workload import cohort as c

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ANNOTATED = ["chr", "start", "ref", "alt", "func", "gene", "exonic_func", "phred"]
CALLED = ["iid", "key", "gene"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _run(spark, d, profile=CADD16, indels=False, cnv=False, **options) -> Run:
    return Run(c.cohort(spark, d, indels, cnv), profile, Options(**options))


def _split_sites(spark, d) -> DataFrame:
    return first_site(split_fusion_genes(c.sites(spark, d))).drop("ord")


def _annotated(spark, d) -> DataFrame:
    """Calls of usable people with their site rows, class not yet taken."""
    people = call_ops.usable_people(c.pedigree(spark, d))
    calls = call_ops.join_pedigree(c.calls(spark, d), people)
    rows = call_ops.attach_annotations(calls, _split_sites(spark, d))
    return rows.withColumn("key", variant_key())


def _rankable(spark, d) -> DataFrame:
    """Clean, scored, classified rows with the columns the models compare."""
    rows = flag_genes(_annotated(spark, d), {"is_xy": c.xy_genes(spark, d)})
    rows = cleaning.clean_variants(
        call_ops.classify(rows, CADD16).drop("call_drops"), c.lookup_genes(spark, d), CADD16
    )
    rows = indels.normalize_scores(cleaning.keep_scored(rows))
    return rows.withColumns(
        {
            "rescored": F.lit(False),
            "is_splice": is_splice(F.col("func")),
            "is_cnv": F.lit(False),
            "cnv_ord": F.lit(None).cast("int"),
        }
    )


# Sources.


@query
def vcf_sites(spark, d):
    return vcf.vcf_sites(c.vcf_lines(spark, d)).drop("ord")


@query
def vcf_samples(spark, d):
    return vcf.vcf_samples(c.vcf_lines(spark, d)).select("iid", "sample_pos")


@query
def scan_annotations(spark, d):
    parsed = tables.parse_annotations(
        c.annotation_lines(spark, d), c.annotation_header(CADD16), CADD16
    )
    return parsed.drop("ord")


@query
def scan_calls(spark, d):
    parsed = tables.parse_calls(c.call_lines(spark, d), F.col("iid"))
    return tables.prune_calls(parsed).drop("ord")


@query
def scan_pedigree(spark, d):
    return tables.parse_pedigree(c.pedigree_lines(spark, d, "readme"))


@query
def scan_pedigree_wide(spark, d):
    return tables.parse_pedigree(c.pedigree_lines(spark, d, "wide"), "wide")


@query
def scan_gene_lists(spark, d):
    return tables.parse_gene_list(c.gene_list_lines(spark, d))


@query
def scan_null_tables(spark, d):
    parsed = tables.parse_null_table(c.null_lines(spark, d), F.col("model"), F.col("eth"))
    return parsed.select(
        "model",
        "eth",
        "gene",
        F.size("p").alias("n_bins"),
        F.array_max("p").alias("p_max"),
        F.array_min("p").alias("p_min"),
        F.get("p", F.lit(700)).alias("p_700"),
    )


@query
def scan_indel_scores(spark, d):
    return tables.parse_indel_scores(c.indel_lines(spark, d), c.INDEL_HEADER)


def _scan_cnv(spark, d, kind):
    parsed = tables.parse_cnv(c.cnv_lines(spark, d, kind), c.cnv_header(), kind, CADD16)
    columns = ["iid", *VARIANT, "gene", "func", "phred", "type", "alt_read", "total_read", "geno"]
    return parsed.select(columns)


@query
def scan_cnv_del(spark, d):
    return _scan_cnv(spark, d, "del")


@query
def scan_cnv_dup(spark, d):
    return _scan_cnv(spark, d, "dup")


# Which annotated column shows that a source was used; clinical labels must name a pathogenic site.
SOURCE_COLUMNS = {
    "1000g2015aug_all": "kg",
    "cadd13": "phred",
    "esp6500siv2_all": "esp",
    "exac03": "exac",
    "gene_model": "gene",
    "gene_model_mrna": "aa_change",
    "gnomad_exome": "af",
    "clinvar": "clnsig",
}


@query
def missing_sources(spark, d):
    """Sources of the profile that the annotated sites show no value of."""
    sites = c.sites(spark, d).withColumn("clnsig", F.when(F.col("clnsig") == "Pathogenic", "x"))
    counts = sites.agg(*[F.count(SOURCE_COLUMNS[s]).alias(s) for s in CADD13_V14.sources])
    long = counts.unpivot([], list(CADD13_V14.sources), "source", "n")
    return contracts.missing_sources(long, long.filter("n > 0"))


@query
def samples_not_in_vcf(spark, d):
    people = c.table(spark, d, "customer").select(
        F.concat(F.lit("N"), (F.col("c_custkey") % 40).cast("string")).alias("iid"),
        F.col("c_name").alias("fam_id"),
    )
    return contracts.samples_not_in_vcf(people, vcf.vcf_samples(c.vcf_lines(spark, d)))


@query
def rejected_people(spark, d):
    return call_ops.rejected_people(c.pedigree(spark, d), c.calls(spark, d))


@query
def pending(spark, d):
    urgent = c.table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'")
    done = urgent.select(F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("iid"))
    return pending_people(c.pedigree(spark, d), done).select("fam_id", "iid")


# Expressions.


@query
def variant_key_of_calls(spark, d):
    return c.calls(spark, d).select("iid", variant_key().alias("key"), "gt")


@query
def resolve_build(spark, d):
    """Sites per gene under the gene column each profile uses for each build."""
    named = [
        F.struct(
            F.lit(p.name).alias("profile"),
            F.lit(build).alias("build"),
            F.lit(dict(p.with_build(build).gene_columns)["gene"]).alias("gene_column"),
        )
        for p in PROFILES.values()
        for build in ("hg38", "hg19")
    ]
    genes = split_fusion_genes(c.sites(spark, d)).groupBy("gene").agg(F.count("*").alias("n_sites"))
    return genes.select("gene", "n_sites", F.inline(F.array(*named)))


@query
def read_depths(spark, d):
    return call_ops.read_depths(c.calls(spark, d)).select("iid", *VARIANT, "gt", "alt_read", "total_read")


@query
def genotype_classes(spark, d):
    rows = c.calls(spark, d).withColumn("geno", genotype_class(F.col("gt")))
    return rows.withColumn("geno_strict", genotype_class(F.col("gt"), strict=True)).select(
        "iid", *VARIANT, "gt", "geno", "geno_strict"
    )


@query
def sex_adjust(spark, d):
    rows = flag_genes(_annotated(spark, d), {"is_xy": c.xy_genes(spark, d)})
    rows = rows.withColumn("geno", genotype_class(F.col("gt")))
    return call_ops.sex_adjust(rows).select(*CALLED, "sex", "is_xy", "geno")


@query
def ancestry_group(spark, d):
    return c.pedigree(spark, d).select("iid", "eth", table_suffix(F.col("eth")).alias("suffix"))


@query
def score_bins(spark, d):
    rows = c.sites(spark, d).withColumn("norm", score_norm(F.col("phred")))
    return rows.select(*VARIANT, "norm", score_bin(F.col("norm")).alias("bin"))


@query
def indel_left_trim(spark, d):
    return indels.left_trim(c.indels(spark, d)).select(*VARIANT, "phred")


@query
def harmonize_contigs(spark, d):
    return indels.harmonize_contigs(c.indels(spark, d), c.sites(spark, d)).select(*VARIANT, "phred")


@query
def indel_needs_trim(spark, d):
    """Both a table with dashes and one without, each trimmed only if it needs it."""
    raw = c.indels(spark, d)
    dashed = indels.left_trim(raw)
    both = [
        indels.left_trim(t, indels.has_dashes(t)).select(F.lit(n).alias("form"), *VARIANT)
        for n, t in (("anchored", raw), ("dashed", dashed))
    ]
    return both[0].unionByName(both[1])


@query
def cnv_genotype(spark, d):
    return c.cnv_dels(spark, d).select("iid", *VARIANT, "gene", "geno")


@query
def cnv_sex_adjust(spark, d):
    people = call_ops.usable_people(c.pedigree(spark, d))
    rows = cnv.prepare_cnv(c.cnv_dels(spark, d), c.cnv_dups(spark, d), people, c.xy_genes(spark, d))
    return rows.select("iid", *VARIANT, "gene", "exonic_func", "filter", "sex", "geno")


@query
def model_label(spark, d):
    rows = _run(spark, d).raw()
    return rows.select(*CALLED, "geno", disease_model(F.col("geno"), F.col("chr")).alias("dz_model"))


@query
def info_keep_ac(spark, d):
    kept = vcf.info_keep_ac(vcf.vcf_sites(c.vcf_lines(spark, d)))
    return kept.select("chrom", "pos", "ref", "alt", "info")


@query
def vcf_to_variant(spark, d):
    return vcf.vcf_to_variant(vcf.vcf_sites(c.vcf_lines(spark, d))).select(
        "chr", "start", "end", "ref", "alt"
    )


# Filters.


@query
def drop_blacklist(spark, d):
    return cleaning.drop_blacklist(_split_sites(spark, d)).select(ANNOTATED)


@query
def drop_af_discrepancy(spark, d):
    return cleaning.drop_af_discrepancy(_split_sites(spark, d)).select(*ANNOTATED, "af", "kg", "esp")


@query
def keep_lookup_genes(spark, d):
    kept = cleaning.keep_lookup_genes(_split_sites(spark, d), c.lookup_genes(spark, d))
    return kept.select(ANNOTATED)


@query
def drop_missing_geno(spark, d):
    """Calls without any genotype text are left out where the status is known."""
    people = call_ops.usable_people(c.pedigree(spark, d))
    calls = call_ops.join_pedigree(c.calls(spark, d), people)
    known = F.when(~F.col("gt").startswith("."), F.col("gt"))
    rows = calls.withColumn("geno", genotype_class(known))
    return cleaning.drop_missing_geno(rows).select("iid", *VARIANT, "status", "geno")


@query
def keep_coding_splice(spark, d):
    return cleaning.keep_coding_splice(_split_sites(spark, d)).select(ANNOTATED)


@query
def keep_scored(spark, d):
    return cleaning.keep_scored(_split_sites(spark, d)).select(ANNOTATED)


@query
def keep_pass(spark, d):
    return cleaning.keep_pass(c.calls(spark, d)).select("iid", *VARIANT, "filter", "gt")


@query
def clean_variants(spark, d):
    rows = flag_genes(_annotated(spark, d), {"is_xy": c.xy_genes(spark, d)})
    rows = call_ops.classify(rows, CADD13_V14).drop("call_drops")
    kept = cleaning.clean_variants(rows, c.lookup_genes(spark, d), CADD13_V14)
    return kept.select(*CALLED, "geno", "filter")


@query
def drop_reasons(spark, d):
    return _run(spark, d, CADD13_V14).raw().select(*CALLED, "drop_reason", "key_kept")


@query
def carriers(spark, d):
    return c.calls(spark, d).filter(has_alternate(F.col("gt"))).select("iid", *VARIANT, "gt")


# Joins and row expansion.


@query
def annotations_of_carriers(spark, d):
    calls = c.calls(spark, d).filter(has_alternate(F.col("gt")))
    return call_ops.annotations_of_carriers(c.sites(spark, d), calls).select(ANNOTATED)


@query
def join_calls_annotations(spark, d):
    calls = c.calls(spark, d)
    joined = call_ops.attach_annotations(calls, _split_sites(spark, d), unique_calls=True)
    return joined.select("iid", *VARIANT, "gene", "func", "phred", "filter", "gt")


@query
def dedupe_key_gene(spark, d):
    return _annotated(spark, d).select(*CALLED, "gt", "filter", "phred")


@query
def xy_flag(spark, d):
    flagged = flag_genes(_split_sites(spark, d), {"is_xy": c.xy_genes(spark, d)})
    return flagged.select(*VARIANT, "gene", "is_xy")


@query
def join_pedigree(spark, d):
    people = call_ops.usable_people(c.pedigree(spark, d))
    joined = call_ops.join_pedigree(c.calls(spark, d), people)
    return joined.select("iid", *VARIANT, "gt", "fam_id", "sex", "status", "eth")


def _rescored(spark, d, profile):
    run = _run(spark, d, profile, indels=True)
    rows = indels.rescore_indels(_split_sites(spark, d), run.indels, profile)
    return rows.select(*VARIANT, "gene", "exonic_func", "rescored", "raw_score", "phred")


@query
def rescore_indels(spark, d):
    return _rescored(spark, d, CADD16)


@query
def rescore_indels_v13(spark, d):
    return _rescored(spark, d, CADD13_V13)


@query
def null_cells(spark, d):
    """By the narrow table of a row per gene and score bin."""
    path = new_folder(spark, "null-cells")
    tables.write_null_cells(c.nulls(spark, d), path)
    rows = models.with_zygosity(_rankable(spark, d)).filter("zyg = 'het'")
    return null_lookup(rows, spark.read.parquet(path), "het").select(*CALLED, "eth", "phred", "prob")


@query
def annotate_site_sources(spark, d):
    """Sites joined to one table per frequency source and to the clinical labels."""
    sites = c.sites(spark, d)
    on = ["chr", "start", "end", "ref", "alt"]
    sources = {n: sites.filter(F.col(n).isNotNull()).select(*on, n) for n in ("af", "exac", "esp", "kg")}
    sources["clinvar"] = sites.filter("clnsig is not null").select(*on, "clnsig", "clndn")
    return annotate_sites(sites.select(on), sources)


@query
def annotate_site_scores(spark, d):
    sites = c.sites(spark, d)
    scores = sites.filter("phred >= 0").select(*VARIANT, "raw_score", "phred")
    return annotate_scores(sites.select(*VARIANT, "gene"), scores)


@query
def annotate_from_genome(spark, d):
    """Sites scored from a laid-out table of far more positions, several of them listed twice."""
    path = new_folder(spark, "genome-scores")
    genome.write_source(c.genome_scores(spark, d), path)
    return annotate_scores(c.sites(spark, d).select(*VARIANT, "gene"), genome.read_source(spark, path))


@query
def split_genes(spark, d):
    return split_fusion_genes(c.sites(spark, d)).select(ANNOTATED)


@query
def unpivot_genotypes(spark, d):
    names = vcf.sample_names(c.vcf_header(spark, d))
    return vcf.unpivot_genotypes(c.vcf_lines(spark, d), names).select("iid", "chrom", "pos", "ref", "alt", "gt")


@query
def vcf_calls(spark, d):
    return vcf.parse_vcf(c.vcf_lines(spark, d), header=c.vcf_header(spark, d)).calls.select(
        "iid", "chr", "start", "end", "ref", "alt", "info", "gt"
    )


# Aggregations, windows, models.


@query
def chet_genes(spark, d):
    return models.chet_genes(_rankable(spark, d))


@query
def distinct_indels(spark, d):
    run = _run(spark, d, indels=True)
    return run.indels


@query
def stage_audit(spark, d):
    return KeptRun(c.cohort(spark, d), CADD16, Options(), new_folder(spark, "run")).audit()


@query
def worst_per_gene(spark, d):
    return models.worst_per_gene(_rankable(spark, d)).select(*CALLED, "geno", "phred")


@query
def worst_pair(spark, d):
    return models.worst_pair(_rankable(spark, d)).select(*CALLED, "geno", "phred", "rank")


@query
def pair_prob(spark, d):
    pairs = null_lookup(models.worst_pair(_rankable(spark, d)), c.nulls(spark, d), "chet")
    return models.pair_prob(pairs).select(*CALLED, "rank", "prob")


def _model(f, spark, d):
    return f(_rankable(spark, d), c.nulls(spark, d)).select(*CALLED, "geno", "phred", "dz_model", "prob")


@query
def model_het(spark, d):
    return _model(models.model_het, spark, d)


@query
def model_hom(spark, d):
    return _model(models.model_hom, spark, d)


@query
def model_chet(spark, d):
    return _model(models.model_chet, spark, d)


@query
def model_hem(spark, d):
    return _model(models.model_hem, spark, d)


@query
def rank_variants(spark, d):
    return _run(spark, d).ranked()


@query
def report_all(spark, d):
    return _run(spark, d, report_all=True).ranked()


@query
def rank_variants_full(spark, d):
    """Indel scores and copy-number calls included."""
    return _run(spark, d, indels=True, cnv=True).ranked()


@query
def rank_variants_cadd13_v14(spark, d):
    return _run(spark, d, CADD13_V14, indels=True, cnv=True).ranked()


@query
def rank_variants_cadd13_v13(spark, d):
    return _run(spark, d, CADD13_V13, indels=True, cnv=True).ranked()


@query
def report_all_full(spark, d):
    return _run(spark, d, indels=True, cnv=True, report_all=True).ranked()


@query
def dropped_variants(spark, d):
    return _run(spark, d).dropped()


@query
def dropped_variants_full(spark, d):
    return _run(spark, d, CADD13_V14, indels=True, cnv=True).dropped()


@query
def candidate_report(spark, d):
    """Copy-number calls included; unaffected people of unknown sex count by their raw calls."""
    return _run(spark, d, indels=True, cnv=True).shared_candidates(new_folder(spark, "run"))


@query
def outputs_of_one_pass(spark, d):
    """How many ranked and dropped rows everyone has, both read from one kept join."""
    cohort = c.cohort(spark, d, with_indels=True, with_cnv=True)
    result = rank_variants_of(cohort, CADD13_V14, Options(), new_folder(spark, "run"))
    kinds = [rows.select("iid", F.lit(kind).alias("kind")) for kind, rows in (("ranked", result.ranked), ("dropped", result.dropped))]
    counts = kinds[0].unionByName(kinds[1]).groupBy("iid").agg(
        F.count_if(F.col("kind") == "ranked").alias("n_ranked"), F.count_if(F.col("kind") == "dropped").alias("n_dropped")
    )
    return counts


@query
def incremental_report(spark, d):
    """Ranked rows after three runs: of the affected, one that was broken off before its entry, and of everybody left."""
    cohort = c.cohort(spark, d, with_indels=True, with_cnv=True)
    own = Ledger(spark, new_folder(spark, "reports"))
    run_pending(of_people(cohort, cohort.pedigree.filter("status = 2")), own)
    own.write("broken-off", "ranked", own.read("ranked"))
    run_pending(cohort, own)
    return own.read("ranked")


@query
def rank_from_vcf(spark, d):
    """From a VCF of nations, one file per contig, to ranked rows."""
    path = new_folder(spark, "vcf")
    c.write_vcf(spark, d, path)
    read = vcf.read_vcf(spark, path)
    tables_of = c.cohort(spark, d, with_indels=True)
    cohort = replace(tables_of, calls=read.calls, pedigree=c.nation_pedigree(spark, d), samples=read.samples)
    return Run(cohort, CADD16).ranked()


@query
def join_stored_calls(spark, d):
    """Calls and sites stored by variant, then joined without a shuffle of either."""
    name = f"t{uuid.uuid4().hex}"
    buckets = ingest.buckets_for(c.table(spark, d, "lineitem").count())  # one call per order line
    calls = ingest.store(c.calls(spark, d), f"{name}_calls", new_folder(spark, "calls"), buckets)
    sites = ingest.store(_split_sites(spark, d), f"{name}_sites", new_folder(spark, "sites"), buckets)
    people = call_ops.usable_people(c.pedigree(spark, d))
    rows = call_ops.attach_annotations(call_ops.join_pedigree(calls, people), sites, small_bytes=1 << 40)
    return rows.withColumn("key", variant_key()).select(*CALLED, "gt", "filter", "phred")


@query
def repeated_nulls(spark, d):
    """What the check finds when the tables of one model are given twice."""
    once = c.nulls(spark, d)
    return repeated_null_rows(once.union(once.filter("model = 'het'")))


@query
def rejects(spark, d):
    """People left out, when the VCF holds the people of urgent orders only."""
    urgent = c.table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'")
    samples = urgent.select(F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("iid"))
    return call_ops.rejected_people(c.pedigree(spark, d), c.calls(spark, d), samples)


@query
def cnv_union(spark, d):
    rows = cnv.cnv_union(c.cnv_dels(spark, d), c.cnv_dups(spark, d))
    return rows.select("iid", *VARIANT, "gene", "exonic_func", "filter", "geno")


@query
def merge_cnv(spark, d):
    run = _run(spark, d, cnv=True)
    return run.observed().select(*CALLED, "exonic_func", "geno", "is_cnv")


@query
def ranked_report_rows(spark, d):
    """The ranked table under its reported names, dots written as underscores."""
    rows = ranked_report(_run(spark, d).ranked(), CADD16)
    return rows.toDF(*[n.replace(".", "_") for n in rows.columns])
