"""The cohort run: annotated sites, calls and null tables to ranked and dropped variants."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from copy import copy
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from variantrank.functions.filters import passes
from variantrank.functions.genotypes import takes_part, zygosity
from variantrank.functions.variants import VARIANT, variant_key
from variantrank.operators.calls import (
    attach_annotations,
    classify,
    first_call,
    join_pedigree,
    read_genotypes,
    rejected_people,
    sex_adjust,
    usable_people,
)
from variantrank.operators.cleaning import joined_reasons
from variantrank.operators.cnv import cnv_sex_adjust, cnv_union, join_people, merge_cnv
from variantrank.operators.genes import merged_lists
from variantrank.operators.indels import (
    mark_scored,
    normalize_scores,
    prepare_indels,
    rescore_indels,
)
from variantrank.operators.joins import MAX_BROADCAST_BYTES, data_bytes, lookup_join
from variantrank.operators.models import own_probabilities, probabilities, rank_models
from variantrank.operators.nulls import attach_nulls, own_cells, table_bytes
from variantrank.operators.report import shared_by_affected, stage_audit, unseen_in_unaffected
from variantrank.operators.sites import flag_variants, prepare_sites
from variantrank.profiles import CADD16, Profile
from variantrank.sinks.stages import kept
from variantrank.sources.contracts import require_sources
from variantrank.sources.genome import SiteKeys


@dataclass(frozen=True)
class Cohort:
    """Input tables of one run; those after ``nulls`` are optional.

    ``samples`` (iid) are the sample columns of the VCF; without them nobody is rejected as not being there.
    ``required_sources`` and ``sources`` (source) are annotation sources; a missing one stops the run before it starts.
    """

    calls: DataFrame
    sites: DataFrame
    pedigree: DataFrame
    xy_genes: DataFrame
    lookup_genes: DataFrame
    nulls: DataFrame
    indels: DataFrame | None = None
    cnv_dels: DataFrame | None = None
    cnv_dups: DataFrame | None = None
    samples: DataFrame | None = None
    required_sources: DataFrame | None = None
    sources: DataFrame | None = None


@dataclass(frozen=True)
class Options:
    """``unique_calls``: no person has two calls of one variant, so none is looked for. A hazard: where the
    caller's word is wrong, repeated calls pair up as false compound heterozygotes.
    """

    report_all: bool = False
    rescore_cnv: bool = True
    strict_gt: bool = False
    unique_calls: bool = False


@dataclass(frozen=True)
class Result:
    """``audit()`` and ``candidates()`` are made when called for."""

    ranked: DataFrame
    dropped: DataFrame
    rejects: DataFrame
    audit: Callable[[], DataFrame]
    candidates: Callable[..., DataFrame]


class Run:
    """Lazily built stages of one cohort run.

    Everything known from the site alone (gene lists, cleaning, re-scoring,
    null cells) is settled on the site table. The ranking then carries only
    what it compares; the descriptive site columns are joined to its result.
    """

    def __init__(self, cohort: Cohort, profile: Profile = CADD16, options: Options = Options()):
        self.cohort, self.profile, self.options = cohort, profile, options
        if cohort.required_sources is not None:
            require_sources(cohort.required_sources, cohort.sources)
        self.people = usable_people(cohort.pedigree)
        lists = merged_lists({"is_xy": cohort.xy_genes, "in_lookup": cohort.lookup_genes})
        self.list_bytes = data_bytes(lists)
        self.sites = prepare_sites(
            cohort.sites,
            cohort.xy_genes,
            cohort.lookup_genes,
            profile,
            small_bytes=self.list_bytes,
        )
        self.indels = self._indels()
        self.cnv = self._cnv()
        ranked = {"iid", "key", *VARIANT, "total_read", "alt_read", "gene", "phred"}
        self.described = [c for c, _ in profile.variant_columns if c not in ranked]

    # Each table that may be broadcast is measured once per run, when first needed.

    @cached_property
    def site_bytes(self) -> int:
        return data_bytes(self.sites)

    @cached_property
    def people_bytes(self) -> int:
        return data_bytes(self.people)

    @cached_property
    def indel_bytes(self) -> int:
        return data_bytes(self.cohort.indels)

    @cached_property
    def null_bytes(self) -> int:
        return table_bytes(self.cohort.nulls)

    def _indels(self) -> DataFrame | None:
        c = self.cohort
        if c.indels is None:
            return None
        contigs = c.sites.select("chr")
        for table in (c.cnv_dels, c.cnv_dups):
            if table is not None:
                contigs = contigs.unionByName(table.select("chr"))
        return prepare_indels(c.indels, contigs, self.profile)

    def _cnv(self) -> DataFrame | None:
        c = self.cohort
        cnv = cnv_union(c.cnv_dels, c.cnv_dups)
        if cnv is None:
            return None
        flagged = flag_variants(
            cnv, c.xy_genes, c.lookup_genes, self.profile, small_bytes=self.list_bytes
        )
        mine = cnv_sex_adjust(join_people(flagged, self.people, small_bytes=self.people_bytes))
        return mine.withColumns(
            {
                "is_cnv": F.lit(True),
                "call_drops": F.lit(""),
                "rescore_exempt": F.lit(not self.options.rescore_cnv),
            }
        )

    def _clean_scored(self, rows: DataFrame) -> DataFrame:
        """Site-level survivors with their final score and null cells."""
        clean = rows.filter(F.col("site_drops") == "")
        rescored = rescore_indels(clean, self.indels, self.profile).filter("phred is not null")
        return attach_nulls(
            normalize_scores(rescored), self.cohort.nulls, small_bytes=self.null_bytes
        )

    def scored_sites(self) -> DataFrame:
        """The site columns the ranking compares, for the sites that can be ranked."""
        return self._clean_scored(self.sites).drop(*self.described, "end", "key", "site_drops")

    def _calls(self) -> DataFrame:
        """Calls of usable people, by person as soon as repeated calls are looked for.

        A shuffled join of the people leaves them so; behind a broadcast one shuffle by person serves the search, which then
        sorts the calls once, and leaves each person's rows together for whatever counts or ranks them next.
        """
        rows = join_pedigree(self._place_columns(), self.people, small_bytes=self.people_bytes)
        if self.options.unique_calls or self.people_bytes > MAX_BROADCAST_BYTES:
            return rows
        return rows.repartition("iid")

    def candidates(self) -> DataFrame:
        """Rows that take part in a model, with their own probabilities."""
        return self._candidates().withColumn("key", variant_key())

    def _candidates(self) -> DataFrame:
        """The candidates without their key, which is made of other columns once the rows are ranked."""
        rows = self._call_rows().withColumn("is_cnv", F.lit(False))
        if self.cnv is None:
            return rows.withColumn("cnv_ord", F.lit(None).cast("int"))
        cnv = self._clean_scored(self.cnv).withColumn("cells", own_cells())
        cnv = own_probabilities(cnv.filter(takes_part(F.col("geno"))))
        cnv = cnv.withColumn("described", F.struct(*self.described))
        return rows.unionByName(
            cnv.select(*rows.columns, "cnv_ord", "described"), allowMissingColumns=True
        )

    def _call_rows(self) -> DataFrame:
        """The calls among the candidates.

        Calls at no site that can be ranked are left out where they are read. The search for repeated calls comes next: it needs no
        shuffle if the people were joined by one, and leaves only the carriers' calls to meet the sites.
        """
        sites = self.scored_sites()
        if self.indels is not None:  # scores beyond the range can be equal once they are limited to it
            sites = sites.dropDuplicates([*VARIANT, "gene", "raw_score", "phred"])
        rows = self._first_carriers(SiteKeys(self.sites.filter("site_drops = ''"), VARIANT).meeting(self._place_columns()))
        # These are some of the sites, each with less than 300 bytes of cells where a measured site
        # row has over 150. An indel score adds a row per gene of its variant, few at most.
        size = 3 * self.site_bytes + (0 if self.indels is None else 10 * self.indel_bytes)
        rows = lookup_join(rows, sites, VARIANT, "inner", small_bytes=size)
        rows = sex_adjust(rows.withColumn("cells", own_cells()).drop("eth", "in_lookup"))
        rows = own_probabilities(rows.filter(takes_part(F.col("geno"))))
        return rows.drop("sex", "is_xy", "raw_score")

    def _place_columns(self) -> DataFrame:
        return self.cohort.calls.select("iid", *VARIANT, "filter", "gt", "ord")

    def _first_carriers(self, calls: DataFrame) -> DataFrame:
        """First calls of usable people, of which those remain that can take part at some site.

        A row without a genotype class takes no part, so only FILTER is left to test. Until repeated calls are found, calls that
        take no part are but their place in the source.
        """
        rows = read_genotypes(calls, self.options.strict_gt)
        part = takes_part(F.col("geno"))
        if self.profile.pass_filter:
            part = part & passes(F.col("filter"))
        own = [F.when(F.col("_part"), F.col(c)).alias(c) for c in ("geno", "alt_read", "total_read")]
        rows = rows.withColumn("_part", part).select("iid", *VARIANT, "ord", *own)
        rows = join_pedigree(rows, self.people.drop("status"), small_bytes=self.people_bytes)
        rows = rows.drop("ord") if self.options.unique_calls else first_call(rows)
        return rows.filter("geno is not null")

    def _describe(self, ranked: DataFrame) -> DataFrame:
        """Join the descriptive site columns; copy-number rows bring their own."""
        table = self.sites.select(*VARIANT, "gene", *self.described)
        rows = lookup_join(
            ranked.withColumnRenamed("described", "_own"),
            table,
            VARIANT + ["gene"],
            "left",
            small_bytes=self.site_bytes,
        )
        if self.cnv is None:
            return rows
        own = {c: F.when(F.col("is_cnv"), F.col(f"_own.{c}")).otherwise(F.col(c)) for c in self.described}
        return rows.withColumns(own)

    def ranked_core(self) -> DataFrame:
        """The ranked rows without the descriptive site columns."""
        return self._ranked_places().withColumn("key", variant_key())

    def _ranked_places(self) -> DataFrame:
        """The ranked rows without their key, of which the parts are there."""
        return rank_models(self._candidates(), self.options.report_all)

    def ranked(self) -> DataFrame:
        columns = [c for c, _ in self.profile.ranked_columns]
        rows = self._describe(self._ranked_places()).withColumn("key", variant_key())
        return rows.select("fam_id", *columns)

    def raw(self) -> DataFrame:
        """Every annotated call with its class, ``drop_reason`` and ``key_kept``.

        ``key_kept`` says that some row of the same person and key survives.
        """
        site_kept = (F.col("site_drops") == "") & F.col("has_score")
        marked = mark_scored(self.sites, self.indels, self.profile)
        # A variant has at most one row per gene here, so this window holds small groups.
        sites = marked.withColumn("_any", F.max(site_kept).over(Window.partitionBy(*VARIANT)))
        rows = attach_annotations(
            self._calls(), sites, self.options.unique_calls, small_bytes=self.site_bytes
        )
        rows = classify(rows, self.profile, self.options.strict_gt)
        rows = self._with_reasons(rows).withColumn(
            "key_kept", F.col("_any") & (F.col("call_drops") == "")
        )
        return rows.withColumn("is_cnv", F.lit(False)).drop(
            "_any", "has_score", "site_drops", "call_drops"
        )

    def _with_reasons(self, rows: DataFrame) -> DataFrame:
        unscored = F.when(F.col("has_score"), "").otherwise("unscored")
        reasons = joined_reasons(F.col("site_drops"), F.col("call_drops"), unscored)
        return rows.withColumn("drop_reason", reasons)

    def raw_cnv(self) -> DataFrame | None:
        if self.cnv is None:
            return None
        rows = self._with_reasons(mark_scored(self.cnv, self.indels, self.profile))
        return rows.drop("has_score", "site_drops", "call_drops", "rescore_exempt")

    def observed(self) -> DataFrame:
        """Every row of every person before cleaning, copy-number rows included."""
        return merge_cnv(self.raw(), self.raw_cnv())

    def audit(self) -> DataFrame:
        """Per person: raw, clean, candidate and ranked rows; copy-number rows are counted where they are ranked."""
        return stage_audit(self.raw(), self.ranked_core())

    def shared_candidates(self, folder: str | None = None, **limits) -> DataFrame:
        """Variants of several affected and no unaffected people; unaffected ones who take no part count by their raw calls.

        With a ``folder`` the calls, which are read several times, are written there once. So are the variants that the affected
        share, few rows, and of all other calls only those of these variants meet the sites.
        """
        pedigree = self.cohort.pedigree
        run = self if folder is None else self._with_kept_calls(f"{folder}/calls-{uuid.uuid4().hex}")
        shared = shared_by_affected(run._affected().ranked_core(), pedigree, **limits)
        if folder is None:
            near = run
        else:
            shared = kept(shared, f"{folder}/shared-{uuid.uuid4().hex}")
            near = run._at_keys(shared.select("key").distinct())
        apart = near.cohort.calls.join(run.rejects().select("iid").distinct(), "iid", "left_semi")
        return unseen_in_unaffected(shared, near.observed(), pedigree, apart, measured=folder is not None)

    def _with_kept_calls(self, path: str) -> Run:
        """This run with its calls read from a file below ``path``."""
        run = copy(self)
        run.cohort = replace(self.cohort, calls=kept(self._place_columns(), path))
        return run

    def _affected(self) -> Run:
        """This run with the affected people only: everyone is ranked apart from the others.

        With too many people to broadcast, the calls of others are left out before any shuffle.
        """
        ill = copy(self)
        ill.people = self.people.filter("status = 2")
        if self.people_bytes > MAX_BROADCAST_BYTES:
            ill.cohort = replace(self.cohort, calls=SiteKeys(ill.people, ["iid"]).meeting(self.cohort.calls))
        ill.cnv = ill._cnv()
        return ill

    def _at_keys(self, keys: DataFrame) -> Run:
        """This run with the calls of some variants only; ``keys`` (key) is read from a file."""
        calls = lookup_join(self.cohort.calls.withColumn("key", variant_key()), keys, ["key"], "left_semi").drop("key")
        near = copy(self)
        near.cohort = replace(self.cohort, calls=calls)
        return near

    def dropped(self) -> DataFrame:
        """Rows of a person whose key is in none of that person's clean rows."""
        columns = [c for c, _ in self.profile.dropped_columns]
        raw, cnv = self.raw(), self.raw_cnv()
        lost = raw.filter(~F.col("key_kept")).select("fam_id", *columns, "drop_reason")
        if cnv is None:
            return lost
        key = ["iid", "key"]
        kept_cnv = cnv.filter(F.col("drop_reason") == "").select(*key).distinct()
        lost_cnv = cnv.join(kept_cnv, key, "left_anti").select(*lost.columns).distinct()
        # Calls and copy-number rows meet only at keys of sites, which few copy-number rows have, if any: these few are
        # measured, so that calls are not shuffled for them. Only calls that share a key with a lost copy-number row matter to it.
        at_sites = self.sites.select("key").distinct()

        def at_a_site(rows: DataFrame) -> DataFrame:
            return lookup_join(rows, at_sites, ["key"], "left_semi", small_bytes=self.site_bytes)

        size = data_bytes(at_a_site(self.cnv.select(*key)))
        met_kept, met_lost = (at_a_site(rows.select(*key).distinct()) for rows in (kept_cnv, lost_cnv))
        kept_calls = lookup_join(self._kept_keys(), met_lost, key, "left_semi", small_bytes=size)
        lost_cnv = lookup_join(lost_cnv, kept_calls.distinct(), key, "left_anti", small_bytes=size)
        return lookup_join(lost, met_kept, key, "left_anti", small_bytes=size).unionByName(lost_cnv)

    def _kept_keys(self) -> DataFrame:
        """(iid, key) of the calls with some surviving row."""
        return self.raw().filter("key_kept").select("iid", "key")

    def rejects(self) -> DataFrame:
        return rejected_people(self.cohort.pedigree, self.cohort.calls, self.cohort.samples)


class KeptRun(Run):
    """A run that joins calls with sites once.

    Prepared sites and the joined calls are written below ``folder`` when first needed; ranked and dropped rows, the audit
    and the shared candidates all read them from there. A joined row holds what the models compare and the number of its
    site, by which the descriptive columns are found again. The scores of a site, several where the indel table lists
    it several times, are an array, so that a joined row is there once.
    """

    def __init__(self, cohort: Cohort, profile: Profile, options: Options, folder: str):
        super().__init__(cohort, profile, options)
        self.folder = folder
        self.sites = kept(self.sites.withColumn("site", F.monotonically_increasing_id()), f"{folder}/sites")

    def _joinable_sites(self) -> DataFrame:
        """Narrow site rows with their scores and the cells of every ancestry."""
        scored = self._clean_scored(self.sites)
        entry = F.struct("phred", "score_norm", "rescored", "cells")
        scores = scored.groupBy("site").agg(F.collect_list(entry).alias("scores"))
        site_kept = (F.col("site_drops") == "") & F.col("has_score")
        marked = mark_scored(self.sites, self.indels, self.profile)
        marked = marked.withColumn("_any", F.max(site_kept).over(Window.partitionBy(*VARIANT)))
        narrow = ["site", *VARIANT, "gene", "is_xy", "is_splice", "site_drops", "has_score", "_any"]
        return marked.select(*narrow, F.col("phred").alias("own_phred")).join(scores, "site", "left")

    @cached_property
    def joined(self) -> DataFrame:
        """Every annotated call once, with its class, reasons, and the scores it may be ranked by with their probabilities.

        Only what some result reads is written; all else is with the site.
        """
        sites = kept(self._joinable_sites(), f"{self.folder}/joinable")
        rows = attach_annotations(self._calls(), sites, self.options.unique_calls, small_bytes=data_bytes(sites))
        rows = classify(rows, self.profile, self.options.strict_gt)
        rows = self._with_reasons(rows).withColumn("key_kept", F.col("_any") & (F.col("call_drops") == ""))
        part = takes_part(F.col("geno"))
        part = part & passes(F.col("filter")) if self.profile.pass_filter else part
        rows = rows.withColumn("_zyg", zygosity(F.col("geno")))

        def own(score):
            values = {c: score[c] for c in ("phred", "score_norm", "rescored")} | probabilities(own_cells(score["cells"]), F.col("_zyg"))
            return F.struct(*[value.alias(name) for name, value in values.items()])

        rows = rows.withColumn("scores", F.when(part, F.transform("scores", own)))
        columns = ["fam_id", "iid", *VARIANT, "site", "gene", "is_splice", "own_phred", "geno", "alt_read", "total_read"]
        return kept(rows.select(*columns, "drop_reason", "key_kept", "scores"), f"{self.folder}/joined")

    def _call_rows(self) -> DataFrame:
        rows = self.joined.filter("size(scores) > 0").withColumn("_score", F.explode("scores"))
        columns = ["fam_id", "iid", *VARIANT, "total_read", "alt_read", "gene", "is_splice", "geno"]
        return rows.select(*columns, "_score.*").withColumn("zyg", zygosity(F.col("geno")))

    def _plain(self) -> DataFrame:
        return self.joined.withColumns({"key": variant_key(), "is_cnv": F.lit(False)}).drop("scores")

    def _kept_keys(self) -> DataFrame:
        return self._plain().filter("key_kept").select("iid", "key")

    def raw(self) -> DataFrame:
        table = self.sites.select("site", *self.described, "phred")
        rows = self._plain().drop("own_phred")
        return lookup_join(rows, table, ["site"], "left", small_bytes=self.site_bytes).drop("site")

    def observed(self) -> DataFrame:
        return merge_cnv(self._plain().withColumnRenamed("own_phred", "phred").drop("site"), self.raw_cnv())

    def audit(self) -> DataFrame:
        return stage_audit(self._plain(), self.ranked_core())

    def shared_candidates(self, folder: str | None = None, **limits) -> DataFrame:
        return super().shared_candidates(folder or self.folder, **limits)

    def _with_kept_calls(self, path: str) -> Run:
        return self

    def _affected(self) -> Run:
        return self  # its joined calls are there

    def _at_keys(self, keys: DataFrame) -> Run:
        return self


def rank_variants(
    cohort: Cohort, profile: Profile = CADD16, options: Options = Options(), folder: str | None = None
) -> Result:
    """Ranked variants, dropped variants, rejected people, the audit and the shared candidates of a cohort.

    With a ``folder`` that all executors see, calls meet sites once, and all results are read from what is kept there
    (:class:`KeptRun`); remove the folder when they are written. Without it each result is a plan of its own.
    """
    run = Run(cohort, profile, options) if folder is None else KeptRun(cohort, profile, options, folder)
    return Result(run.ranked(), run.dropped(), run.rejects(), run.audit, run.shared_candidates)
