"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence are combined as log-likelihoods: byte trigrams of the whole text (models trained on the rows that
declare a language), the declared markup language (through a confusion table, so a careless declaration weighs little),
the address suffix, and a prior of the host that is smoothed towards its domain and that towards the corpus. All tables
come from grouped aggregation over all rows; a row does not vote for its own host prior. Against all languages stands the
class of none of them, under which all trigrams are equally likely: a text that no model explains better than that is not
kept, has a low probability and no lang, and has no part in the tables of the other evidence. In that comparison a row's own
text does not speak for it; foreign text that fills some two percent or more of a language's declared rows becomes part of its model.

Defined results: null or empty texts (under three bytes) give no text evidence, also not of the class of none; a null or unlisted declaration and a null
address or host give none either; with no evidence at all the corpus prior decides; ties go to the language first in
alphabetical order; if no language is declared often enough, lang is null, probability 0 and kept false; rows with equal
ids are judged each on its own; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantrank.llm.common import TEXTS_PER_BATCH, arrow_rows, write_stage

BUCKETS = 1 << 14


@dataclass(frozen=True)
class Options:
    """min_rows: rows that a declared language needs for a model, whatever the size of the table; a model is BUCKETS
    numbers, held by the driver and the executors. text_weight: trigrams
    whose mean counts as independent evidence. none_prior: odds of no modelled language before the text is seen. host_weight: rows that a parent's prior is worth. min_probability: below it a
    row is not kept. broadcast_hosts: hosts whose priors are broadcast at most; more are joined by a shuffle."""

    min_rows: int = 5
    text_weight: float = 60.0
    none_prior: float = 0.01
    host_weight: float = 20.0
    min_probability: float = 0.5
    broadcast_hosts: int = 50_000


def trigram_buckets(text: str | None) -> np.ndarray:
    """The bucket of every byte trigram of the lower-case text."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.uint32)
    mixed = data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA6B) ^ data[2:] * np.uint32(0xC2B2AE35)
    return (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(18)


def languages(rows: DataFrame, options: Options) -> list[str]:
    counts = rows.where("declared is not null").groupBy("declared").count()
    return sorted(r["declared"] for r in counts.where(F.col("count") >= options.min_rows).collect())


def train(rows: DataFrame, langs: list[str]) -> np.ndarray:
    """How often each trigram bucket occurs in each language, plus 0.5, from all rows that declare it."""
    place = {lang: k for k, lang in enumerate(langs)}

    def count(batches):
        sums = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[place[lang]] += np.bincount(trigram_buckets(text.as_py()), minlength=BUCKETS)
        for k, n in sums.items():
            bucket = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), k, np.int32)), pa.array(bucket.astype(np.int32)), pa.array(n[bucket])], ["k", "bucket", "n"])

    counted = rows.where(F.col("declared").isin(langs)).select("declared", "text").mapInArrow(count, "k int, bucket int, n long")
    sums = np.full((len(langs), BUCKETS), 0.5)
    with arrow_rows(rows.sparkSession, TEXTS_PER_BATCH):
        found = counted.groupBy("k", "bucket").agg(F.sum("n").alias("n")).toArrow()  # len(langs) * BUCKETS rows at most
    sums[found["k"].to_numpy(), found["bucket"].to_numpy()] += found["n"].to_numpy()
    return sums


def text_evidence(rows: DataFrame, langs: list[str], sums: np.ndarray, weight: float) -> DataFrame:
    """Replace text by ll: a log-likelihood for each language, of the whole text, worth at most weight trigrams; others: the
    same, but that of the declared language as trained without this row; and blank: the same where all trigrams are equally
    likely, null without trigrams."""
    totals = sums.sum(axis=1)
    shared = rows.sparkSession.sparkContext.broadcast(np.log(sums / totals[:, None]).astype(np.float32))
    kept = [c for c in rows.columns if c != "text"]
    place = {lang: k for k, lang in enumerate(langs)}

    def score(batches):
        table = shared.value
        for batch in batches:
            out, blank = np.zeros((batch.num_rows, len(table))), np.full(batch.num_rows, np.nan)
            others = np.zeros_like(out)
            for i, (text, told) in enumerate(zip(batch.column("text"), batch.column("declared").to_pylist(), strict=True)):
                found = trigram_buckets(text.as_py())
                if len(found):
                    worth = min(weight, len(found))
                    own = np.bincount(found, minlength=BUCKETS)
                    met = np.flatnonzero(own)
                    for j in range(0, len(table), 64):
                        out[i, j : j + 64] = table[j : j + 64, met] @ own[met].astype(np.float64) / len(found) * worth
                    others[i] = out[i]
                    blank[i] = -np.log(BUCKETS) * worth
                    k = place.get(told)
                    if k is not None:
                        left = np.maximum(np.exp(table[k].astype(np.float64)) * totals[k] - own, 0.5)
                        others[i, k] = np.log(left / left.sum()) @ own / len(found) * worth
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(table), dtype=np.int32)), pa.array(x.ravel())) for x in (out, others)
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *lists, pa.array(blank, from_pandas=True)], [*kept, "ll", "others", "blank"])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(score, f"{fields}, ll array<double>, others array<double>, blank double")


def softmax(logs: Column) -> Column:
    raised = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, y: a + y))


def none_of(logs: Column, none: Column) -> Column:
    """The probability of the class of none with log-weight none against logs; 0 where none is null."""
    most = F.array_max(logs)
    total = F.aggregate(F.transform(logs, lambda x: F.exp(x - most)), F.lit(0.0), lambda a, y: a + y)
    return F.coalesce(1 / (1 + F.exp(most + F.ln(total) - none)), F.lit(0.0))


def host_of(address: Column) -> Column:
    return F.lower(F.regexp_extract(address, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def identify(rows: DataFrame, options: Options = Options()) -> DataFrame:
    """(id, lang, probability, kept) for rows of (id, text, declared, host, domain, suffix); see evidence_of()."""
    langs = languages(rows, options)
    if not langs:
        return rows.select("id", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("probability"), F.lit(False).alias("kept"))
    n = len(langs)
    scored = write_stage(text_evidence(rows, langs, train(rows, langs), options.text_weight), "text-evidence", TEXTS_PER_BATCH)
    blank = F.col("blank") + math.log(options.none_prior)
    known = 1 - none_of(F.col("others"), blank + math.log(n))
    scored = scored.withColumn("known", known).withColumn("q", F.transform(softmax(F.col("ll")), lambda x: x * F.col("known")))
    sums = [F.sum(F.col("q")[k]).alias(f"s{k}") for k in range(n)]
    vector = F.array(*[F.col(f"s{k}") for k in range(n)])

    # What rows declare when their text is in a language: at most (n + 1) * n numbers, joined as a table.
    said = F.when(F.col("declared").isin(langs), F.col("declared")).when(F.col("declared").isNotNull(), F.lit(""))
    confusion = {r["said"]: np.array(r["v"]) for r in scored.groupBy(said.alias("said")).agg(*sums).select("said", vector.alias("v")).collect()}
    total = np.sum(list(confusion.values()), axis=0) if confusion else np.zeros(n)
    told = np.array([confusion.get(x, np.zeros(n)) for x in [*langs, ""]]) + 0.5
    declared_log = np.log(told / told.sum(axis=0))
    world = (total + 1) / (total + 1).sum()

    hosts = write_stage(
        scored.where("host is not null").groupBy("host", "domain", "suffix").agg(F.count("*").alias("rows"), *sums).select("host", "domain", "suffix", "rows", vector.alias("h")),
        "host-sums",
    )
    share = F.array(*[F.lit(float(x)) for x in world])
    own = [F.sum(F.col("h")[k]).alias(f"s{k}") for k in range(n)]
    w = float(options.host_weight)
    smoothed = lambda v, m, parent: F.zip_with(v, parent, lambda x, p: (x + w * p) / (m + w))
    domains = hosts.where("domain is not null").groupBy("domain").agg(F.sum("rows").alias("m"), *own).select("domain", smoothed(vector, F.col("m"), share).alias("of_domain"))
    suffixes = hosts.where("suffix is not null").groupBy("suffix").agg(F.sum("rows").alias("m"), *own).select(
        "suffix", F.zip_with(smoothed(vector, F.col("m"), share), share, lambda x, p: F.ln(x) - F.ln(p)).alias("of_suffix")
    )
    zeros = F.array(*[F.lit(0.0)] * n)
    # The priors of a host: its sums, its domain's smoothed shares, and what its suffix adds.
    priors = write_stage(
        hosts.join(domains, "domain", "left").join(suffixes, "suffix", "left")
        .select("host", "domain", "suffix", "rows", "h", F.coalesce("of_domain", share).alias("of_domain"), F.coalesce("of_suffix", zeros).alias("of_suffix")),
        "host-priors",
    )
    small = priors.count() <= options.broadcast_hosts
    p = priors.select(F.col("host").alias("p_host"), F.col("domain").alias("p_domain"), F.col("suffix").alias("p_suffix"), "rows", "h", "of_domain", "of_suffix")
    same = (F.col("host") == F.col("p_host")) & F.col("domain").eqNullSafe(F.col("p_domain")) & F.col("suffix").eqNullSafe(F.col("p_suffix"))
    met = scored.join(F.broadcast(p) if small else p, same, "left")
    others = F.zip_with("h", "q", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    prior = F.coalesce(smoothed(others, F.col("rows") - 1, F.col("of_domain")), share)
    lines = [(x, v.tolist()) for x, v in zip([*langs, ""], declared_log, strict=True)]
    met = met.withColumn("said", said).join(F.broadcast(rows.sparkSession.createDataFrame(lines, "said string, of_declared array<double>")), "said", "left")
    add = lambda x, y: F.zip_with(x, y, lambda u, v: u + v)
    met = met.withColumn("prior", F.transform(prior, lambda x: F.ln(x)))
    logs = add(add("ll", "prior"), add(F.coalesce("of_declared", zeros), F.coalesce("of_suffix", zeros)))
    posterior = met.select("id", none_of(add("others", "prior"), blank).alias("none"), logs.alias("logs")).select("id", "none", softmax(F.col("logs")).alias("p"))
    most = F.array_max("p")
    best = most * (1 - F.col("none"))
    return posterior.select(
        "id",
        F.when(best >= F.col("none"), F.get(F.array(*[F.lit(x) for x in langs]), F.array_position("p", most).cast("int") - 1)).alias("lang"),
        best.alias("probability"),
        (best >= options.min_probability).alias("kept"),
    )


def evidence_of(df: DataFrame, id_col: str, text_col: str, declared: Column, address: Column | None = None, host: Column | None = None) -> DataFrame:
    """The rows that identify() takes. With an address, host, domain (last two labels) and suffix (last label) come from it."""
    null = F.lit(None).cast("string")
    if address is not None:
        host = F.nullif(host_of(address), F.lit(""))
    host = null if host is None else host
    labels = F.split(host, r"\.")
    named = address is not None
    return df.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.nullif(F.lower(F.substring_index(F.trim(declared), "-", 1)), F.lit("")).alias("declared"),
        host.alias("host"),
        (F.substring_index(host, ".", -2) if named else null).alias("domain"),
        (F.when(F.size(labels) > 1, F.substring_index(host, ".", -1)) if named else null).alias("suffix"),
    )
