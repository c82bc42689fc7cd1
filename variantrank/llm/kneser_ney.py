"""Quality by perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

The model is fitted on all trusted documents but a held-out share, chosen by a hash of the id. Counts, continuation counts,
discounts and back-off weights are aggregations and equi-joins on word hashes. A word's log-probability is a sum over the one, two
and three words that end with it, so each document's n-grams meet the tables by inner joins on their 64-bit hashes and only sums
per text are kept. A table is broadcast as long as it has at most MOST_BROADCAST rows; a larger one is sharded by the n-gram and
joined by shuffle, in PARTS parts. No text and no row per word of a document is written, and shuffle files go with their job.

A document is kept if its mean surprise per word is not above the quantile, among all trusted documents of its language
that the model has not seen, plus an allowance that shrinks with the root of its length.

Defined results: null or empty texts have no words, no perplexity and are not kept; without trusted documents that have words
there is no model, so texts with words have a null perplexity and are kept; a language without unseen trusted documents takes the
threshold of all; rows with equal ids are scored each by itself; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantrank.llm.common import GAP, lean_disk, write_stage

MOST_BROADCAST = 2_000_000
#: Larger tables of n-grams are made, and meet the documents' n-grams, in so many parts by the class of a word: shuffled rows of one
#: part are on disk at a time.
PARTS = 4


@dataclass(frozen=True)
class Options:
    """held_out: share of the trusted documents that is kept out of the model, for the thresholds; more, up to half, until
    that is least_held_out documents, as fewer say little of the quantile. quantile: of their surprise. allowance: nats that a
    document of one word may exceed it; one of n words may exceed it by allowance / sqrt(n)."""

    held_out: float = 0.125
    least_held_out: int = 1000
    quantile: float = 0.999
    allowance: float = 4.0


def hashes_of(text: Column) -> Column:
    """Hashes of the lower-case words, without one closing comma or full stop, after two marks of the beginning."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[.,](?=[\x20\x09-\x0D]|\z)", "")
    words = F.array_remove(F.split(plain, GAP), "")
    return F.concat(F.array(F.lit(1).cast("long"), F.lit(1).cast("long")), F.transform(words, lambda w: F.xxhash64(w)))


def _runs(rows: DataFrame, n: int, *others: str) -> DataFrame:
    """Every run of n hashes in the column hashes, as w0, w1, ..., with the one after it (next, null at the end) and the columns
    others. Runs of one begin with the second mark. A text without words has none."""
    start, h = 2 if n == 1 else 1, F.col("hashes")
    names = [*(f"w{k}" for k in range(n)), "next"]
    many = F.size(h) - (start + n - 2)
    runs = F.arrays_zip(*[F.slice(h, F.lit(start + k), many).alias(c) for k, c in enumerate(names)])
    return rows.select(*others, F.explode(F.when(F.size(h) > 2, runs)).alias("g")).select(*others, *[F.col("g").getField(c).alias(c) for c in names])


def held_out(n_trusted: int, options: Options) -> Column:
    """Whether a trusted document is kept out of the model, by a hash of its id and text: the lowest part of its range."""
    share = max(options.held_out, min(0.5, options.least_held_out / max(n_trusted, 1)))
    return F.xxhash64("id", "text") < F.lit(int((share - 0.5) * (1 << 63)) * 2)


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts from the numbers of n-grams that occur one to four times."""
    n = {r["c"]: float(r["n"]) for r in counts.where("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}
    n1, n2, n3, n4 = (max(n.get(k, 0.0), 0.5) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return [min(max(k - (k + 1) * y * b / a, 0.05 * k), 0.95 * k) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


@dataclass(frozen=True)
class Model:
    """Tables (key, kind, here, next) of one, two and three words: what a word adds to the log-probability if it ends the run (here), and
    what it adds to that of the word after the run (next).

    The log-probability of a word is unseen, plus here of its runs of one to three words, plus next of the runs of one and two words
    before it, as far as they are in the tables: a longer run's here makes up for the back-off that the shorter ones count. kind is the
    class, of parts, of the first word, of three words that of the middle one."""

    words: DataFrame
    pairs: DataFrame
    triples: DataFrame
    parts: int


def _kind(word: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(parts)).cast("byte")


def _side(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= MOST_BROADCAST else table


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def fit(chosen: DataFrame) -> tuple[Model, float]:
    """The model of the documents in chosen (column hashes), and the log-probability of an unseen word."""
    grams = _runs(chosen, 3).toDF("u", "v", "w", "next")
    c3 = write_stage(grams.groupBy("u", "v", "w").agg(F.count("*").alias("c")), "trigrams")
    c2 = write_stage(c3.groupBy("v", "w").agg(F.count("*").alias("c")), "bigrams")
    c1 = write_stage(c2.groupBy("w").agg(F.count("*").alias("c")), "unigrams")
    seen = c1.agg(F.count("*").alias("n"), F.sum("c").alias("c")).first()

    def discount(d: list[float]) -> Column:
        return F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])

    off1, off2, off3 = (discount(_discounts(c)) for c in (c1, c2, c3))
    left = (c1.agg(F.sum(off1)).first()[0] or 0.0) / max(seen["c"] or 0, 1)
    floor = left / (seen["n"] + 1)
    unseen = math.log(floor) if floor else 0.0
    p1 = c1.select("w", ((F.col("c") - off1) / F.lit(float(seen["c"] or 1)) + floor).alias("p1"))
    contexts = write_stage(c2.groupBy("v").agg(F.sum("c").alias("total"), F.sum(off2).alias("off")), "contexts")
    back = F.ln(F.col("off") / F.col("total"))
    parts = 1 if c3.count() <= MOST_BROADCAST else PARTS
    # The mark of the beginning is a context and no word, so it has no probability.
    words = p1.join(contexts.withColumnRenamed("v", "w"), "w", "full").select(
        F.col("w").alias("key"), _kind("w", parts).alias("kind"), F.coalesce(F.ln("p1") - unseen, F.lit(0.0)).alias("here"), F.coalesce(back, F.lit(0.0)).alias("next")
    )

    # A trigram's bigram and context share its middle word, so that each part needs the pairs of that word's class only.
    kind = lambda c: _kind(c, parts)
    key = [F.xxhash64("v", "w").alias("key"), kind("v").alias("first"), kind("w").alias("last")]
    lower = F.col("off") / F.col("total") * F.col("p1")
    p2 = c2.join(_side(contexts), "v").join(_side(p1), "w").select(*key, lower.alias("lower"), ((F.col("c") - off2) / F.col("total") + lower).alias("p2"))
    before = c3.groupBy(F.xxhash64("u", "v").alias("key"), kind("u").alias("first"), kind("v").alias("last"))
    before = before.agg(F.sum("c").alias("total"), F.sum(off3).alias("off"))
    pairs = write_stage(p2.join(before, ["key", "first", "last"], "full"), "pairs")

    def triples(part: int) -> DataFrame:
        own = c3.where(kind("v") == part).select(
            F.xxhash64("u", "v").alias("a"), F.xxhash64("v", "w").alias("b"), F.xxhash64("u", "v", "w").alias("key"), (F.col("c") - off3).alias("own")
        )
        joined = own.join(pairs.where(F.col("last") == part).where("off is not null").select(F.col("key").alias("a"), "off"), "a")
        joined = joined.select("b", "key", (F.col("own") / F.col("off")).alias("more"))
        joined = joined.join(pairs.where(F.col("first") == part).where("p2 is not null").select(F.col("key").alias("b"), "p2"), "b")
        return joined.select("key", F.lit(part).cast("byte").alias("kind"), F.log1p(F.col("more") / F.col("p2")).alias("here"), F.lit(0.0).alias("next"))

    model = Model(
        write_stage(words, "model-1"),
        pairs.select("key", F.col("first").alias("kind"), F.coalesce(F.ln("p2") - F.ln("lower"), F.lit(0.0)).alias("here"), F.coalesce(back, F.lit(0.0)).alias("next")),
        _union([write_stage(triples(part), "model-3") for part in range(parts)]),
        parts,
    )
    return model, unseen


def surprise(rows: DataFrame, model: Model, unseen: float) -> DataFrame:
    """rows (row, text and other columns) without text, with n_words and nats, the words' summed negative log-probability.

    Rows with equal row must have equal text. Every run of one, two and three words meets its table by one inner join and adds to its
    row's sum; a table that is too large to broadcast meets the runs class by class, so that few of either are shuffled at a time."""
    sums = []
    for n, table in ((1, model.words), (2, model.pairs), (3, model.triples)):
        small = table.count() <= MOST_BROADCAST
        runs = _runs(rows.select("row", hashes_of(F.col("text")).alias("hashes")), n, "row")
        for part in range(1 if small else model.parts):
            key = F.xxhash64(*[f"w{k}" for k in range(n)]) if n > 1 else F.col("w0")
            some = runs if small else runs.where(_kind(f"w{max(0, n - 2)}", model.parts) == part)
            keyed = some.select("row", key.alias("key"), F.col("next").isNotNull().alias("more"))
            found = keyed.join(F.broadcast(table) if small else table.where(F.col("kind") == part), "key").groupBy("row")
            sums.append(write_stage(found.agg(F.sum(F.col("here") + F.when(F.col("more"), F.col("next")).otherwise(0.0)).alias("sum")), f"sums-{n}"))
    copies = rows.where("text is not null").groupBy("row").agg(F.count("*").alias("copies"))
    each = _union(sums).groupBy("row").agg(F.sum("sum").alias("sum")).join(copies, "row").select("row", (F.col("sum") / F.col("copies")).alias("each"))
    counted = rows.withColumn("n_words", (F.size(hashes_of(F.col("text"))) - 2).cast("long")).drop("text")
    nats = F.when(F.col("n_words") > 0, -F.coalesce("each", F.lit(0.0)) - F.col("n_words") * unseen)
    return counted.join(_side(write_stage(each, "sums")), "row", "left").withColumn("nats", nats).drop("each")


def judge(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", options: Options = Options()) -> DataFrame:
    """One row per document: id, lang, n_words, log_perplexity (nats per word), threshold, kept. trusted_ids: column id."""
    with lean_disk(docs.sparkSession):
        return _judged(docs, trusted_ids, id_col, text_col, lang_col, options)


def _judged(docs: DataFrame, trusted_ids: DataFrame, id_col: str, text_col: str, lang_col: str, options: Options) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    trust = write_stage(trusted_ids.select("id").where("id is not null").distinct(), "trusted-ids")
    hashed = rows.join(_side(trust), "id", "left_semi").select("id", "text", hashes_of(F.col("text")).alias("hashes")).where(F.size("hashes") > 2)
    aside = held_out(trust.count(), options)
    chosen = hashed.where(~aside)
    if chosen.isEmpty():  # so few are trusted that all of them are held out
        chosen, aside = hashed, F.lit(False)
    if chosen.isEmpty():
        some = F.size(hashes_of(F.col("text"))) - 2
        return rows.select(
            F.col("id").alias(id_col), "lang", some.cast("long").alias("n_words"), F.lit(None).cast("double").alias("log_perplexity"),
            F.lit(None).cast("double").alias("threshold"), (some > 0).alias("kept"),
        )
    # Copies of a text have one perplexity, so a row goes by its text's hash and no text is written.
    hashed_rows = rows.select(F.xxhash64("text").alias("row"), "id", "lang", "text", aside.alias("aside"))
    scored = write_stage(surprise(hashed_rows, *fit(chosen)), "surprise").withColumn("log_perplexity", F.col("nats") / F.col("n_words"))
    scored = scored.withColumn("excess", F.col("log_perplexity") - options.allowance / F.sqrt("n_words"))
    unseen = scored.where("aside and n_words > 0").join(_side(trust), "id", "left_semi")
    # Thousandths of a nat, so that the quantile needs one row per value and language.
    steps = unseen.groupBy("lang", F.round(F.col("excess") * 1000).cast("long").alias("step")).agg(F.count("*").alias("n"))

    def at_quantile(counted: DataFrame, by: list[str]) -> DataFrame:
        up = Window.partitionBy(*by).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
        ranked = counted.withColumn("to", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy(*by)))
        return ranked.where(F.col("to") >= options.quantile * F.col("all")).groupBy(*by).agg((F.min("step") / 1000).alias("threshold"))

    limits = write_stage(at_quantile(steps.where("lang is not null"), ["lang"]), "thresholds")
    overall = at_quantile(steps.groupBy(F.lit(0).alias("every"), "step").agg(F.sum("n").alias("n")), ["every"]).first()
    joined = scored.join(limits, "lang", "left")
    limit = F.coalesce("threshold", F.lit(overall["threshold"] if overall else None).cast("double"))
    return joined.select(
        F.col("id").alias(id_col),
        "lang",
        "n_words",
        "log_perplexity",
        limit.alias("threshold"),
        ((F.col("n_words") > 0) & F.coalesce(F.col("excess") <= limit, F.lit(True))).alias("kept"),
    )
