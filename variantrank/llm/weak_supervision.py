"""Quality rules by weak supervision: rules vote or abstain, their accuracies are estimated without labels by
expectation-maximisation, and the posterior probability of good quality decides.

Every rule sees one document and votes good (1), bad (-1) or abstains (0). A document then is its pattern of votes; with
K rules there are at most 3^K patterns, so the corpus shrinks to a bounded table of pattern counts before the first
iteration, whatever its size. An iteration is one aggregation over that table.

Defined results: a null text counts as empty; empty texts have no words and fail the base; copies get the same verdict;
an empty table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantrank.llm.common import GAP, let, words_of, write_stage

#: (rule, votes good if, votes bad if); integer arithmetic over the columns of measure(), valid in Spark and in DuckDB.
RULES = [
    ("symbols", "100 * n_symbols <= 2 * n_words", "100 * n_symbols > 10 * n_words"),
    ("symbol_runs", "100 * n_symbol_runs <= n_words", "100 * n_symbol_runs > 6 * n_words"),
    ("punctuation", "100 * n_marks <= 6 * word_chars", "100 * n_marks > 10 * word_chars"),
    ("repeats", "100 * n_repeat_words <= 15 * n_words", "100 * n_repeat_words > 35 * n_words"),
    ("lines", "n_dup_lines = 0", "100 * n_dup_lines > 30 * n_lines"),
    ("exclamation", "100 * n_exclaims <= 2 * n_words", "100 * n_exclaims > 15 * n_words"),
    ("capitals", "100 * n_upper <= 10 * word_chars", "100 * n_upper > 30 * word_chars"),
    ("length", "n_words >= 80", "n_words < 50"),
]
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


@dataclass(frozen=True)
class Model:
    """prior: share of good documents. good[k], bad[k]: how often rule k is right when it votes on a good, a bad one."""

    prior: float
    good: tuple[float, ...]
    bad: tuple[float, ...]


#: Before the first iteration; also what the pseudo-votes say.
START = Model(0.8, (0.98,) * len(RULES), (0.3,) * len(RULES))
#: Bounds of the accuracies on good and on bad documents. A rule hardly ever calls a good document bad, while one kind of
#: junk breaks one or two rules and passes the others; as LEAST_BAD >= 1 - LEAST_GOOD no rule turns into its opposite.
LEAST_GOOD, LEAST_BAD, MOST = 0.97, 0.1, 0.995
ITERATIONS, PSEUDO_VOTES, KEEP_FROM = 12, 20.0, 0.5


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with what the rules look at, computed from the whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def without(pattern: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")

    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.select(
        F.col(id_col),
        let(words_of(text), lambda ws: F.struct(F.size(ws).alias("n"), _repeated(ws).alias("again"))).alias("_words"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again"))).alias("_lines"),
        F.length(F.regexp_replace(text, GAP, "")).cast("long").alias("word_chars"),
        without("[#*$%&|<>]+").alias("n_symbols"),
        without("!+").alias("n_exclaims"),
        without(r"\p{Lu}+").alias("n_upper"),
        F.regexp_count(text, F.lit("[#*$%&|<>]+")).cast("long").alias("n_symbol_runs"),
        without(r"[\p{P}\p{S}]+").alias("n_marks"),
    )
    return counted.select(
        id_col,
        F.col("_words.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("_lines.again").cast("long").alias("n_dup_lines"),
        F.col("_words.again").cast("long").alias("n_repeat_words"),
        F.col("_lines.n").cast("long").alias("n_lines"),
        "n_exclaims",
        "n_upper",
        "n_symbol_runs",
        "n_marks",
    )


def _repeated(words: Column) -> Column:
    """How many words stand in a three-word window that occurs twice or more; words hold no space, so a window is its words joined by spaces."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")),
    )

    def covered(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda x, k: (F.get(ordered, k - 1)["w"] == x["w"]) | (F.get(ordered, k + 1)["w"] == x["w"]),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    return F.when(F.size(words) >= 4, let(F.sort_array(windows), covered)).otherwise(0)


def vote(measured: DataFrame) -> DataFrame:
    """Add votes: one of 1, -1, 0 for each rule."""
    ballots = [
        F.when(F.expr(good), F.lit(1)).when(F.expr(bad), F.lit(-1)).otherwise(F.lit(0)) for _, good, bad in RULES
    ]
    return measured.withColumn("votes", F.array(*ballots))


def posterior(votes: Column, model: Model) -> Column:
    """Probability that a document with these votes is good.

    The weights of all votes stand in one constant array, so that every iteration runs the same compiled code.
    """
    weights = [math.log(model.prior / (1 - model.prior))]
    for good, bad in zip(model.good, model.bad, strict=True):
        weights += [math.log((1 - good) / bad), 0.0, math.log(good / (1 - bad))]
    table = F.array(*[F.lit(w) for w in weights])
    odds = F.get(table, F.lit(0))
    for k in range(len(model.good)):
        odds = odds + F.get(table, 3 * k + 2 + votes[k])
    return 1 / (1 + F.exp(-odds))


def fit(voted: DataFrame, iterations: int = ITERATIONS) -> Model:
    """Expectation-maximisation over the table of vote patterns (3^K rows at most); K rows of sums come back each time.

    Accuracies stay within their bounds; pseudo-votes steady rules that seldom vote.
    """
    patterns = write_stage(voted.groupBy("votes").agg(F.count("*").cast("double").alias("n")), "vote-patterns").coalesce(1)
    model = START
    for _ in range(iterations):
        weighed = patterns.select("votes", "n", (F.col("n") * posterior(F.col("votes"), model)).alias("g"))
        ballots = weighed.select("n", "g", (F.col("n") - F.col("g")).alias("b"), F.posexplode("votes").alias("k", "v"))
        sums = ballots.groupBy("k").agg(
            F.sum("n").alias("n"),
            F.sum("g").alias("g"),
            F.sum(F.when(F.col("v") == 1, F.col("g")).otherwise(0.0)).alias("g_right"),
            F.sum(F.when(F.col("v") != 0, F.col("g")).otherwise(0.0)).alias("g_all"),
            F.sum(F.when(F.col("v") == -1, F.col("b")).otherwise(0.0)).alias("b_right"),
            F.sum(F.when(F.col("v") != 0, F.col("b")).otherwise(0.0)).alias("b_all"),
        )
        rows = {r["k"]: r for r in sums.collect()}
        if not rows:
            return START

        def rate(kind: str, k: int, least: float, said: float, rows=rows) -> float:
            right, every = rows[k][f"{kind}_right"], rows[k][f"{kind}_all"]
            return min(MOST, max(least, (right + said * PSEUDO_VOTES) / (every + PSEUDO_VOTES)))

        model = Model(
            (rows[0]["g"] + START.prior * PSEUDO_VOTES) / (rows[0]["n"] + PSEUDO_VOTES),
            tuple(rate("g", k, LEAST_GOOD, START.good[k]) for k in range(len(RULES))),
            tuple(rate("b", k, LEAST_BAD, START.bad[k]) for k in range(len(RULES))),
        )
    return model


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: measures, votes, quality (posterior), base_failed and kept.

    The measures are written once; votes, counts of patterns and verdicts then read only those narrow rows.
    """
    voted = vote(write_stage(measure(docs, id_col, text_col), "quality-measures"))
    probability = posterior(F.col("votes"), fit(voted))
    return (
        voted.withColumn("quality", probability)
        .withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM))
    )
