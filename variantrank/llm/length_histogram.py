"""Token counts from an exact length histogram.

Every text is encoded once and counts only as one document of its length, so the corpus shrinks to (group, length, number
of documents) inside each task. Sums from the long end of that table then answer, for every context limit at once, how
many documents reach it, how many tokens remain when documents are cut there, totals and quantiles.

Defined results: null and empty texts have length 0; a null group is a group of its own; copies count each; an empty
table gives an empty histogram; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from variantrank.llm.tokens import encoder


def histogram(docs: DataFrame, vocabulary: str, group_col: str, text_col: str = "text") -> DataFrame:
    """(group, length, n_docs): at most one row per group and length leaves a task."""

    def count(batches):
        encode, found = encoder(vocabulary), Counter()
        for batch in batches:
            for group, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found[group, len(encode(text.as_py())) // 4] += 1
        groups, lengths = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array(lengths, pa.int64()), pa.array(found.values(), pa.int64())], ["group", "length", "n_docs"])

    rows = docs.select(F.col(group_col).cast("string"), text_col)
    counted = rows.mapInArrow(count, "group string, length long, n_docs long")
    return counted.groupBy("group", "length").agg(F.sum("n_docs").alias("n_docs"))


def totals(counted: DataFrame) -> DataFrame:
    """For each group and length L that occurs: documents and tokens at L, of documents of at least L tokens (docs_from,
    tokens_from), all tokens when documents are cut at L (cut_tokens), and the share of documents of at most L tokens.

    A window holds one row per length that occurs in a group; that is bounded by the longest document, not by the corpus.
    """
    up = Window.partitionBy("group").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("group").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    tokens = F.col("n_docs") * F.col("length")
    return (
        counted.withColumn("n_tokens", tokens)
        .withColumn("docs_from", F.sum("n_docs").over(down))
        .withColumn("tokens_from", F.sum("n_tokens").over(down))
        .withColumn("docs_to", F.sum("n_docs").over(up))
        .withColumn("tokens_to", F.sum("n_tokens").over(up))
        .withColumn("cut_tokens", F.col("tokens_to") + F.col("length") * (F.col("docs_from") - F.col("n_docs")))
        .withColumn("share_to", F.col("docs_to") / (F.col("docs_to") + F.col("docs_from") - F.col("n_docs")))
    )


def cut_total(table: DataFrame, limit: int) -> DataFrame:
    """(group, tokens): all tokens when documents are cut at any limit, from the table of totals()."""
    kept = F.least(F.col("length"), F.lit(limit)) * F.col("n_docs")
    return table.groupBy("group").agg(F.sum(kept).alias("tokens"))


def quantile(table: DataFrame, share: float) -> DataFrame:
    """(group, length): the least length that at least this share of the group's documents does not exceed."""
    return table.where(F.col("share_to") >= share).groupBy("group").agg(F.min("length").alias("length"))
