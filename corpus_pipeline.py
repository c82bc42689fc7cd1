"""The corpus pipeline: each stage applies one operator to all that the stage before kept.

quality_rules, language_id, near_duplicates and decontamination return the kept rows with the columns of documents;
packing returns the packed pieces of what is left.

Defined results: quality rules, languages and benchmark passages are judged row by row, whatever ids rows share and also without
one; near duplicates are judged by id, so that rows of one id go or stay together, and of those that repeat id and text one
stays; rows without an id are copies of nothing but each other. Null, empty and white-space texts fail the quality rules; very long
texts and ties are as the operators say; empty tables pass through; further columns, whatever their names, stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantrank.llm import harmonic, language_id, setsketch, templates, weak_supervision
from variantrank.llm.common import drop_ids, one_of_repeated, unused, write_stage
from variantrank.llm.queries import vocabulary


def _told(docs: DataFrame, judged: list[str], judge) -> DataFrame:
    """docs without the rows that judge rejects. It sees the columns it judges by and, as doc_id, a 128-bit hash of these."""
    values = [x for c in judged for x in (F.col(c).isNull(), F.col(c))]
    told = F.concat(F.hex(F.xxhash64(*values)), F.lit(" "), F.hex(F.xxhash64(F.lit(1), *values)))  # texts are not copied
    rejected = judge(docs.select(told.alias("doc_id"), *judged)).select("doc_id")
    name = unused("_told", docs.columns)
    return drop_ids(docs.withColumn(name, told), rejected.withColumnRenamed("doc_id", name), name, most_broadcast=1 << 19).drop(name)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules accept."""
    return _told(docs, ["text"], lambda rows: weak_supervision.quality(rows).where("not kept"))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear from their text, their declared language and their source."""

    def unclear(rows: DataFrame) -> DataFrame:
        evidence = language_id.evidence_of(rows, "doc_id", "text", F.col("lang"), host=F.col("source"))
        return language_id.identify(evidence).where("not kept").withColumnRenamed("id", "doc_id")

    return _told(docs, ["text", "lang", "source"], unclear)


def keep_representatives(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near duplicates (five-word shingles, similarity 0.8 or more) the document with the smallest id."""
    judged = write_stage(setsketch.near_duplicates(docs, percent=80).select("doc_id", "kept"), "representatives")
    repeated = judged.where("kept").groupBy("doc_id").count().where("count > 1")
    return one_of_repeated(drop_ids(docs, judged.where("not kept")), repeated)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, also not with other figures or names."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _told(docs, ["text"], lambda rows: templates.leaks(rows, benchmark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return harmonic.pack(docs, vocabulary())


STAGES = [
    ("quality_rules", keep_quality),
    ("language_id", keep_identified),
    ("near_duplicates", keep_representatives),
    ("decontamination", keep_uncontaminated),
    ("packing", pack),
]
#: SQL cannot express the tokenizer, nor the sketches; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
