"""One query per operator over its whole table, and the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantrank.llm import alignment, harmonic, kdtree, kneser_ney, language_id, length_histogram, license_scan, quotes, setsketch, structure_repair, templates, warc, weak_supervision


def vocabulary() -> str:
    """The rank file of the 50k byte-level BPE; the same place on every machine that has the tokenizer files installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its measures, the votes' posterior and the verdict."""
    return weak_supervision.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; the table's own lang column is the declared one and source is the host."""
    docs = table(spark, sf_dir, "documents")
    rows = language_id.evidence_of(docs, "doc_id", "text", F.col("lang"), host=F.col("source"))
    return language_id.identify(rows).withColumnRenamed("id", "doc_id")


def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's language from its visible text, its markup's lang attribute, its address and its host."""
    markup = F.regexp_extract("html", r"(?is)<html[^>]*?\blang\s*=\s*[\"']?([a-z-]+)", 1)
    hidden = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    pages = table(spark, sf_dir, "pages").withColumn("visible", F.regexp_replace(hidden, r"<[^>]*>", " "))
    rows = language_id.evidence_of(pages, "page_id", "visible", markup, address=F.col("url"))
    return language_id.identify(rows).withColumnRenamed("id", "page_id")


def op2_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without its quotes, its parent, and its place in the reply order of its conversation."""
    return quotes.link(table(spark, sf_dir, "conversations"))


def op3_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near duplicates."""
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 1024 tokens."""
    return harmonic.pack(table(spark, sf_dir, "documents"), vocabulary())


def op5_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds, also with other figures or names."""
    return templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_kdtree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards of nearly equal bytes, cut along size, language, source and id."""
    dimensions = {
        "size": F.log2(F.coalesce(F.octet_length("text"), F.lit(0)) + 1),
        "lang": F.crc32(F.col("lang")),
        "source": F.crc32(F.col("source")),
        "id": F.col("doc_id"),
    }
    placed = kdtree.shard(table(spark, sf_dir, "documents"), 16, dimensions)
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's perplexity under the model of trusted documents, those labelled good and not toxic."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select(F.col("doc_id").alias("id"))
    return kneser_ney.judge(table(spark, sf_dir, "documents"), trusted)


def op9_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every language and length that occurs, what cutting there or asking for longer documents would give."""
    docs = table(spark, sf_dir, "documents")
    return length_histogram.totals(length_histogram.histogram(docs, vocabulary(), "lang")).withColumnRenamed("group", "lang")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licences."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers, aligned."""
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), *paths)[0].withColumnRenamed("id", "doc_id")


def op12_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it comes back from WARC archives that hold all of them."""
    path = warc.archive_dir(spark)
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged conversation's faults, its cheapest repair and a digest of the repaired rows."""
    damaged = structure_repair.damage(table(spark, sf_dir, "conversations"))
    return structure_repair.digest(structure_repair.repair(damaged))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "language_of_pages": language_of_pages,
    "op2_quotation_links": op2_quotation_links,
    "op3_setsketch_dedup": op3_setsketch_dedup,
    "op4_harmonic_packing": op4_harmonic_packing,
    "op5_template_leaks": op5_template_leaks,
    "op6_quality_votes": op6_quality_votes,
    "op7_kdtree_shards": op7_kdtree_shards,
    "op8_kneser_ney": op8_kneser_ney,
    "op9_length_histogram": op9_length_histogram,
    "op10_license_scan": op10_license_scan,
    "op11_token_alignment": op11_token_alignment,
    "op12_warc_segments": op12_warc_segments,
    "op13_structure_repair": op13_structure_repair,
}
