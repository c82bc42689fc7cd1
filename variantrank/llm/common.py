"""Helpers the operators share: written stages, word patterns, connected components, gapless numbering."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs without ASCII white space (Java and SQL regular expression of the gaps between them).
GAP = r"[\x20\x09-\x0D]+"
#: Rows that one task numbers at a time in number_rows().
ROWS_PER_BLOCK = 250_000
#: Rows of an Arrow batch of whole texts: some megabytes, which the JVM and a Python worker both hold.
TEXTS_PER_BATCH = 512


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir, or a temporary one where it is unset, on a single machine only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    if not folder:
        folder = tempfile.mkdtemp(prefix="stages-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """What runs inside hands Python workers at most so many rows at a time, or fewer if the session says so."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(most, int(before)) if int(before) > 0 else most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def lean_disk(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind once a job's rows are written or collected, writes Parquet with zstd, and
    hashes the side of a join, instead of sorting both, where adaptive execution measures it up to 64 MB in every partition.

    The session's settings are put back afterwards; a plan made inside and run again later shuffles anew."""
    wanted = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    }
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def write_stage(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back; with batch_rows, in Arrow batches of so many rows at most.

    Cuts the lineage at a place that outlives any executor; a retried or repeated read costs a scan of the file only.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with arrow_rows(df.sparkSession, batch_rows) if batch_rows else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, columns: list[str]) -> str:
    """name, with as many underscores behind it as it takes to be none of columns."""
    while name in columns:
        name += "_"
    return name


def _ids(rows: DataFrame, id_col: str, name: str, most_broadcast: int) -> DataFrame:
    """The distinct ids of rows, written, as a column name that is broadcast up to most_broadcast ids."""
    ids = write_stage(rows.select(F.col(id_col).alias(name)).distinct(), "ids")
    return F.broadcast(ids) if ids.count() <= most_broadcast else ids


def drop_ids(docs: DataFrame, rejected: DataFrame, id_col: str = "doc_id", most_broadcast: int = 1 << 20) -> DataFrame:
    """docs without the rows whose id (or null) is in rejected; up to most_broadcast ids are broadcast, more are joined by
    a shuffle. Rows with one id go or stay together."""
    name = unused("_id", docs.columns)
    return docs.join(_ids(rejected, id_col, name, most_broadcast), F.col(id_col).eqNullSafe(F.col(name)), "left_anti")


def one_of_repeated(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = 1 << 20) -> DataFrame:
    """docs with one row, the least by its other columns, of those that share id and text. repeated: ids that several rows
    have; only these rows are shuffled."""
    name, rest = unused("_id", docs.columns), unused("_rest", docs.columns)
    ids = _ids(repeated, id_col, name, most_broadcast)
    same, others = F.col(id_col).eqNullSafe(F.col(name)), [c for c in docs.columns if c not in (id_col, text_col)]
    least = F.min(F.struct(F.lit(0).alias(rest), *others)).alias(rest)
    one = docs.join(ids, same, "left_semi").groupBy(id_col, text_col).agg(least)
    return docs.join(ids, same, "left_anti").union(one.select(*[F.col(rest)[c].alias(c) if c in others else F.col(c) for c in docs.columns]))


def words_of(text: Column) -> Column:
    """The words of a text as an array; null counts as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def let(value: Column, body) -> Column:
    """body(value) with value computed once per row, also inside lambda functions."""
    return F.transform(F.array(value), body)[0]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, label): the smallest id reachable over undirected edges (a, b), for every id in an edge.

    Each round takes the smallest label among neighbours and then the label's own label, so distances shrink at least
    by half. A round is aggregations (combined before the shuffle) and equi-joins, which adaptive execution splits when
    one id has many neighbours: what they read is written first, as the sides of a join need shuffles of their own for
    that. Only whether labels changed comes to the driver.
    """
    both = write_stage(
        edges.select(F.col("a").alias("id"), F.col("b").alias("other"))
        .union(edges.select(F.col("b"), F.col("a")))
        .where("id != other")
        .distinct(),
        f"{name}-edges",
    )
    labels = both.groupBy("id").agg(F.least(F.min("other"), F.first("id")).alias("label"))
    labels = write_stage(labels, f"{name}-labels")
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("other"), "label"), "other")
            .groupBy("id")
            .agg(F.min("label").alias("near"))
        )
        hooked = write_stage(labels.join(near, "id").select("id", F.least("label", "near").alias("low"), "label"), f"{name}-hooked")
        up = hooked.select(F.col("id").alias("low"), F.col("low").alias("next"))
        jumped = write_stage(
            hooked.join(up, "low", "left").select("id", F.least("low", "next").alias("label"), F.col("label").alias("old")),
            f"{name}-labels",
        )
        labels = jumped.select("id", "label")
        if jumped.where("label != old").isEmpty():
            return labels


def number_rows(df: DataFrame, group: list[str], order: list[str], out: str, ordered: bool = False) -> DataFrame:
    """Add out: 0, 1, 2, ... within each group, without gaps; with ordered, in the order of the order columns.

    A group of any size lies in many blocks, ranges of the order or else hashes of it, is numbered in each block and
    shifted by the sizes of the blocks before, so no task sorts a whole group. Rows equal in all order columns are
    numbered in any order.
    """
    blocks = max(64, df.count() // ROWS_PER_BLOCK + 1)
    if ordered:
        dealt = write_stage(df.repartitionByRange(blocks, *group, *order).withColumn("_block", F.spark_partition_id()), "ranges")
    else:
        dealt = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*group, "_block")
        .agg(F.count("*").alias("_rows"))
        .select(
            *[F.col(c).alias(f"_{c}") for c in group],
            F.col("_block").alias("_at"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        )
    )
    local = dealt.withColumn("_n", F.row_number().over(Window.partitionBy(*group, "_block").orderBy(*order)))
    same = F.col("_block") == F.col("_at")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return (
        local.join(starts, same)
        .withColumn(out, (F.col("_start") + F.col("_n") - 1).cast("long"))
        .drop("_block", "_n", "_at", "_start", *[f"_{c}" for c in group])
    )
