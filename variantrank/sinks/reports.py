"""Ranked and dropped reports, and the list of people already done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantrank.profiles import Profile
from variantrank.sinks import stages

ROWS_PER_FILE = 2_000_000

# Endings of the report names.
ENDINGS = {
    "ranked": "_PSAP.txt",
    "ranked_all": "_PSAP_Force.txt",
    "dropped": "_missing_data.txt",
}


def ranked_report(ranked: DataFrame, profile: Profile) -> DataFrame:
    """Ranked rows under their reported names."""
    return ranked.select(*[F.col(c).alias(n) for c, n in profile.ranked_columns])


def dropped_report(dropped: DataFrame, profile: Profile) -> DataFrame:
    return dropped.select(*[F.col(c).alias(n) for c, n in profile.dropped_columns])


def report_name(kind: str, report_all: bool = False):
    """Name of a person's report."""
    ending = ENDINGS["ranked_all" if kind == "ranked" and report_all else kind]
    return F.concat("fam_id", F.lit("_"), "iid", F.lit(ending))


def _clear(spark: SparkSession, path: str, folders: DataFrame) -> None:
    """Remove the folders (column ``folder``, below ``path``) of people who have no rows any more."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for row in folders.toLocalIterator():
        stale = jvm.org.apache.hadoop.fs.Path(root, row["folder"])
        if system.exists(stale):
            system.delete(stale, True)


def _replace(named: DataFrame, path: str, by: list[str], without: DataFrame | None, options: dict, kind: str) -> None:
    """Write one folder per value of ``by``; folders of other people stay, those of people without rows go.

    A person's rows are bounded by the genome, so they are sorted as a whole in one task.
    """
    writer = named.write.mode("overwrite").partitionBy(*by).format(kind)
    writer.option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", ROWS_PER_FILE).options(**options).save(path)
    if without is not None:
        parts = [F.concat(F.lit(f"{c}="), _path_text(F.col(c))) for c in by]
        _clear(named.sparkSession, path, without.select(F.concat_ws("/", *parts).alias("folder")).distinct())


def _computed_once(rows: DataFrame, people: DataFrame | None) -> tuple[DataFrame, Callable[[], None]]:
    """``rows``, kept in files while they are needed twice: for the reports and to find the people without any."""
    if people is None:
        return rows, lambda: None
    folder = stages.new_folder(rows.sparkSession, "report-rows")
    return stages.kept(rows, folder), lambda: stages.remove(rows.sparkSession, folder)


def _path_text(value: Column) -> Column:
    """A partition value as Spark writes it in a folder name."""
    codes = [*range(1, 32), *map(ord, "\"#%'*/:=?\\{[]^"), 127]
    out = F.regexp_replace(value, "%", "%25")
    for code in codes:
        if chr(code) != "%":
            out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def write_tsv(
    rows: DataFrame, path: str, profile: Profile, kind: str = "ranked", report_all: bool = False, people: DataFrame | None = None
) -> None:
    """One folder per person, named like the report, of tab-separated text with a header.

    Rows of a person are sorted by model and gene, also across files. Reports of people who are not in ``rows`` stay as
    they are, unless ``people`` (fam_id, iid: everyone of the run) names them: then they have no rows now, and go.
    """
    columns = profile.ranked_columns if kind == "ranked" else profile.dropped_columns
    rows, done = _computed_once(rows, people)
    named = rows.select(
        report_name(kind, report_all).alias("report"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(n) for c, n in columns],
    )
    sort = [F.col("report")]
    if kind == "ranked":
        # Reports write a missing model as NA, which sorts after every label.
        sort.append(F.when(F.col("`Dz.Model`") != "NA", F.col("`Dz.Model`")).asc_nulls_last())
    sort.append(F.col(f"`{dict(columns)['gene']}`"))
    without = None
    if people is not None:
        absent = people.join(rows.select("fam_id", "iid").distinct(), ["fam_id", "iid"], "left_anti")
        without = absent.select(report_name(kind, report_all).alias("report"))
    options = {"sep": "\t", "header": True, "quote": "", "emptyValue": ""}
    _replace(named.repartition("report").sortWithinPartitions(*sort), path, ["report"], without, options, "csv")
    done()


def write_parquet(rows: DataFrame, path: str, people: DataFrame | None = None) -> None:
    """Parquet by family and person; a second run replaces only the people it holds.

    The folders carry copies of the ids (``family``, ``person``); ``fam_id`` and ``iid`` stay in the files as text.
    With ``people`` (fam_id, iid: everyone of the run), those without rows lose theirs.
    """
    copies = {"family": F.col("fam_id"), "person": F.col("iid")}
    rows, done = _computed_once(rows, people)
    without = None
    if people is not None:
        without = people.join(rows.select("fam_id", "iid").distinct(), ["fam_id", "iid"], "left_anti").withColumns(copies)
    named = rows.withColumns(copies).repartition("family", "person").sortWithinPartitions("family", "person")
    _replace(named, path, ["family", "person"], without, {}, "parquet")
    done()


def write_done(people: DataFrame, path: str) -> None:
    """Note the people of a finished run, also those without any ranked row."""
    people.select("iid").distinct().write.mode("append").parquet(path)


def pending_people(pedigree: DataFrame, done: DataFrame) -> DataFrame:
    """People without a finished run."""
    return pedigree.join(done.select("iid").distinct(), "iid", "left_anti")
