"""Reports of many runs in one folder, safe to break off at any step.

A run first writes its rows under its own id, where nobody looks yet. Then it appends to the manifest, in one file, the people
it has finished, with and without rows. From then on the manifest names this run for them, and readers follow it: a
person's rows come whole from the last run that finished that person. A run that ended before its entry leaves files that no
one reads; the next run finds its people pending as before, and vacuum() removes what no entry names.

    folder/manifest/*.parquet                    fam_id, iid, run, at
    folder/data/run=<id>/kind=<ranked|dropped>/  rows
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantrank.operators.joins import lookup_join
from variantrank.plans.pipeline import Cohort, KeptRun, Options
from variantrank.profiles import CADD16, Profile
from variantrank.sinks import reports, stages

MANIFEST = "fam_id string, iid string, run string, at long"
ENTRY = ["fam_id", "iid"]
KINDS = ("ranked", "dropped")


class Ledger:
    """The reports below ``folder``; one run at a time may write there."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        found = jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(found)

    def manifest(self) -> DataFrame:
        """Every entry ever made; files of an entry that was broken off are not there yet."""
        path = f"{self.folder}/manifest"
        if not self._exists(path):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(path)

    def valid(self) -> DataFrame:
        """(fam_id, iid, run): the run whose rows count for each person who is finished."""
        latest = self.manifest().groupBy(*ENTRY).agg(F.max(F.struct("at", "run")).alias("last"))
        return latest.select(*ENTRY, F.col("last.run").alias("run"))

    def pending(self, pedigree: DataFrame) -> DataFrame:
        """Pedigree lines of people whom no run has finished."""
        return lookup_join(pedigree, self.valid().select("iid"), ["iid"], "left_anti")

    def write(self, run: str, kind: str, rows: DataFrame) -> None:
        """The rows of one kind, under the id of a run that is not in the manifest yet."""
        rows.write.mode("overwrite").parquet(f"{self.folder}/data/run={run}/kind={kind}")

    def commit(self, run: str, people: DataFrame) -> None:
        """From now on ``run`` counts for ``people`` (fam_id, iid), those without rows included.

        People are as many as a pedigree has lines; one task writes their one file, which is there as a whole or not at all.
        """
        last = self.manifest().agg(F.max("at")).first()[0] or 0
        entry = people.select(*ENTRY).distinct().withColumns({"run": F.lit(run), "at": F.lit(last + 1).cast("long")})
        entry.coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    def read(self, kind: str) -> DataFrame | None:
        """The valid rows of one kind; null if no run has finished anybody."""
        valid = self.valid()
        runs = sorted(r["run"] for r in valid.select("run").distinct().collect())
        paths = [f"{self.folder}/data/run={run}/kind={kind}" for run in runs]
        paths = [p for p in paths if self._exists(p)]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", f"{self.folder}/data").parquet(*paths)
        rows = rows.withColumn("run", F.col("run").cast("string"))
        return lookup_join(rows, valid, [*ENTRY, "run"], "left_semi").drop("run", "kind")

    def vacuum(self) -> list[str]:
        """Remove the files of runs that count for nobody; not while another run writes."""
        jvm = self.spark._jvm
        data = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/data")
        system = data.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(data):
            return []
        counted = {r["run"] for r in self.valid().select("run").distinct().collect()}
        gone = [s.getPath() for s in system.listStatus(data)]
        gone = [p for p in gone if p.getName().removeprefix("run=") not in counted]
        for path in gone:
            system.delete(path, True)
        return sorted(p.getName().removeprefix("run=") for p in gone)

    def export(self, kind: str, path: str, profile: Profile, report_all: bool = False, run: str | None = None) -> None:
        """Text reports, one folder per person, of the valid rows; of one run only, if named."""
        rows = self.read(kind)
        if rows is not None and run is not None:
            mine = self.valid().filter(F.col("run") == run).select(*ENTRY)
            rows = lookup_join(rows, mine, ENTRY, "left_semi")
        if rows is not None:
            reports.write_tsv(rows, path, profile, kind, report_all)


def of_people(cohort: Cohort, people: DataFrame) -> Cohort:
    """The cohort cut to some people (lines of its pedigree); calls of others are dropped where they are read."""
    ids = people.select("iid").distinct()

    def mine(table: DataFrame | None) -> DataFrame | None:
        return None if table is None else lookup_join(table, ids, ["iid"], "left_semi")

    return replace(cohort, calls=mine(cohort.calls), pedigree=people, cnv_dels=mine(cohort.cnv_dels), cnv_dups=mine(cohort.cnv_dups))


def run_pending(
    cohort: Cohort,
    ledger: Ledger,
    profile: Profile = CADD16,
    options: Options = Options(),
    folder: str | None = None,
    step: Callable[[str], None] = lambda name: None,
) -> str | None:
    """Rank everybody whom no run has finished, write their reports and enter them; the id of the run, or null if nobody was.

    Calls meet sites once, in ``folder`` (or a new one in the shared folder), which is removed in the end. ``step`` is told what
    has just been done.
    """
    spark = ledger.spark
    people = stages.kept(ledger.pending(cohort.pedigree), stages.new_folder(spark, "pending"))
    if people.isEmpty():
        return None
    run, folder = uuid.uuid4().hex, folder or stages.new_folder(spark, "run")
    made = KeptRun(of_people(cohort, people), profile, options, folder)
    for kind, rows in zip(KINDS, (made.ranked(), made.dropped()), strict=True):
        ledger.write(run, kind, rows)
        step(kind)
    ledger.commit(run, people)
    step("entered")
    stages.remove(spark, folder)
    return run
