import pyspark.sql.classic.dataframe as classic
import pytest
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from variantrank.llm import harmonic, language_id, setsketch
from variantrank.llm.common import TEXTS_PER_BATCH, arrow_rows

NAME = "spark.sql.execution.arrow.maxRecordsPerBatch"


def identified(docs):
    return language_id.identify(language_id.evidence_of(docs, "doc_id", "text", F.col("lang"), host=F.col("source")))


def packed(docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return harmonic.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.mark.parametrize("run", [identified, packed, setsketch.near_duplicates])
def test_whole_texts_reach_workers_in_small_batches(spark, monkeypatch, run):
    """No batch of texts that a task hands its worker grows with the task's rows, and the session stays as it was."""
    rows, large = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    plain, before = classic.DataFrame.mapInArrow, spark.conf.get(NAME)

    def counted(self, func, *args, **more):
        def watched(batches):
            for batch in batches:
                rows.add(batch.num_rows)
                large.add(int(batch.num_rows > 512))
                yield batch

        return plain(self, lambda batches: func(watched(batches)), *args, **more)

    monkeypatch.setattr(classic.DataFrame, "mapInArrow", counted)
    made = [(i, prose(i, 20), "en", f"s{i % 3}") for i in range(1300)]  # noqa: F405
    found = run(documents(spark, made).coalesce(1))  # noqa: F405
    assert found.count() >= 1300
    assert rows.value >= 1300 and large.value == 0
    assert spark.conf.get(NAME) == before


def test_a_smaller_limit_of_the_session_holds_and_comes_back(spark):
    before = spark.conf.get(NAME)
    try:
        for own, inside in (("100", "100"), ("100000", str(TEXTS_PER_BATCH)), ("0", str(TEXTS_PER_BATCH))):
            spark.conf.set(NAME, own)
            with pytest.raises(KeyError), arrow_rows(spark, TEXTS_PER_BATCH):
                assert spark.conf.get(NAME) == inside
                raise KeyError
            assert spark.conf.get(NAME) == own
    finally:
        spark.conf.set(NAME, before)
