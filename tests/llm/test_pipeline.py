import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from conftest import *  # noqa: F403
from pyspark.sql import functions as F
from test_dedup import brute, edited

import corpus_pipeline
from variantrank.llm import quotes, templates, weak_supervision
from variantrank.llm.common import drop_ids

pytest.importorskip("public_tokenizers")
REPO = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean prose, junk, exact and near copies, and documents that hold a benchmark item."""
    items = [(i, prose(900 + i, 30)) for i in range(4)]  # noqa: F405
    rows = [(i, prose(i, 120), "en", f"s{i % 3}") for i in range(60)]  # noqa: F405
    rows += [(100 + i, prose(i, 120), "en", "s1") for i in range(5)]  # noqa: F405
    rows += [(200 + i, edited(prose(10 + i, 120), i, 2), "en", "s1") for i in range(5)]  # noqa: F405
    rows += [(300 + i, prose(70 + i, 90) + "\n" + items[i][1], "en", "s2") for i in range(4)]  # noqa: F405
    rows += [(400 + i, " | ".join(prose(80 + i, 90).split()), "en", "s2") for i in range(3)]  # noqa: F405
    rows += [(500, None, "en", "s0"), (501, "", None, None), (502, "word " * 300, "en", "s0")]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def test_stages(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids, texts = {r[0] for r in rows}, {r[0]: r[1] for r in rows}
    gone = [{400, 401, 402, 500, 501, 502}, set(), None, {300, 301, 302, 303}]
    for (name, stage), lost in zip(corpus_pipeline.STAGES[:-1], gone, strict=True):
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        if lost is None:
            classes = brute([(i, texts[i]) for i in sorted(ids)], 80)
            lost = {i for i, (_, c) in classes.items() if c != i}
            assert lost >= set(range(100, 105)) | set(range(200, 205))
        got = Counter(r.doc_id for r in kept.collect())
        assert got == Counter(ids - lost), name
        ids -= lost
        docs = kept
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in pieces.collect()} == ids
    whole = corpus_pipeline.run(spark, folder).select("doc_id", "start", "length", "ids_crc32").collect()
    assert Counter(whole) == Counter(pieces.select("doc_id", "start", "length", "ids_crc32").collect())


def test_empty_corpus(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, corpus[0]).count() == 0, name


def test_drop_ids(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "doc_id long, _other string")
    rejected = spark.createDataFrame([(1,), (None,)], "doc_id long")
    for most in (1 << 20, 0):
        assert [r[1] for r in drop_ids(docs, rejected, most_broadcast=most).collect()] == ["c"]


def test_rows_are_judged_one_by_one(spark, corpus):
    """A rejected row takes no other row of its id, or without an id, along; of a repeated row one stays."""
    good, other, third = (prose(700 + i, 120) for i in range(3))  # noqa: F405
    rows = [(1, good, "en", "s1"), (1, "junk " * 200, "en", "s1"), (None, other, "en", "s1"), (None, None, "en", "s1"), (2, third, "en", "s1"), (2, third, "en", "s1")]
    docs = documents(spark, rows).withColumns({"_told": F.lit(1), "_id": F.lit(2)})  # noqa: F405
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, corpus[0])
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, None, 2, 2])
    one = stages["near_duplicates"](spark, kept, corpus[0])
    assert one.columns == docs.columns
    assert Counter((r.doc_id, r.text, r.source) for r in one.collect()) == Counter([(1, good, "s1"), (None, other, "s1"), (2, third, "s1")])


def test_main_paths_run_no_python(spark, odd):
    talk = odd.selectExpr("doc_id AS conv_id", "n_chars AS turn", "source AS role", "text")
    plans = [templates.leaks(odd, odd.selectExpr("doc_id AS item_id", "text")), weak_supervision.quality(odd), quotes.link(talk)]
    for df in plans:
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_the_rest_works_without_this_part(tmp_path):
    """With the folder and the pipeline gone, the entry still imports and lists the other queries."""
    for name in ("__spark_entry__.py", "workload", "variantrank"):
        (tmp_path / name).symlink_to(REPO / name) if name != "variantrank" else (tmp_path / name).mkdir()
    for part in (REPO / "variantrank").iterdir():
        if part.name != "llm":
            (tmp_path / "variantrank" / part.name).symlink_to(part)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'rank_variants' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    entry = (REPO / "__spark_entry__.py").read_text()
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text(entry)
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
