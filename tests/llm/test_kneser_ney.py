import math
import time
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from variantrank.llm import kneser_ney as kn


def words(text):
    return [w[:-1] if w[-1] in ".," else w for w in (text or "").lower().split() if w not in ".,"]


def discounts(counts):
    n = Counter(counts.values())
    n1, n2, n3, n4 = (max(float(n[k]), 0.5) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return [min(max(k - (k + 1) * y * b / a, 0.05 * k), 0.95 * k) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


def brute(trained):
    """A function to the log-probability of a word after two others, by the textbook formulas."""
    c3 = Counter()
    for text in trained:
        ws = ["<", "<", *words(text)]
        c3.update(zip(ws, ws[1:], ws[2:], strict=False))
    c2 = Counter((v, w) for _, v, w in c3)
    c1 = Counter(w for _, w in c2)
    tables, totals, left = [c3, c2, c1], [], []
    for c in tables:
        d, total, off = discounts(c), defaultdict(float), defaultdict(float)
        for gram, n in c.items():
            context = gram[:-1] if isinstance(gram, tuple) else ()
            total[context] += n
            off[context] += d[min(n, 3) - 1]
        totals.append((d, total))
        left.append({k: off[k] / total[k] for k in total})

    def p(order, gram):
        if order == 3:
            return 1 / (len(c1) + 1)
        c, (d, total) = tables[order], totals[order]
        key, context = (gram if len(gram) > 1 else gram[0]), gram[:-1]
        lower = p(order + 1, gram[1:])
        if context not in total:
            return lower
        n = c[key]
        return (n - d[min(n, 3) - 1] if n else 0) / total[context] + left[order][context] * lower

    return lambda u, v, w: math.log(p(0, (u, v, w)))


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_perplexity_equals_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(kn, "MOST_BROADCAST", broadcast)
    trained = [prose(i, 80) for i in range(12)]  # noqa: F405
    texts = [*trained[:2], prose(50, 40), "the the the", "zzz yyy.", "The of, and", None, ""]  # noqa: F405
    chosen = spark.createDataFrame(list(enumerate(trained)), "id long, text string").select("id", kn.hashes_of(F.col("text")).alias("hashes"))
    rows = spark.createDataFrame([(i, i, "en", t) for i, t in enumerate(texts)], "row long, id long, lang string, text string")
    got = {r.id: r for r in kn.surprise(rows, *kn.fit(chosen)).collect()}
    logp = brute(trained)
    for i, text in enumerate(texts):
        ws = ["<", "<", *words(text)]
        assert got[i].n_words == len(ws) - 2
        if len(ws) > 2:
            assert math.isclose(got[i].nats, -sum(logp(*g) for g in zip(ws, ws[1:], ws[2:], strict=False)), rel_tol=1e-9)


def test_probabilities_sum_to_one():
    trained = [prose(i, 50) for i in range(5)]  # noqa: F405
    logp, every = brute(trained), {w for t in trained for w in words(t)}
    for u, v in (("<", "<"), ("the", "of"), ("zzz", "the"), ("a", "b")):
        assert math.isclose(sum(math.exp(logp(u, v, w)) for w in every) + math.exp(logp(u, v, "never")), 1, rel_tol=1e-9)


def test_judgement(spark):
    rows = [(i, prose(i, 120), "en") for i in range(80)] + [(100 + i, " ".join(f"q{i}x{k}" for k in range(60)), "en") for i in range(5)]  # noqa: F405
    rows += [(200, prose(200, 120), "zz"), (201, prose(201, 120), None), (202, None, "en"), (203, "", "en"), (None, prose(5, 50), "en")]  # noqa: F405
    docs = spark.createDataFrame([(*r, "x", "x") for r in rows], "doc_id long, text string, lang string, n_words string, row string")
    trusted = spark.range(60).toDF("id")
    got = {r.doc_id: r for r in kn.judge(docs, trusted).collect()}
    assert sum(got[i].kept for i in range(80)) >= 78
    assert not any(got[100 + i].kept for i in range(5))
    assert got[200].kept and got[201].kept and not got[202].kept and not got[203].kept
    bare = {r.doc_id: r for r in kn.judge(docs, trusted.where("id < 0")).collect()}
    assert bare[0].kept and bare[0].n_words == 120 and bare[0].log_perplexity is None and not bare[202].kept
    assert kn.judge(docs.where("false"), trusted).count() == 0


def test_all_trusted_documents_are_counted(spark, monkeypatch):
    """Over 1,500 trusted documents and 500,000 words, every one that is not held out is in the model."""
    counted, fit = [], kn.fit
    monkeypatch.setattr(kn, "fit", lambda chosen: counted.append(chosen.select("id").collect()) or fit(chosen))
    rows = [(i, f"w{i} " + "a b c d " * 50, "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.log_perplexity for r in kn.judge(docs, spark.range(4000).toDF("id")).collect()}
    ids = [r.id for r in counted[0]]
    assert len(ids) == len(set(ids)) and 2850 < len(ids) < 3150
    assert max(got[i] for i in ids) < min(got[i] for i in set(got) - set(ids))


def test_a_very_long_trusted_text_ends_nothing(spark):
    """A trusted text of over 500,000 words is counted like any other, alone and before others."""
    rows = [(0, "a b c d e " * 100_001, "en"), *((1 + i, prose(i, 60), "en") for i in range(20)), (100, "a b c d", "en")]  # noqa: F405
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    alone = {r.doc_id: r for r in kn.judge(docs, spark.range(1).toDF("id")).collect()}
    assert alone[0].n_words == 500_005 and all(r.log_perplexity is not None for r in alone.values())
    assert alone[100].log_perplexity < min(alone[1 + i].log_perplexity for i in range(20))
    every = {r.doc_id: r for r in kn.judge(docs, spark.range(21).toDF("id")).collect()}
    assert all(r.log_perplexity is not None for r in every.values()) and every[1].threshold is not None


def shuffle_files(spark):
    """Names of the shuffle files of this session."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {file.name for folder in folders for file in Path(folder).rglob("shuffle_*")}


def test_little_stays_on_disk(spark, monkeypatch):
    """No stage holds texts or a row per word, and no shuffle file outlives its job."""
    stages, write_stage = [], kn.write_stage

    def watched(df, name):
        written = write_stage(df, name)
        stages.append((name, written.columns, written.count()))
        return written

    monkeypatch.setattr(kn, "MOST_BROADCAST", 0)
    monkeypatch.setattr(kn, "PARTS", 2)
    monkeypatch.setattr(kn, "write_stage", watched)
    rows = [(i, "a b c d " * 50, "en") for i in range(60)]
    before = shuffle_files(spark)
    judged = kn.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.range(40).toDF("id"))
    for _ in range(50):  # files are removed in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert stages and all("text" not in columns and n <= 60 for _, columns, n in stages)
    assert judged.count() == 60


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_copies_have_one_score(spark, monkeypatch, broadcast):
    monkeypatch.setattr(kn, "MOST_BROADCAST", broadcast)
    monkeypatch.setattr(kn, "PARTS", 2)
    rows = [(i, prose(i, 60), "en") for i in range(30)]  # noqa: F405
    copies = [(i, prose(i % 3, 60), "fr") for i in range(100, 112)]  # noqa: F405
    schema, trusted = "doc_id long, text string, lang string", spark.range(20).toDF("id")
    alone = {r.doc_id: r for r in kn.judge(spark.createDataFrame(rows, schema), trusted).collect()}
    both = {r.doc_id: r for r in kn.judge(spark.createDataFrame(rows + copies, schema), trusted).collect()}
    assert len(both) == 42
    for i, _, _ in rows + copies:
        one = alone[i if i < 100 else i % 3]
        assert both[i].n_words == 60 and math.isclose(both[i].log_perplexity, one.log_perplexity, rel_tol=1e-9)
