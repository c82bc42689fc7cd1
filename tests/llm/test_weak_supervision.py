import re

import pytest
from conftest import *  # noqa: F403

from variantrank.llm import weak_supervision as ws


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 500 else None
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
        None if again is None else len(again),
    )


def test_measures(odd):
    texts = {(r.doc_id, r.text) for r in odd.collect()}
    found = ws.measure(odd.withColumn("doc", odd.doc_id)).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for i, text in texts:
        if i is not None:
            want = brute(text)
            got = (by_id[i].n_words, by_id[i].word_chars, by_id[i].n_symbols, by_id[i].n_dup_lines, by_id[i].n_repeat_words)
            assert got[:4] == want[:4]
            assert want[4] is None or got[4] == want[4]


@pytest.mark.parametrize("text,repeated", [("a b c a b c", 6), ("a a a", 0), ("a a a a", 4), ("a b", 0), ("a b c d a b c", 6), ("", 0)])
def test_repeated_words(spark, text, repeated):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert ws.measure(df).first().n_repeat_words == repeated


def test_junk_goes_and_prose_stays(spark):
    good = [(i, prose(i, 150)) for i in range(60)]  # noqa: F405
    junk = [(100 + i, " | ".join(prose(i, 90).replace(".", "").split())) for i in range(4)]  # noqa: F405
    junk += [(200 + i, " ".join(w.upper() + "!!" for w in prose(i, 90).split())) for i in range(4)]  # noqa: F405
    junk += [(300, "same words here " * 40), (301, "short text"), (302, None)]
    got = {r.doc_id: r.kept for r in ws.quality(spark.createDataFrame(good + junk, "doc_id long, text string")).collect()}
    assert all(got[i] for i, _ in good)
    assert not any(got[i] for i, _ in junk)


def test_accuracies_follow_agreement(spark):
    """A rule that contradicts all others on half of the documents is trusted least."""
    rows = [([1] * 7 + [1 if i % 2 else -1],) for i in range(200)] + [([-1] * 7 + [1 if i % 2 else -1],) for i in range(60)]
    model = ws.fit(spark.createDataFrame(rows, "votes array<int>"))
    assert 0.7 < model.prior < 0.85
    assert min(model.bad[:7]) > model.bad[7]


def test_odd_and_empty(odd, none):
    got = ws.quality(odd).collect()
    assert len(got) == odd.count()
    assert not any(r.kept for r in got if r.doc_id in (100, 101, 102, 106))
    assert len({r.kept for r in got if r.doc_id == 105}) == 1
    assert ws.quality(none).count() == 0
