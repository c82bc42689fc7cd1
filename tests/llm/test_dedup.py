import random
import re

import numpy as np
from conftest import *  # noqa: F403

from variantrank.llm import setsketch


def sets_of(rows):
    out = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def brute(rows, percent=85):
    sets, parent = sets_of(rows), {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(text, seed, edits):
    pick, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"new{pick.randrange(999)}"
    return " ".join(words)


def near(n=150):
    """Copies of two texts with none to many edits, so that similarities lie on both sides of the threshold."""
    rows = [(i, edited(prose(1 + i % 2, 300), i, i % 14)) for i in range(n)]  # noqa: F405
    return rows + [(1000 + i, prose(100 + i, 50)) for i in range(20)]  # noqa: F405


def test_classes_equal_brute_force(spark, monkeypatch):
    rows = near()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setsketch.near_duplicates(df).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) > 25
    monkeypatch.setattr(setsketch, "BLOCK", 16)  # the same classes when clusters are cut into blocks
    monkeypatch.setattr(setsketch, "MOST_BROADCAST", 0)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in setsketch.near_duplicates(df).collect()} == want


def test_registers_merge_and_estimate():
    pick = np.random.default_rng(5)
    items = np.unique(pick.integers(0, 1 << 63, 3000, dtype=np.uint64))
    a, b = items[:1700], items[300:2000]
    m = 7 * 40
    ra, rb, both = setsketch.registers([a, b, np.union1d(a, b)], m)
    assert (setsketch.merge(ra, rb) == both).all()
    similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    counts = [np.array([x]) for x in ((ra > rb).sum(), (ra < rb).sum(), len(a), len(b))]
    allowed = [j for j in np.arange(0.05, 1.0, 0.01) if setsketch.likely(m, *counts, j)[0]]
    assert abs(max(allowed) - similarity) < 0.1
    assert allowed == sorted(allowed) and len(allowed) == round((max(allowed) - 0.05) / 0.01) + 1


def test_odd_and_empty(odd, none, odd_rows):
    got = setsketch.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for i in (100, 101, 102):
        assert (by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert by_id[103].component_id == 3 and not by_id[103].kept
    assert by_id[106].n_shingles == 1 and by_id[107].n_shingles == 1
    assert sum(r.doc_id == 105 and r.kept for r in got) == 2
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert setsketch.near_duplicates(none).count() == 0


def test_too_low_a_threshold_is_refused():
    with pytest.raises(ValueError, match="bands"):
        setsketch.bands_for(60)
