import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
from conftest import *  # noqa: F403

from variantrank.llm import templates
from variantrank.llm.oracle import leaks_sql

ITEM = "A train leaves the station with Alice at 40 km per hour and meets Bob after 3 hours, how far is 40 km then"
CHANGED = "A train leaves the station with Maria at 55 km per hour and meets Peter after 7 hours, how far is 55 km then"
INCONSISTENT = "A train leaves the station with Maria at 55 km per hour and meets Peter after 7 hours, how far is 66 km then"


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, n string, hash string, item string, at string")


def found(docs, items):
    return {(r.doc_id, r.item_id): r for r in templates.leaks(docs, items).collect()}


def test_reparameterised_questions(spark, monkeypatch):
    filler = prose(1, 60)  # noqa: F405
    rows = [(1, f"{filler}\n{ITEM}\n{filler}"), (2, f"{filler}\n{CHANGED}"), (3, f"{filler}\n{INCONSISTENT}"), (4, filler), (5, ITEM[:50])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = benchmark(spark, [(7, ITEM, *"xxxx"), (8, ITEM, *"xxxx"), (9, "too short", *"xxxx"), (10, None, *"xxxx"), (None, prose(99, 40), *"xxxx")])  # noqa: F405
    got = found(docs, items)
    assert set(got) == {(1, 7), (2, 7)}
    assert got[1, 7].changed_slots == 0 and got[2, 7].changed_slots == 4
    monkeypatch.setattr(templates, "MOST_BROADCAST", -1)
    assert {k: r.asDict() for k, r in found(docs, items).items()} == {k: r.asDict() for k, r in got.items()}


def test_short_items_and_other_spelling(spark):
    short = "Which river flows past seven hills"
    docs = spark.createDataFrame([(1, "so which river, flows past - seven hills?"), (2, "WHICH RIVER FLOWS PAST SEVEN HILLS"), (3, "which river flows past")], "doc_id long, text string")
    got = found(docs, benchmark(spark, [(1, short, *"xxxx"), (2, prose(5, 30), *"xxxx")]))  # noqa: F405
    assert set(got) == {(1, 1), (2, 1)}


def test_all_whole_items_are_found_and_nothing_else(spark):
    items = [(i, prose(500 + i, 20 + i), *"xxxx") for i in range(12)]  # noqa: F405
    rows = [(i, prose(i, 100) + "\n" + items[i % 12][1] + "\n" + prose(i + 50, 30)) for i in range(24)]  # noqa: F405
    rows += [(100 + i, prose(200 + i, 200)) for i in range(24)]  # noqa: F405
    got = found(spark.createDataFrame(rows, "doc_id long, text string"), benchmark(spark, items))
    assert set(got) == {(i, i % 12) for i in range(24)}
    assert all(r.n_windows >= r.item_windows - 8 for r in got.values())


def test_odd_and_empty(spark, odd, none, odd_rows):
    items = benchmark(spark, [(1, odd_rows[5][1], *"xxxx")])
    got = found(odd, items)
    assert set(got) == {(5, 1)}
    assert not found(none, items) and not found(odd, benchmark(spark, []))


def test_names_at_the_beginning_of_sentences(spark):
    """Names that begin a text or sentence, or follow a figure, colon, quotation mark or bracket, may differ too."""
    item = "{0} carries seven red apples towards the market. {1} takes three of these apples away again. {0} wants to know how many remain."
    marked = "The list says: {0} buys bread on day 3 {1} pays (\"{0} owes nothing\") and later [{1} forgets the whole bill]"
    rows = [(1, item.format("Maria", "Peter")), (2, item.format("Alice", "Bob")), (3, marked.format("Maria", "Peter"))]
    rows += [(4, prose(1, 60))]  # noqa: F405
    items = benchmark(spark, [(7, item.format("Alice", "Bob"), *"xxxx"), (8, marked.format("Alice", "Bob"), *"xxxx")])
    got = found(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert set(got) == {(1, 7), (2, 7), (3, 8)}
    assert got[2, 7].changed_slots == 0 and got[1, 7].changed_slots == 2 and got[3, 8].changed_slots == 2


def test_runs_of_the_same_words(spark, monkeypatch):
    """13 words of an item as they stand, or a whole shorter one, at any place and with any literals."""
    item, long = prose(1, 39).split(), prose(2, 100).split()  # noqa: F405
    figures = "12 km 14 kg 15 m 17 s 19 h 21 mg 23 g 25 ml"
    filler = [prose(10 + i, 20 + i) for i in range(14)]  # noqa: F405
    rows = [(i, filler[i] + " " + " ".join(item[5 : 5 + n]) + " " + filler[13 - i]) for i, n in enumerate((12, 13, 13, 13, 14, 15, 16, 20))]
    rows += [(10, filler[0] + "\n" + " ".join(long[20:73])), (11, filler[1] + " " + figures), (12, filler[2] + " WHAT IS 12 + 45?"), (13, filler[3] + " What is 12 + 46?")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = benchmark(spark, [(1, " ".join(item), *"xxxx"), (2, " ".join(long), *"xxxx"), (3, figures, *"xxxx"), (4, "What is 12 + 45?", *"xxxx")])
    want = {(i, 1) for i in range(1, 8)} | {(10, 2), (11, 3), (12, 4)}
    got = found(docs, items)
    assert set(got) == want
    assert all(got[i, 1].first_word <= 20 + i < got[i, 1].first_word + 7 for i in range(1, 8))
    monkeypatch.setattr(templates, "MOST_BROADCAST", -1)
    assert found(docs, items) == got


def mixed(seed, n):
    """Words, names, figures with units and marks, dense with what becomes a placeholder."""
    pick = random.Random(seed)
    kinds = [
        lambda: pick.choice("red apples market toward seven remain the of bill whole train far ς Σ+Α don't".split()), lambda: pick.choice(["Alice", "Bob", "Maria", "McDonald", "UK", "Bob's"]),
        lambda: f"{pick.randint(1, 30)} {pick.choice(['km', 'kg', 'ml'])}", lambda: f"{pick.randint(1, 99)}km", lambda: pick.choice(["3.5", "1/2", "12:30", "-", "(", "—"]),
    ]
    return " ".join(pick.choice(kinds)() + pick.choice(["", "", "", ".", ",", "?"]) for _ in range(n))


def other_slots(seed, text):
    pick = random.Random(seed)
    names = dict(zip(["Alice", "Bob", "Maria"], pick.sample(["Peter", "Quinn", "Rosa"], 3), strict=True))
    for old, new in names.items():
        text = text.replace(old, new)
    return re.sub(r"\b\d+\b", lambda m: str(int(m[0]) + 100), text) if pick.random() < 0.5 else text


def test_equals_sql(spark, monkeypatch):
    """The three searches against the twin query, on texts full of placeholders: whole and partial copies, other slots, repeated
    and null ids, items with the same id or the same words."""
    pick = random.Random(9)
    items = [(i, mixed(i, pick.randint(2, 30))) for i in range(40)]
    items += [(7, mixed(300, 20)), (100, items[3][1]), (101, items[4][1].upper()), (None, mixed(301, 15)), (102, None), (103, "")]
    rows = []
    for i in range(120):
        words = items[pick.randrange(41)][1].split()
        lo = pick.choice([0, 0, pick.randrange(len(words))])
        part = " ".join(words[lo : lo + pick.choice([13, 40, len(words)])])
        part = other_slots(i, part) if i % 3 == 0 else part
        rows.append((pick.choice([i, i, i, 5, None]), f"{mixed(1000 + i, 12)} {part}\n{mixed(2000 + i, 9)}"))
    rows += [(500, None), (501, ""), (502, " ".join(items[0][1].split()[::-1]))]
    docs = spark.createDataFrame([(*r, "x", "x") for r in rows], "doc_id long, text string, item string, shift string")
    marks = spark.createDataFrame([(*r, *"xxxx") for r in items], "item_id long, text string, n string, hash string, item string, at string")
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
    con.register("benchmark", pa.table({"item_id": pa.array([r[0] for r in items], pa.int64()), "text": pa.array([r[1] for r in items], pa.string())}))
    result = con.execute(leaks_sql())
    names = [d[0] for d in result.description]
    want = Counter(map(str, result.fetchall()))
    assert len(want) > 40
    for most in (1_000_000, -1):
        monkeypatch.setattr(templates, "MOST_BROADCAST", most)
        assert Counter(str(tuple(r)) for r in templates.leaks(docs, marks).select(names).collect()) == want
    # Without any anchor all windows are looked up as a whole.
    monkeypatch.setattr(templates, "SHAPES", ((0, 5, 7),))
    kinds = [n for n in names if n != "first_word"]
    got = {tuple(r) for r in templates.leaks(docs, marks).select(kinds).collect() if r["n_windows"]}
    assert got == {tuple(r[names.index(k)] for k in kinds) for r in con.execute(leaks_sql()).fetchall() if r[names.index("n_windows")]}
