import random
import re
from itertools import groupby

import duckdb
from conftest import *  # noqa: F403

from variantrank.llm import quotes
from variantrank.llm.oracle import links_sql

SCHEMA = "conv_id long, turn long, role string, text string, level string, position string, thread string, root string, passage string"


def talk(spark, rows):
    return spark.createDataFrame([(*r, *"xxxxx") for r in rows], SCHEMA)


def test_threads(spark):
    rows = [
        (1, 0, "a", "Hello there, how do I sort a list?\nThanks a lot for helping"),
        (1, 1, "b", "> Hello there, how do I sort a list?\nUse sorted on your list please"),
        (1, 2, "a", "something entirely else here, new topic"),
        (1, 3, "a", "On Monday b wrote:\n> > Hello there, how do I sort a list?\n> Use sorted on\n> your list please\nWorks, thank you"),
        (1, 4, "b", "> something entirely else here,\n> new topic\nok then"),
        (1, 5, "b", "> never said by anyone at all\n> short\nhm"),
        (2, 0, "a", "> Hello there, how do I sort a list?\nother conversation"),
        (2, 1, None, None), (2, 2, "a", ""), (None, 0, "a", "a message of no conversation"), (1, None, "a", "no turn, no place at all"),
        (1, 5, "b", "> never said by anyone at all\n> short\nhm"),
    ]
    got = quotes.link(talk(spark, rows)).collect()
    assert len(got) == len(rows)
    one = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)
    assert [r.turn for r in one if r.turn is not None] == [0, 1, 3, 2, 4, 5, 5]
    assert sorted(r.position for r in one) == list(range(8))
    at = {r.turn: r for r in one}
    assert [at[t].parent for t in range(6)] == [None, 0, None, 1, 2, None]
    assert [at[t].thread for t in range(6)] == [0, 0, 2, 0, 2, 5]
    assert [at[t].quote_depth for t in range(6)] == [0, 1, 0, 2, 1, 1]
    assert at[3].text == "Works, thank you" and at[1].text == "Use sorted on your list please"
    assert next(r for r in got if r.conv_id == 2 and r.turn == 1).text is None
    assert next(r for r in got if r.conv_id == 2 and r.turn == 0).parent is None


def test_long_chain(spark):
    said = [f"statement number {i} of a long chain" for i in range(40)]
    rows = [(9, i, "a", (f"> {said[i - 1]}\n" if i else "") + said[i]) for i in range(40)]
    got = quotes.link(talk(spark, rows)).collect()
    assert {(r.parent, r.thread) for r in got} == {(i - 1 if i else None, 0) for i in range(40)}


def test_empty(spark):
    assert quotes.link(talk(spark, [])).count() == 0


def test_parts_of_a_text_are_linked(spark):
    """A sentence out of a longer line, some of several paragraphs in lines broken elsewhere, and very short quotes."""
    rows = [
        (1, 0, "a", "The train was late again today. We waited for an hour on the platform. Nobody told us why it stood still."),
        (1, 1, "b", "First part of what I want to say about it.\n\nSecond part with other words in it entirely.\n\nThird part, closing the letter now."),
        (1, 2, "a", "I see. Ok then! Bye"),
        (1, 3, "b", "> We waited for an hour on the platform.\nthat is long"),
        (1, 4, "a", "> First part of what\n> I want to say about it.\n>\n> Third part, closing\n> the letter now.\nthanks for both"),
        (1, 5, "b", "> ok then\nsee you"),
        (1, 6, "a", "> [...] part with other words in it [...]\nwhich ones?"),
        (1, 7, "b", "> waited for an hour, which nobody ever said in these words at all, or so it seems to me now\nno"),
    ]
    at = {r.turn: r for r in quotes.link(talk(spark, rows)).collect()}
    assert [at[t].parent for t in range(8)] == [None, None, None, 0, 1, 2, 1, None]
    assert at[4].text == "thanks for both"


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


def brute(rows):
    """(conv_id, turn) to the parent, by comparing every quoted block with every message."""
    parsed = {}
    for conv, turn, _, text in rows:
        lines = []
        for line in (text or "").split("\n"):
            marks = re.match(r"(?:[ \t]*>)+", line)
            lines.append((marks.group().count(">") if marks else 0, re.sub(r"^(?:[ \t]*>)+[ \t]?", "", line)))
        parsed[conv, turn] = [(level, [said for _, said in run]) for level, run in groupby(lines, key=lambda x: x[0])]
    five = lambda w: {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}
    first = {}
    for (conv, turn), blocks in sorted(parsed.items()):
        own = [b for level, b in blocks if level == 0]
        units = {" ".join(words(x)) for b in own for line in b for x in [line, *re.split(r"[.!?]+", line)]}
        units |= {" ".join(words(" ".join(b))) for b in own} | {" ".join(words(" ".join(x for b in own for x in b)))}
        for unit in units.union(*(five(words(" ".join(b))) for b in own)):
            first.setdefault((conv, unit), turn)
    out = {}
    for (conv, turn), blocks in parsed.items():
        found = {}
        for level, said in blocks:
            w = words(" ".join(said))
            if level and w:
                pieces = five(w) | {" ".join(words(x)) for x in said if 1 <= len(words(x)) <= 4} | ({" ".join(w)} if len(w) < 5 else set())
                for origin in {first[conv, p] for p in {*pieces, " ".join(w)} if first.get((conv, p), turn) < turn}:
                    n, whole = sum(first.get((conv, p)) == origin for p in pieces), first.get((conv, " ".join(w))) == origin
                    if whole or 2 * n >= len(pieces) or n >= 3:
                        old = found.get(origin, (-99, False, 0))
                        found[origin] = (max(old[0], -level), old[1] or whole, old[2] + n)
        out[conv, turn] = max(((*v, origin) for origin, v in found.items()), default=(None,))[-1]
    return out


def threads(seed, conversations=40, turns=14):
    """Conversations whose messages quote earlier ones: whole, by sentences, by some words, re-wrapped, nested or not at all."""
    pick = random.Random(seed)
    rows = []
    for conv in range(conversations):
        said = []
        for turn in range(turns):
            parts = []
            for _ in range(pick.choice((0, 1, 1, 2)) if said else 0):
                w = pick.choice(said).split()
                a = pick.randrange(len(w))
                w = pick.choice((w, w[a:], w[a : a + pick.randrange(1, 12)], [*w[:4], "[...]", *w[a:]]))
                width, mark = pick.choice((3, 8, 100)), pick.choice(("> ", "> ", "> > ", ">"))
                parts += [mark + " ".join(w[i : i + width]) for i in range(0, len(w), width)]
            own = prose(1000 * conv + turn, pick.choice((2, 4, 9, 30)))  # noqa: F405
            own = own if pick.random() < 0.8 or not said else pick.choice(said)
            said.append(own)
            rows.append((conv, turn, "a", "\n".join(pick.choice(([*parts, own], [own, *parts])))))
    return rows


def test_links_equal_brute_force_and_sql(spark):
    rows = threads(5)
    got = quotes.link(talk(spark, rows)).collect()
    want = brute(rows)
    assert {(r.conv_id, r.turn): r.parent for r in got} == want
    assert 150 < sum(p is not None for p in want.values()) < len(want)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    columns = "conv_id, turn, role, text, quote_depth, parent, thread, position"
    sql = con.execute(f"SELECT {columns} FROM ({links_sql()})").fetchall()
    assert sorted(sql) == sorted(tuple(r[c] for c in columns.split(", ")) for r in got)


def test_odd_texts_end_nothing(spark):
    """A very long message, a conversation with many equal quotes, quotes without words, and repeated rows."""
    long = prose(3, 20_000)  # noqa: F405
    rows = [(1, 0, "a", long), (1, 1, "b", "> " + long[5_000:9_000]), (1, 2, "a", "> ...\n>\n> ?!\nwhat"), (1, 3, None, None)]
    rows += [(2, 0, "a", "the one line that all quote in here"), *((2, i, "b", "> the one line that all quote in here\nyes") for i in range(1, 300))]
    rows += [(3, 0, "a", "twice the same in here"), (3, 0, "a", "twice the same in here"), (3, 1, "b", "> twice the same in here")] * 2
    got = quotes.link(talk(spark, rows)).collect()
    assert len(got) == len(rows)
    parents = {(r.conv_id, r.turn): r.parent for r in got}
    assert [parents[1, t] for t in range(4)] == [None, 0, None, None]
    assert all(parents[2, t] == 0 for t in range(1, 300)) and parents[3, 1] == 0
