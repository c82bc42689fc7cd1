import hashlib
import itertools
import random
import re
import zlib

import pytest

from variantrank.llm import structure_repair as sr

SCHEMA = "conv_id long, turn long, role string, text string, block string, copies string, edits string, start string, last string"


def table(spark, rows):
    """With columns of the names that the operator uses inside."""
    return spark.createDataFrame([(*r, *"xxxxx") for r in rows], SCHEMA)


def damaged(rows):
    """Rows after damage by conversation, straight from the definition."""
    out = {}
    for conv, turn, role, text in rows:
        shown = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1))
    for held in out.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def expected(rows):
    out = {}
    for conv, held in damaged(rows).items():
        faults, seen = [], set()
        for _, role, text in held:
            bare = text.strip(sr.SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        # All strings of edits with up to two inserts before each row and at the end, cheapest and then ASCII-least.
        best = None
        for choice in itertools.product(*[("D",) if f in ("blank", "duplicate") else ("D", "K", "R", "IK", "IR") for f in faults], ("", "I", "II")):
            edits, initials, lines, cost = "".join(choice), [], [], 0
            kept = len(edits) - edits.count("D")
            want = "s" * (kept % 2) + "ua" * (kept // 2)
            if kept == 1:
                continue
            for step, row, fault in zip(choice, [*held, None], [*faults, ""], strict=True):
                for edit in step:
                    place = len(initials)
                    if edit == "D":
                        cost += 3
                        continue
                    role = {"u": "user", "a": "assistant"}.get(want[place], "no")
                    cost += {"K": 0, "R": 2, "I": 2}[edit] + (fault == "truncated" and edit != "I")
                    if edit == "K":
                        role = row[1]
                    initials.append(role[:1])
                    lines.append(f"{role}:{'' if edit == 'I' else row[2]}")
            if "".join(initials) == want and (best is None or (cost, edits) < best[:2]):
                best = (cost, edits, "\n".join(lines))
        turns = [t for t, _, _ in held if t is not None]
        pairs = ["".join(p) for p in itertools.pairwise([r[1][:1] for r in held])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest(),
        )
    return out


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(df):
    rows = df.select("conv_id", *NAMES).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(5)
    out = []
    for conv in range(150):
        for _ in range(pick.randint(1, 6)):
            turn = pick.choice([None, 0, 1, 2, 3, 4, 7])
            role = pick.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "u"])
            out.append((conv, turn, role, pick.choice(["Yes.", "no", "a\n b!", "", " \t\n", None, "é?", "x" * 3000 + "."])))
    return out + [(None, None, None, None), (None, 2, "user", "Hi."), (None, 2, "user", "Hi."), (900, None, "user", "a.")]


def test_equals_brute_force(spark, rows):
    want = expected(rows)
    assert {c for c, _, _, _ in rows} == set(want)
    messages = table(spark, rows)
    assert found(sr.digest(sr.repair(sr.damage(messages)))) == want


@pytest.mark.parametrize(("block", "piece"), [(1, 1000), (3, 2)])
def test_blocks_and_pieces_change_nothing(spark, rows, monkeypatch, block, piece):
    monkeypatch.setattr(sr, "PIECE", piece)
    messages = table(spark, rows)
    assert found(sr.digest(sr.repair(sr.damage(messages), block))) == expected(rows)


def test_one_long_conversation(spark):
    """Over many blocks, with thousands of identical rows, as one walk over all of it."""
    pick = random.Random(2)
    rows = [(7, i, pick.choice(["user", "assistant", "system"]), pick.choice([f"word {i}.", f"word {i}", "again.", ""])) for i in range(3000)]
    rows += [(7, 50, "user", "copy.")] * 2000 + [(8, 1, "user", "One.")]
    messages = sr.damage(table(spark, rows))
    cut, whole = found(sr.digest(sr.repair(messages, 400))), found(sr.digest(sr.repair(messages, 1 << 30)))
    assert cut == whole and len(cut[7][6]) >= 4000


def test_memory_stays_bounded():
    """Survivors share an ancestor soon where roles vary; where one role goes on and on, both ways to alternate stay open,
    within a block. Rows that every way deletes add nothing to the tree."""
    pick = random.Random(3)

    def nodes(root):
        n, todo = 0, [root]
        while todo:
            todo += todo.pop().branches
            n += 1
        return n

    for roles, least in (("ua", 30), ("suax", 40), ("usu", 60), ("uuuuuua", 90), ("u", 2 * 1714 + 10)):
        walk, most = sr.Walk(sr.NOTHING, None), 0
        for i in range(2000):
            if i % 7 == 3:
                walk.delete(5)
            else:
                walk.step(pick.choice(roles), pick.randint(0, 1), ("user", "text"))
            most = max(most, nodes(walk.root)) if i % 20 == 0 else most
        assert most < least, (roles, most)


def test_empty(spark):
    empty = sr.digest(sr.repair(sr.damage(table(spark, []))))
    assert empty.collect() == []
    assert set(NAMES) < set(empty.columns)


def test_repaired_rows(spark):
    """The operator itself returns the repaired rows."""
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "What now?"), (1, 2, "assistant", "This.")]
    plain = table(spark, rows).select("conv_id", "turn", "role", "text").selectExpr("*", "false AS dropped", "1L AS copies")
    (row,) = sr.repair(plain).collect()
    assert [tuple(e) for e in row["edits"]] == [
        ("K", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "What now?"), ("K", "assistant", "This."),
    ]
