"""Conversation structure repair: the cheapest edits that make a conversation's roles (s?(ua)+)? by Viterbi search.

A conversation's rows are read in order by an automaton of four states (nothing yet, after a system row, after a user row,
after an assistant row). Every state keeps one survivor, the cheapest way to it. Survivors are leaves of a tree of edits
whose nodes count the survivors and branches that hang on them; a node without any is freed at once, and as soon as all
survivors descend from one edit, all edits up to it are emitted and forgotten. A survivor that no ending can make the best
is freed too. What is kept is thus the part of a conversation that is not settled yet, not the conversation: a few edits
where roles vary, and at most a block where one role goes on and on, so that two ways to alternate stay open.

Of equally cheap ways that with the ASCII-least string of edits wins. Inserted rows stand right before the row that needs
them, so all ways that have read the same rows end in a row's own edit and none is the beginning of another: each
survivor carries its place in the order of the complete unresolved strings, and two ways compare by their survivors'
places, then by the edits they add.

Conversations of up to BLOCK rows are walked whole. Longer ones are cut into blocks, ranges of their order: every block is
walked from each of the four states, which gives the cost and the order of its sixteen ways; these small tables are folded
along the conversation, and then every block is walked once more from the state that the fold found. Identical rows are
counted before they are dealt out. So no task needs a whole long conversation, however many rows it has.

Defined results: a null text or role is one space, thus blank, or a role that cannot stay; null turns come first; rows
of the same turn are ordered by role and text; a null conv_id is a conversation of its own; repeated rows are
duplicates; a conversation whose rows were all dropped has no edits; very long texts are carried through as they are, one
row at a time; an empty table gives an empty result; other columns are ignored. Ids and turns are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantrank.llm.common import write_stage

#: Rows of a conversation that are walked at once, and edits of one piece of the result.
BLOCK, PIECE = 2000, 1000
MOST_BLOCKS = 10_000
DELETE, REROLE, INSERT, CUT_SHORT = 3, 2, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: What is to be inserted at the end of a conversation in each state.
TAILS = ((), (USER, ASSISTANT), (ASSISTANT,), ())
#: The most that ending from state y can cost beyond ending from state x in the same way: LAG[y][x].
LAG = ((0, 0, 2, 0), (4, 0, 2, 4), (5, 2, 0, 2), (3, 0, 2, 0))
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"


def _ways(initial: str, cut_short: int) -> list[tuple[int, int, str, int]]:
    """(from, to, edits, cost) of all ways past a row that may stay."""
    out = [(s, s, "D", DELETE) for s in range(4)]
    if initial == "s":
        out.append((NOTHING, SYSTEM, "K", cut_short))
    for to, before in ((USER, {NOTHING, SYSTEM, ASSISTANT}), (ASSISTANT, {USER})):
        for s in range(4):
            needed = s not in before
            cost = cut_short + INSERT * needed
            out.append((s, to, "I" * needed + "R", cost + REROLE))
            if initial == NAMES[to][0]:
                out.append((s, to, "I" * needed + "K", cost))
    return out


WAYS = {(i, c): _ways(i, c) for i in ("s", "u", "a", "") for c in (0, 1)}


class Node:
    """An edit of one row, with the inserts before it; deleted counts the rows deleted after it on every branch."""

    __slots__ = ("parent", "branches", "edits", "state", "row", "deleted")

    def __init__(self, parent: Node | None, edits: str, state: int, row: tuple[str, str] | None):
        self.parent, self.edits, self.state, self.row = parent, edits, state, row
        self.branches: list[Node] = []  # as many as references are held to the node
        self.deleted = 0


class Walk:
    """The survivors of one walk; edits that are settled are appended to out as (edit, role, text)."""

    def __init__(self, start: int, out: list | None):
        self.root, self.out = Node(None, "", start, None), out
        #: state: (cost, place in the order of the strings of edits, leaf)
        self.alive: dict[int, tuple[int, int, Node]] = {start: (0, 0, self.root)}

    def delete(self, copies: int) -> None:
        """Rows that every way has to delete."""
        for state, (cost, place, leaf) in self.alive.items():
            leaf.deleted += copies
            self.alive[state] = (cost + DELETE * copies, place, leaf)

    def step(self, initial: str, cut_short: int, row: tuple[str, str] | None) -> None:
        best: dict[int, tuple[int, int, str, Node]] = {}
        for s, to, edits, more in WAYS[initial if initial in ("s", "u", "a") else "", cut_short]:
            if s in self.alive:
                cost, place, leaf = self.alive[s]
                found = best.get(to)
                if found is None or (cost + more, place, edits) < found[:3]:
                    best[to] = (cost + more, place, edits, leaf)
        for x in list(best):  # of ways that may tie in the end the one with the least string stays
            if any((best[y][0] + LAG[y][x], best[y][1:3]) < (best[x][0], best[x][1:3]) for y in best if y != x):
                del best[x]
        old = [leaf for _, _, leaf in self.alive.values()]
        self.alive = {}
        order = sorted(best, key=lambda t: (best[t][1], best[t][2]))
        for place, to in enumerate(order):
            cost, _, edits, leaf = best[to]
            node = Node(leaf, edits, to, row)
            leaf.branches.append(node)
            self.alive[to] = (cost, place, node)
        for leaf in old:
            while not leaf.branches and leaf.parent is not None:  # freed with the last reference
                parent = leaf.parent
                parent.branches.remove(leaf)
                leaf = parent
        while len(self.root.branches) == 1:
            self._leave(self.root)
            self.root = self.root.branches[0]
            self.root.parent = None
            self._enter(self.root)

    def _enter(self, node: Node) -> None:
        if self.out is None:
            return
        if node.edits[0] == "I":
            self.out.append(("I", NAMES[USER if node.state == ASSISTANT else ASSISTANT], ""))
        edit = node.edits[-1]
        if edit == "D":
            self.out.append(("D", None, None))
        else:
            self.out.append((edit, node.row[0] if edit == "K" else NAMES[node.state], node.row[1]))

    def _leave(self, node: Node) -> None:
        if self.out is not None:
            self.out.extend([("D", None, None)] * node.deleted)

    def best(self) -> int:
        return min(self.alive, key=lambda s: (self.alive[s][0] + INSERT * len(TAILS[s]), self.alive[s][1]))

    def finish(self, state: int, ends: bool) -> int:
        """Emit the way to state, and what its end needs; its cost."""
        cost, _, leaf = self.alive[state]
        path = [leaf]
        while path[-1] is not self.root:
            path.append(path[-1].parent)
        self._leave(self.root)
        for node in path[-2::-1]:
            self._enter(node)
            self._leave(node)
        if not ends:
            return cost
        if self.out is not None:
            self.out.extend([("I", NAMES[s], "") for s in TAILS[state]])
        return cost + INSERT * len(TAILS[state])


class Counts:
    """What was wrong with a conversation or a block of it."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first = self.last = None

    def add(self, turn: int | None, initial: str, copies: int, blank: bool, duplicate: bool, truncated: bool) -> None:
        self.illegal += copies - 1 + (self.last is not None and self.last + initial not in LEGAL)
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None and turn != self.last_turn:
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn
            self.turns += 1
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - (not duplicate)
            self.truncated += truncated and not duplicate

    def follow(self, other: Counts) -> None:
        """Add the block that follows."""
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.first is not None:
            self.illegal += self.last is not None and self.last + other.first not in LEGAL
            self.first, self.last = other.first if self.first is None else self.first, other.last
        if other.first_turn is not None:
            self.turns -= other.first_turn == self.last_turn
            self.first_turn = other.first_turn if self.first_turn is None else self.first_turn
            self.last_turn = other.last_turn

    def row(self, cost: int) -> dict:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": cost}


COUNTED = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
EDITS = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """(conv_id, block) and its rows, one after the other, of batches sorted by both."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            names = batch.schema.names
            for values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                yield dict(zip(names, values, strict=True))

    source = rows()
    ahead = next(source, None)
    while ahead is not None:
        key = (ahead["conv_id"], ahead["block"])

        def own() -> Iterator[dict]:
            nonlocal ahead
            while ahead is not None and (ahead["conv_id"], ahead["block"]) == key:
                yield ahead
                ahead = next(source, None)

        group = own()
        yield key, group
        for _ in group:
            pass


def _walked(row: dict, walks: list[Walk], counts: Counts, duplicate: bool) -> None:
    """Take one row, with its copies, further on every walk."""
    initial, copies = row["role"][:1], row["copies"]
    counts.add(row["turn"], initial, copies, row["is_blank"], duplicate, row["is_cut"])
    for walk in walks:
        if row["is_blank"] or duplicate:
            walk.delete(copies)
        else:
            walk.step(initial, CUT_SHORT * row["is_cut"], (row["role"], row.get("text")))
            if copies > 1:
                walk.delete(copies - 1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of every group. Where "ends" is null the group is a whole conversation; else the fold has settled it."""
    done, size = [], 0
    for (conv, block), rows in _groups(batches):
        out: list = []
        walk, counts, seen, piece, first = None, Counts(), set(), 0, None
        for row in rows:
            if walk is None:
                first, walk = row, Walk(row["start"] or NOTHING, out)
            if row["dropped"]:
                continue
            duplicate = row["repeated"]
            if duplicate is None and not row["is_blank"]:
                said = (row["role"], hashlib.md5(row["text"].encode()).digest())
                duplicate = said in seen
                seen.add(said)
            _walked(row, [walk], counts, bool(duplicate))
            while len(out) > PIECE:
                done.append({"conv_id": conv, "block": block, "piece": piece, "last": False, "edits": out[:PIECE]})
                del out[:PIECE]
                piece, size = piece + 1, size + PIECE
        whole = first["ends"] is None
        cost = walk.finish(walk.best() if whole else first["end"], whole or first["ends"])
        while len(out) > PIECE:
            done.append({"conv_id": conv, "block": block, "piece": piece, "last": False, "edits": out[:PIECE]})
            del out[:PIECE]
            piece, size = piece + 1, size + PIECE
        found = counts.row(cost) if whole else {c: first[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
        done.append({"conv_id": conv, "block": block, "piece": piece, "last": bool(whole or first["ends"]), "edits": list(out), **found})
        size += len(out) + 1
        if size > 5000:
            yield _batch(done)
            done, size = [], 0
    yield _batch(done)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"conv_id": pa.int64(), "block": pa.int64(), "piece": pa.int64(), "last": pa.bool_(), "edits": EDITS}
    kinds |= dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in kinds.items()], list(kinds))


def damage(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, dropped, copies): five of twenty kinds of rows damaged, by a checksum of conversation and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    fault, text, role = F.crc32(key) % 20, F.coalesce(F.col(text_col), space), F.coalesce(F.col(role_col), space)
    return messages.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fault == 0).alias("dropped"),
        F.when(fault == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _faults(rows: DataFrame) -> DataFrame:
    said = F.rtrim(F.col("text"), F.lit(SPACE))
    return rows.withColumn("is_blank", said == "").withColumn("is_cut", ~F.substring(said, -1, 1).isin(".", "!", "?"))


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.sortWithinPartitions("conv_id", "block", "turn", "role", "text")


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The edits of every conversation of (conv_id, turn, role, text, dropped, copies), in pieces of up to PIECE.

    (conv_id, block, piece, last, edits: array of (edit, role, text), gaps, blank, duplicate, truncated, illegal, cost); the
    counts stand in the piece that is the last of its conversation. In the order of block and piece the edits K, R and I
    are the rows of the repaired conversation.
    """
    long_ones = write_stage(rows.groupBy("conv_id").agg(F.sum("copies").alias("_n")).where(F.col("_n") > block).select(F.col("conv_id").alias("_long")), "long")
    kind = f"conv_id long, block long, piece long, last boolean, edits array<struct<edit string, role string, text string>>, {COUNTED}"
    if long_ones.isEmpty():
        short, rest = rows, None
    else:
        # A long conversation has over `block` rows, so their list is that much shorter than the table.
        match = F.col("conv_id").eqNullSafe(F.col("_long"))
        short, rest = rows.join(long_ones, match, "left_anti"), rows.join(long_ones, match, "left_semi")
    unknown = [F.lit(None).cast(t).alias(c) for c, t in [("repeated", "boolean"), ("start", "int"), ("end", "int"), ("ends", "boolean")]]
    counted = [c.split()[0] for c in COUNTED.split(", ")]
    unknown += [F.lit(None).cast("long").alias(c) for c in counted]
    dealt = _faults(short).withColumn("block", F.lit(0).cast("long")).repartition("conv_id")
    found = _ordered(dealt).select("*", *unknown).mapInArrow(_pieces, kind)
    if rest is None:
        return found
    blocks = _blocks(rest, block)
    flags = _ordered(blocks.repartition("conv_id", "block")).drop("text")
    ways = write_stage(flags.mapInArrow(_transfers, TRANSFERS), "ways")
    settled = write_stage(ways.groupBy("conv_id").applyInArrow(_fold, f"conv_id long, block long, start int, end int, ends boolean, {COUNTED}"), "settled")
    settled = settled.withColumnsRenamed({"conv_id": "_conv", "block": "_block"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    known = blocks.join(settled, same).drop("_conv", "_block")
    return found.union(_ordered(known.repartition("conv_id", "block")).mapInArrow(_pieces, kind))


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Long conversations with identical rows counted, repeated texts marked, and cut into ranges of their order."""
    once = rows.groupBy("conv_id", "turn", "role", "text", "dropped").agg(F.sum("copies").alias("copies"))
    once = write_stage(once.withColumn("said", F.md5("text")), "long-rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    again = once.where("not dropped").groupBy("conv_id", "role", "said").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    again = write_stage(again.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("said").alias("_said"), "_first"), "said-again")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("said") == F.col("_said"))
    marked = once.join(again, same, "left").withColumn("repeated", F.coalesce(place > F.col("_first"), F.lit(False)))
    marked = _faults(marked.drop("_conv", "_role", "_said", "_first", "said"))
    parts = max(1, min(MOST_BLOCKS, -(-once.count() // block)))
    cut = marked.repartitionByRange(parts, "conv_id", "turn", "role", "text")
    return write_stage(cut.withColumn("block", F.spark_partition_id().cast("long")), "blocks")


TRANSFERS = (
    "conv_id long, block long, costs array<long>, places array<int>, blank long, duplicate long, truncated long, illegal long, "
    "turns long, first_turn long, last_turn long, first string, last string, live long"
)


def _transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every block the cost and the place of the ways from each state (rows) to each state (columns)."""
    done = []
    for (conv, block), rows in _groups(batches):
        walks, counts, live = [Walk(s, None) for s in range(4)], Counts(), 0
        for row in rows:
            if not row["dropped"]:
                live += 1
                _walked(row, walks, counts, row["repeated"])
        costs = [w.alive[s][0] if s in w.alive else NEVER for w in walks for s in range(4)]
        places = [w.alive[s][1] if s in w.alive else 0 for w in walks for s in range(4)]
        done.append((conv, block, costs, places, counts.blank, counts.duplicate, counts.truncated, counts.illegal, counts.turns, counts.first_turn, counts.last_turn, counts.first, counts.last, live))
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.int64()] * 7, pa.string(), pa.string(), pa.int64()]
    columns = list(zip(*done, strict=True)) or [[]] * len(kinds)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in TRANSFERS.split(", ")])


def _fold(table: pa.Table) -> pa.Table:
    """The states between a conversation's blocks on the best way, and the counts of the conversation."""
    blocks = sorted(table.to_pylist(), key=lambda b: b["block"])
    counts, alive, came = Counts(), {NOTHING: (0, 0)}, []
    for b in blocks:
        own = Counts()
        for name in ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "first", "last"):
            setattr(own, name, b[name])
        counts.follow(own)
        best: dict[int, tuple] = {}
        for s, (cost, place) in alive.items():
            for to in range(4):
                more = b["costs"][4 * s + to]
                way = (cost + more, place, b["places"][4 * s + to], s)
                if more < NEVER and (to not in best or way < best[to]):
                    best[to] = way
        order = sorted(best, key=lambda t: best[t][1:3])
        alive = {t: (best[t][0], i) for i, t in enumerate(order)}
        came.append({t: best[t][3] for t in best})
    state = min(alive, key=lambda s: (alive[s][0] + INSERT * len(TAILS[s]), alive[s][1]))
    found = counts.row(alive[state][0] + INSERT * len(TAILS[state]))
    out = []
    for b, back in zip(reversed(blocks), reversed(came), strict=True):
        out.append({"conv_id": b["conv_id"], "block": b["block"], "start": back[state], "end": state, "ends": not out, **(found if not out else {})})
        state = back[state]
    kinds = [("conv_id", pa.int64()), ("block", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("ends", pa.bool_())]
    kinds += [(c.split()[0], pa.int64()) for c in COUNTED.split(", ")]
    return pa.Table.from_arrays([pa.array([r.get(c) for r in out], t) for c, t in kinds], [c for c, _ in kinds])


def lines_of(edits: str) -> Column:
    """The repaired rows of a piece as role:text lines; null if it has none."""
    kept = F.filter(edits, lambda e: e["edit"] != "D")
    return F.when(F.size(kept) > 0, F.array_join(F.transform(kept, lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "\n"))


def digest(pieces: DataFrame) -> DataFrame:
    """One row per conversation: the counts, audit (its edits) and repaired_sha256 (of its repaired rows as lines).

    Conversations of one piece are digested where they are; the pieces of longer ones are read in order by one task, a
    batch at a time, as the digest of a text has to be.
    """
    counted = [c.split()[0] for c in COUNTED.split(", ")]
    said = pieces.select(
        "conv_id", "block", "piece", "last", *counted, F.array_join(F.transform("edits", lambda e: e["edit"]), "").alias("audit"), lines_of("edits").alias("lines")
    )
    said = write_stage(said, "repaired")
    whole = said.where("last and block = 0 and piece = 0")
    short = whole.select("conv_id", *counted, "audit", F.sha2(F.coalesce("lines", F.lit("")), 256).alias("repaired_sha256"))
    # A long conversation whose first block holds all of it has one piece only if it has few edits; both ways agree on it.
    more = said.where("not (last and block = 0 and piece = 0)").select("conv_id", "last", "block", "piece", *counted, "audit", "lines")
    more = more.repartition("conv_id").sortWithinPartitions("conv_id", "block", "piece")
    kind = f"conv_id long, {COUNTED}, audit string, repaired_sha256 string"
    return short.union(more.mapInArrow(_digests, kind))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *[c.split()[0] for c in COUNTED.split(", ")]]
    audit, sha, begun = [], hashlib.sha256(), False
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            audit.append(row["audit"])
            if row["lines"] is not None:
                sha.update(b"\n" * begun + row["lines"].encode())
                begun = True
            if row["last"]:
                out.append([*(row[c] for c in names), "".join(audit), sha.hexdigest()])
                audit, sha, begun = [], hashlib.sha256(), False
        kinds = [pa.int64()] * len(names) + [pa.string()] * 2
        columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [*names, "audit", "repaired_sha256"])
