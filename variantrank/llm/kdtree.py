"""Sharding by a k-d tree over document metadata.

The corpus is split into leaves by repeatedly cutting every node along its widest metadata dimension, at the weighted
median of bytes. Medians are exact and distributed: one aggregation per round narrows the range of an order-preserving
64-bit key by a factor of STEPS, for all nodes of a level at once; only nodes x STEPS sums come to the driver.

Documents with equal texts are one point of the tree (with the metadata of their smallest id), so they stay together,
unless a cut falls into a group that holds more than a shard's small share of bytes: such a group is cut by id.

Defined results: a null text has 1 byte (its separator) and the checksum of the empty text; null metadata sorts first;
rows with the same id and text may share every coordinate, they are then told apart by nothing and stay on one side of a
cut; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantrank.llm.common import number_rows, write_stage

#: Sums per node and round that come to the driver; bits of the tie among rows with one key; the key of null.
STEPS, TIE_BITS, LOWEST = 4096, 48, -(1 << 40)
#: A group of equal texts with more than this share of a leaf's bytes is cut between ids.
SPLIT_FROM = 0.02


def points(docs: DataFrame, id_col: str, text_col: str, dimensions: dict[str, Column]) -> DataFrame:
    """One narrow row per document: id, size, text_crc32, its group's hash and bytes, and one rank column per dimension."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = write_stage(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("same"),
            *[c.cast("double").alias(f"d_{name}") for name, c in dimensions.items()],
        ),
        "points",
    )
    names = [f"d_{name}" for name in dimensions]
    groups = narrow.groupBy("same", "text_crc32", "size").agg(
        F.sum("size").alias("group_bytes"), *[F.min_by(n, "id").alias(n) for n in names]
    )
    # One text may have a third of all rows. As the groups are written, both sides of the join have a shuffle of their own,
    # and adaptive execution can split the large side of a task.
    return narrow.drop(*names).join(write_stage(groups, "text-groups"), ["same", "text_crc32", "size"])


def _key(value: Column) -> Column:
    """A long in the order of a double, in sixteenths; null first."""
    return F.coalesce(F.round(value * 16).cast("long"), F.lit(LOWEST))


def _of(values: dict[int, int]) -> Column:
    """The value of a row's node."""
    return F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in values.items() for x in pair]), F.col("node").cast("long"))


def _reach(rows: DataFrame, column: str, ends: dict[int, tuple[int, int]], wanted: dict[int, float], totals: dict[int, float]):
    """For each node the least value of column with which at least the wanted weight is reached, the weight below it and
    the weight at it. ends: bounds of column; totals: the weight of the node's rows."""
    low, high = {n: a for n, (a, _) in ends.items()}, {n: b for n, (_, b) in ends.items()}
    below, there = dict.fromkeys(low, 0.0), dict(totals)
    while any(low[n] < high[n] for n in low):
        width = {n: max(1, -(-(high[n] - low[n] + 1) // STEPS)) for n in low}
        inside = rows.where(F.col(column).between(_of(low), _of(high)))
        inside = inside.select("node", "weight", (F.col(column) - _of(low)).alias("above"), _of(width).alias("width"))
        sums: dict[int, list[tuple[int, float]]] = {}
        for r in inside.groupBy("node", F.expr("above div width").alias("step")).agg(F.sum("weight").alias("w")).collect():
            sums.setdefault(r["node"], []).append((r["step"], float(r["w"])))
        for n, steps in sums.items():
            steps.sort()
            for step, weight in steps:
                if step == steps[-1][0] or below[n] + weight >= wanted[n]:
                    low[n], high[n] = low[n] + step * width[n], min(high[n], low[n] + (step + 1) * width[n] - 1)
                    there[n] = weight
                    break
                below[n] += weight
    return low, below, there


def shard(docs: DataFrame, shards: int, dimensions: dict[str, Column], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, shard, slot. Shards hold nearly equal bytes; slots are gapless.

    A node of several shards is cut into its lower and its upper half of them, so any number of shards works. Its widest
    dimension is the one with the largest spread relative to the corpus. A point that the cut falls on goes to the side
    that it leaves closer to its share.
    """
    rows = write_stage(points(docs, id_col, text_col, dimensions), "grouped-points")
    names = [f"d_{name}" for name in dimensions]
    whole = rows.agg(F.sum("size").alias("bytes"), *[F.stddev_pop(n).alias(n) for n in names]).first()
    spread = {n: whole[n] or 1.0 for n in names}
    large = F.col("group_bytes") > SPLIT_FROM * (whole["bytes"] or 0) / shards
    # Members of a small group share one tie and so one side; those of a large one are told apart by id.
    tie = F.shiftrightunsigned(F.xxhash64("same", "text_crc32", "size", F.when(large, F.col("id"))), 64 - TIE_BITS)
    rows = rows.withColumn("tie", tie).withColumn("weight", F.col("size")).withColumn("node", F.lit(0))
    spans = {0: (0, shards)}
    while any(b - a > 1 for a, b in spans.values()):
        middle = {n: (a + b) // 2 for n, (a, b) in spans.items() if b - a > 1}
        open_rows = rows.where(F.col("node").isin(list(middle)))
        seen = [x for n in names for x in (F.stddev_pop(n).alias(n), F.min(_key(F.col(n))).alias(f"low_{n}"), F.max(_key(F.col(n))).alias(f"high_{n}"))]
        nodes = {r["node"]: r for r in open_rows.groupBy("node").agg(F.sum("weight").alias("w"), *seen).collect()}
        key = F.lit(None).cast("long")
        totals, wanted, ends = {}, {}, {}
        for n, r in nodes.items():
            name = max(names, key=lambda x, r=r: ((r[x] or 0.0) / spread[x], x))
            key = F.when(F.col("node") == n, _key(F.col(name))).otherwise(key)
            ends[n], totals[n] = (r[f"low_{name}"], r[f"high_{name}"]), float(r["w"])
            wanted[n] = totals[n] * (middle[n] - spans[n][0]) / (spans[n][1] - spans[n][0])
        side = F.col("node")
        if nodes:
            keyed = open_rows.select("node", key.alias("key"), "tie", "weight")
            keys, below, there = _reach(keyed, "key", ends, wanted, totals)
            here = keyed.where(F.col("key") == _of(keys))
            rest = {n: wanted[n] - below[n] for n in keys}
            ties, under, last = _reach(here, "tie", dict.fromkeys(keys, (0, (1 << TIE_BITS) - 1)), rest, there)
            for n, at in keys.items():
                cut = ties[n] if rest[n] - under[n] >= last[n] / 2 else ties[n] - 1
                upper = (key > at) | ((key == at) & (F.col("tie") > cut))
                side = F.when(F.col("node") == n, F.when(upper, middle[n]).otherwise(spans[n][0])).otherwise(side)
        rows = write_stage(rows.withColumn("node", side.cast("int")), "nodes")
        halves = {n: ((a, middle[n]), (middle[n], b)) if n in middle else ((a, b),) for n, (a, b) in spans.items()}
        spans = {span[0]: span for parts in halves.values() for span in parts}
    placed = rows.select("id", "size", "text_crc32", F.col("node").alias("shard"))
    return number_rows(placed, ["shard"], ["id", "text_crc32"], "slot").withColumnRenamed("id", id_col)
