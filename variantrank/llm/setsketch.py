"""Near-duplicate classes with SetSketch registers.

Each document is the set of its distinct five-word shingles. A SetSketch has many registers; register i is the truncated
maximum of 1 - log_b(h_i(x)) over the set's elements x, with exponentially distributed h_i(x), so it tells the minimum on an
exponentially spaced scale. Sketches of parts merge by the larger register, and equal registers are about as likely as the
sets are similar. Registers are banded; documents that share a band fall into one candidate cluster, within which the
likelihood of (greater, equal, less) registers, given both set sizes, must allow a similarity near the threshold; what
passes is confirmed on the full sets.

No pairs are written out. Equal sets become one node; bands link nodes to their band's smallest node; clusters are the components of that, and the
full sets of a cluster meet in one task, or, if it has more than BLOCK nodes or BLOCK_SHINGLES shingles, in one task for each
two of its blocks. A task keeps a union of confirmed links and returns at most one link per node.

Recall: the number of bands follows from the threshold so that a pair just as similar as it is missed with a probability
of MISS at most, and then only if no chain of links joins it either (40 bands for 85 %, 66 for 80 %).

Defined results: null and empty texts have no shingle and are linked with nothing, like rows with a null id; texts with
fewer words than a shingle are one shingle; repeated rows get the same class; an empty table gives an empty result; other
columns are ignored. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantrank.llm.common import TEXTS_PER_BATCH, components, write_stage

#: Registers per band, and the chance to miss a pair that is as similar as the threshold.
ROWS, MISS = 7, 2e-7
MOST_BANDS = 128
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
#: How far below the threshold a likely similarity may lie and still be confirmed: over four standard errors.
MARGIN = 0.12
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
#: Nodes whose ids are broadcast at most, at 8 bytes each.
MOST_BROADCAST = 1 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = np.random.default_rng(7).integers(0, 1 << 63, ROWS * MOST_BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = np.random.default_rng(8).integers(0, 1 << 63, (ROWS, MOST_BANDS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHUNK = 1 << 15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class _WordHashes(dict):
    """Hashes of words met so far; emptied when it has grown to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: str | None, size: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the shingles; one of the whole sequence if it is shorter; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    out = np.full(n, min(len(words), size), np.uint64)
    for k in range(min(size, len(words))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    return np.unique(_mix(out))


def bands_for(percent: int) -> int:
    """How many bands miss a pair at the threshold with a probability of MISS at most."""
    n = math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))
    if n > MOST_BANDS:
        raise ValueError(f"{percent} % takes {n} bands to find all pairs; there are {MOST_BANDS}")
    return n


def registers(sets: list[np.ndarray], m: int) -> np.ndarray:
    """The m registers of each set (one row each); sets must not be empty."""
    out = np.empty((len(sets), m), np.uint64)
    start = 0
    while start < len(sets):
        end, n = start, 0
        while end < len(sets) and (n == 0 or n + len(sets[end]) <= _CHUNK):
            n, end = n + len(sets[end]), end + 1
        flat = np.concatenate(sets[start:end])
        at = np.cumsum([0, *[len(s) for s in sets[start : end - 1]]])
        for i in range(m):
            out[start:end, i] = np.minimum.reduceat(flat * _ODD[i], at)
        start = end
    least = -np.log1p(-(out.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(least) / math.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def bands(regs: np.ndarray) -> np.ndarray:
    """A key for each band of registers; keys of different bands differ."""
    n = regs.shape[1] // ROWS
    parts = regs.reshape(len(regs), n, ROWS).astype(np.uint64) + np.uint64(1)
    mixed = _mix(parts.transpose(0, 2, 1) * _BAND[:, :n]).sum(axis=1, dtype=np.uint64)
    return _mix(mixed + np.arange(n, dtype=np.uint64)).view(np.int64)


def likely(m: int, greater: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the joint likelihood of the register comparison still rises at this similarity, so that its maximum, the
    estimate, is not below it. The chance of a greater register is p(u - vJ), of a smaller one p(v - uJ), with
    p(x) = -log_b(1 - x (b - 1) / b) and u, v the shares of the two sizes; the likelihood is concave in J."""
    equal = m - greater - less
    u = n_a / (n_a + n_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)  # no similarity exceeds the ratio of the sizes
    j = np.minimum(similarity, most - 1e-9)
    c = (BASE - 1) / BASE
    x, y = u - v * j, v - u * j
    p, q = -np.log1p(-x * c) / math.log(BASE), -np.log1p(-y * c) / math.log(BASE)
    dp, dq = c / ((1 - x * c) * math.log(BASE)), c / ((1 - y * c) * math.log(BASE))
    slope = equal * (v * dp + u * dq) / np.maximum(1 - p - q, 1e-12) - greater * v * dp / np.maximum(p, 1e-12) - less * u * dq / np.maximum(q, 1e-12)
    return (slope >= 0) & (most >= similarity)


def _sets(docs: DataFrame, size: int, m: int, full: bool) -> DataFrame:
    """(id, n, node, keys), or with full (node, items, regs), of every document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                sets = [shingles(text, size, known) for text in batch.column(1).to_pylist()]
                nodes = pa.array([xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets], pa.int64())
                some = [s for s in sets if len(s)]
                regs = registers(some, m) if some else np.empty((0, m), np.uint16)
                if full:
                    held = iter(regs)
                    columns = [nodes, pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([next(held).tobytes() if len(s) else b"" for s in sets], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["node", "items", "regs"])
                else:
                    ends = np.cumsum([0, *[m // ROWS * (len(s) > 0) for s in sets]]).astype(np.int32)
                    keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands(regs).ravel() if some else np.empty(0, np.int64)))
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), nodes, keys], ["id", "n", "node", "keys"])

    kind = docs.schema["id"].dataType.simpleString()
    schema = "node long, items binary, regs binary" if full else f"id {kind}, n long, node long, keys array<long>"
    return docs.select("id", "text").mapInArrow(make, schema)


def _confirm(members: DataFrame, percent: int, m: int) -> DataFrame:
    """Links (a, b) between nodes of the groups (cluster, i, j), one per node at most, confirmed on the full sets."""

    def links(group: pa.Table) -> pa.Table:
        first = np.unique(group.column("node").to_numpy(), return_index=True)[1]
        group = group.take(first)
        node, block = group.column("node").to_numpy(), group.column("block").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("items").to_pylist()]
        regs = np.frombuffer(b"".join(group.column("regs").to_pylist()), np.uint16).reshape(-1, m)
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        n = np.array([len(s) for s in sets], np.float64)
        parent = list(range(len(node)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        near = []
        for a in np.flatnonzero(block == i):
            others = np.flatnonzero((block == j) & (np.arange(len(node)) > a)) if i == j else np.flatnonzero(block == j)
            others = others[np.minimum(n[others], n[a]) * 100 >= percent * np.maximum(n[others], n[a])]
            if len(others):
                greater = (regs[a] > regs[others]).sum(axis=1)
                less = (regs[a] < regs[others]).sum(axis=1)
                good = likely(m, greater, less, np.full(len(others), n[a]), n[others], percent / 100 - MARGIN)
                near += zip((greater + less)[good].tolist(), [int(a)] * int(good.sum()), others[good].tolist(), strict=True)
        for _, a, b in sorted(near):
            x, y = find(a), find(b)
            if x != y:
                common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    parent[max(x, y)] = min(x, y)
        top = np.array([find(x) for x in range(len(node))], np.int64)
        joined = top != np.arange(len(node))
        return pa.table({"a": pa.array(node[joined]), "b": pa.array(node[top[joined]])})

    return members.groupBy("cluster", "i", "j").applyInArrow(links, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 85) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable over links), kept.

    Two documents are linked if 100 * intersection >= percent * union of their shingle sets.
    """
    m = ROWS * bands_for(percent)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = write_stage(_sets(rows, size, m, False), "sketches", TEXTS_PER_BATCH)
    nodes = write_stage(known.where("n > 0 and id is not null").groupBy("node", "n").agg(F.min("id").alias("id")), "nodes")
    single = known.join(nodes.select("node", "id"), ["node", "id"], "left_semi")
    keys = single.select("node", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("other")).where("b != other")
    shared = write_stage(shared.select("key", "b"), "shared-bands")  # so that the join can split a band with many nodes
    edges = keys.join(shared, "key").where("node != b").select(F.col("node").alias("a"), "b")
    clusters = components(edges, "clusters").select(F.col("id").alias("node"), F.col("label").alias("cluster"))

    members = write_stage(clusters.join(nodes, "node"), "members")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("w") / BLOCK_SHINGLES)).cast("int")
    placed = members.join(sizes.select("cluster", blocks.alias("blocks")), "cluster").select(
        "node", "cluster", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), "blocks"
    )
    wanted = members.select("id")
    wanted = F.broadcast(wanted) if members.count() <= MOST_BROADCAST else wanted
    full = _sets(rows.join(wanted, "id", "left_semi"), size, m, True)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    groups = full.join(placed.withColumn("other", other), "node").select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block", "items", "regs"
    )
    labels = components(_confirm(groups, percent, m), "classes").withColumnRenamed("id", "node")
    classes = nodes.join(labels, "node", "left").select("node", "id", F.coalesce("label", "node").alias("label"))
    smallest = classes.groupBy("label").agg(F.min("id").alias("component_id"))
    found = classes.join(smallest, "label").select("node", "component_id")
    return (
        known.select("id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("node")).alias("node"))
        .join(found, "node", "left")
        .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    )
