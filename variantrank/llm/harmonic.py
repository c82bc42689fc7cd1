"""Harmonic packing of token sequences.

Lengths fall into reciprocal-capacity classes: class k holds pieces of at most capacity / k tokens, and a bin of class k
always takes exactly k of them. Workers therefore fill bins of each class by themselves, without seeing other pieces and
without a shuffle. A document is cut so that its pieces nearly exhaust their class: whole bins first, then the largest
reciprocal below the rest, and so on; two or three cuts leave less than SLACK tokens of padding per bin.

Unfinished bins are the only thing left to gather: at most k - 1 pieces per class and worker. FAN_IN workers' rests go to
one task of the next level, which fills again, until one task holds the last, bounded rest and packs it by best fit.

Defined results: a null or empty text is one piece, the separator; every id lies in exactly one piece; rows with the same
id are packed each by itself; a null id stays null; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantrank.llm.common import TEXTS_PER_BATCH, write_stage
from variantrank.llm.tokens import encoder

CAPACITY, SLACK, LEAST_CUT, FAN_IN = 1024, 8, 16, 64
SEPARATOR = b"\0\0\0\0"


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document, in order."""
    pieces = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest > SLACK and rest > LEAST_CUT:
            own = capacity // (k + 1)
        else:
            own = rest
        pieces.append((own, capacity // own))
        rest -= own
    return pieces


def _schema(rows: DataFrame, with_ids: bool) -> str:
    kind = rows.schema["doc_id"].dataType.simpleString()
    ids = ", ids binary" if with_ids else ""
    return f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, k int, task long{ids}"


def _first_level(rows: DataFrame, vocabulary: str, capacity: int, with_ids: bool) -> DataFrame:
    """Pieces of every document; sequence_id is null for those in unfinished bins."""
    schema = _schema(rows, with_ids)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(vocabulary), TaskContext.get().partitionId()
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()] + [pa.binary()] * with_ids
        open_bins: dict[int, list[list]] = {}
        made, id_type = 0, None

        def batch_of(out: list[list]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
            types = [id_type or kinds[0], *kinds[1:]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], NAMES[: len(kinds)])

        for batch in batches:
            id_type, out = batch.column(0).type, []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + SEPARATOR
                start = 0
                for length, k in cut(len(ids) // 4, capacity):
                    own = ids[4 * start : 4 * (start + length)]
                    waiting = open_bins.setdefault(k, [])
                    offset = waiting[-1][6] + waiting[-1][2] if waiting else 0
                    waiting.append([doc, start, length, zlib.crc32(own), len(ids) // 4, None, offset, k, task] + [own] * with_ids)
                    if len(waiting) == k:
                        for piece in waiting:
                            piece[5] = (task << 36) + made
                        made += 1
                        out += waiting
                        open_bins[k] = []
                    start += length
                if len(out) >= 20_000 or with_ids and len(out) >= 1000:
                    yield batch_of(out)
                    out = []
            yield batch_of(out)
        yield batch_of([[*piece[:6], None, *piece[7:]] for waiting in open_bins.values() for piece in waiting])

    return rows.select("doc_id", "text").mapInArrow(fill, schema)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "k", "task", "ids"]


def _fill_again(rest: DataFrame, level: int, last: bool, capacity: int, schema: str) -> DataFrame:
    """Fill the bins of each class from the rests of FAN_IN tasks; the last level packs what stays by best fit."""

    def fill(pieces: pa.Table) -> pa.Table:
        group = pieces.column("task")[0].as_py() // FAN_IN
        k, length = pieces.column("k").to_numpy(), pieces.column("length").to_numpy()
        order = np.lexsort((pieces.column("ids_crc32").to_numpy(), pieces.column("start").to_numpy(), -length, k))
        pieces, k, length = pieces.take(order), k[order], length[order]
        first = np.r_[True, k[1:] != k[:-1]] if len(k) else np.empty(0, bool)
        place = np.arange(len(k)) - np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))
        size = np.bincount(k)[k]
        full = place < size // k * k
        names = np.cumsum((place % k == 0) & full) - 1
        before = np.cumsum(length) - length
        opens = np.maximum.accumulate(np.where(place % k == 0, np.arange(len(k)), 0))
        offset = before - before[opens]
        if last:
            names, offset = _best_fit(length, full, names, offset, capacity)
            full = np.ones(len(k), bool)
        at = pa.array((level << 58) + (group << 36) + names, pa.int64(), mask=~full)
        pieces = pieces.set_column(5, "sequence_id", at).set_column(6, "offset", pa.array(offset, pa.int64(), mask=~full))
        return pieces.set_column(8, "task", pa.array(np.full(len(k), group), pa.int64()))

    return rest.groupBy(F.floor(F.col("task") / FAN_IN).alias("g")).applyInArrow(fill, schema)


def _best_fit(length: np.ndarray, full: np.ndarray, names: np.ndarray, offset: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Put each piece that is not in a full bin, longest first, in the bin with the least room that takes it."""
    names, offset, made = names.copy(), offset.copy(), int(names.max(initial=-1)) + 1
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in sorted(np.flatnonzero(~full), key=lambda i: (-length[i], i)):
        need = int(length[i])
        room = next((r for r in range(need, capacity) if rooms[r]), capacity)
        if room == capacity:
            name, made = made, made + 1
        else:
            name = rooms[room].pop()
        names[i], offset[i] = name, capacity - room
        if room > need:
            rooms[room - need].append(name)
    return names, offset


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A document's ids are its text's and a separator, id 0. Sequence ids are unique, not consecutive.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = _schema(rows, with_ids)
    pieces = write_stage(_first_level(rows, vocabulary, capacity, with_ids), "pieces", TEXTS_PER_BATCH)
    packed, rest, level = pieces.where("sequence_id is not null"), pieces.where("sequence_id is null"), 1
    tasks = pieces.agg(F.max("task")).first()[0]
    while tasks is not None:
        tasks //= FAN_IN
        pieces = write_stage(_fill_again(rest, level, tasks == 0, capacity, schema), "pieces")
        packed, rest = packed.union(pieces.where("sequence_id is not null")), pieces.where("sequence_id is null")
        level += 1
        if tasks == 0:
            break
    return packed.drop("k", "task")
