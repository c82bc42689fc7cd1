"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, by Arrow's own operations.

A text is cut at the single spaces that no token of either tokenizer can reach over, and the different words of a batch are
encoded once by each tokenizer. Then, over flat arrays of all their tokens: parent indices name the word of each token,
cumulative sums less the word's own start give the byte offsets where tokens end, an Acero hash join on (word, end) finds
the offsets where tokens of both end, and cumulative sums of these number the groups. A hash join on the group links
tokens, counted by Table.group_by. Documents take the aligned words by index: their lists are flattened, parent indices and segmented
sums add up, and Table.group_by counts a document's linked id pairs. Counts of documents per pair leave
each task as partial counts and are merged by Spark, which then joins them to the documents' pairs.

The table of pairs grows with the vocabularies; it is broadcast up to MOST_BROADCAST rows and joined by a shuffle beyond that.
Work goes by slices of bounded size: SLICE bytes of text, ENCODED words, LINKS rows of links. A word of any length is cut nowhere.

Defined results: null and empty texts have no tokens, and neither has a text that one of the tokenizers does not give back byte
by byte (with a space before it); special tokens inside texts are plain text; rows with equal ids are aligned each by
itself; a null id stays null; very long texts are documents like others; ties for the highest count are all best; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantrank.llm.common import write_stage
from variantrank.llm.tokens import SPACES

#: Bytes of text and rows of links that are worked on at once, words that are encoded at once and that are remembered, words
#: whose groups are hashed at once.
SLICE, LINKS, ENCODED, MOST_WORDS, HASHED = 1 << 22, 1 << 20, 1 << 13, 200_000, 1 << 18
#: Pairs whose counts are kept in a task before they leave it, and those that are broadcast at most (17 bytes each).
PARTIAL, MOST_BROADCAST = 1 << 19, 1 << 22
#: An id pair is the first id times this, and the second: both vocabularies fit 31 bits together.
SECOND = 1 << 15
WHITE = SPACES.encode().decode("unicode_escape")
INNER = re.compile(f"(?<=[^{WHITE}]) (?=[^{WHITE}])")
UNSAFE = f" [{WHITE}]|[{WHITE}] |^[{WHITE}]|[{WHITE}]\\z"


def byte_level(path: str) -> list[bytes]:
    """The bytes of every token of a byte-level BPE file, by id: its printable stand-ins for bytes are undone."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    out = [b""] * (max(spec["model"]["vocab"].values()) + 1)
    for token, i in spec["model"]["vocab"].items():
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return out


def pieces_of(model) -> list[bytes]:
    """The bytes of every piece of a sentencepiece model, by id."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        single = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        out.append(bytes([int(single[1], 16)]) if single and model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


class Side:
    """One tokenizer: the ids of words, and for every id its bytes, their number and the id as text."""

    def __init__(self, encode, tokens: list[bytes]):
        self.encode, self.tokens = encode, pa.array(tokens, pa.large_binary())
        self.sizes = pc.cast(pc.binary_length(self.tokens), pa.int64())
        self.names = pa.array([str(i) for i in range(len(tokens))], pa.large_string())


def sides(a_path: str, b_path: str) -> tuple[Side, Side]:
    """The byte-level BPE of a_path, which gets the space before the word, and the model of b_path, which adds it."""
    import os

    import sentencepiece
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    return (
        Side(lambda words: [e.ids for e in a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)], byte_level(a_path)),
        Side(lambda words: b.encode(words, num_threads=1), pieces_of(b)),
    )


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), values)


def _joined(lists: pa.Array, between: str | bytes) -> pa.Array:
    return pc.binary_join(lists, pa.scalar(between, lists.type.value_type))


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Offsets of lists of these sizes."""
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Segmented sums: of the values between consecutive offsets."""
    return np.diff(_starts(values)[offsets])


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


class Aligned:
    """Aligned words, by index: number of tokens of each side (-1 where the bytes differ), groups and links, the groups as
    text, and the id pairs with their numbers of links."""

    def __init__(self, a: Side, b: Side):
        self.sides = a, b
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.counts = np.zeros((4, 0), np.int64)
        self.text = pa.array([], pa.large_string())
        self.pairs, self.weights, self.offsets = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def of(self, words: list[str]) -> np.ndarray:
        """Indices of different words; those not known yet are aligned now."""
        found = [self.index.get(w, -1) for w in words]
        new = [w for w, i in zip(words, found, strict=True) if i < 0]
        if new:
            first = len(self.index)
            self.index.update((w, first + i) for i, w in enumerate(new))
            for at in range(0, len(new), ENCODED):
                self._add(new[at : at + ENCODED])
            found = [self.index[w] for w in words]
        return np.array(found, np.int64)

    def _add(self, words: list[str]) -> None:
        flat, parent, ends, sizes, same = [], [], [], [], np.ones(len(words), bool)
        wanted = pa.array([(" " + w).encode() for w in words], pa.large_binary())
        tokens = []
        for side in self.sides:
            ids = pa.array(side.encode(words), pa.large_list(pa.int32()))
            tokens.append(ids)
            joined = _joined(_lists(ids.offsets.to_numpy(), side.tokens.take(ids.flatten())), b"")
            same &= pc.equal(joined, wanted).to_numpy(zero_copy_only=False)
        good = pa.array(same)
        for side, ids in zip(self.sides, tokens, strict=True):
            ids = ids.filter(good)
            flat.append(ids.flatten())
            parent.append(pc.cast(pc.list_parent_indices(ids), pa.int64()))
            sizes.append(pc.list_value_length(ids).to_numpy())
            upto = pc.cumulative_sum(side.sizes.take(flat[-1])).to_numpy() if len(flat[-1]) else np.zeros(0, np.int64)
            start = np.concatenate([[0], upto])[_starts(sizes[-1])[:-1]]
            ends.append(upto - start[parent[-1].to_numpy()])
        # Offsets where both sides end a token: a hash join on the word and the end.
        keys = [pa.table({"word": p, "end": pa.array(e), f"at{i}": pa.array(np.arange(len(e)))}) for i, (p, e) in enumerate(zip(parent, ends, strict=True))]
        met = keys[0].join(keys[1], ["word", "end"], join_type="inner", use_threads=False).sort_by("at0")
        last = [_column(met, "at0"), _column(met, "at1")]
        group, texts = [], []
        for side, ids, at in zip(self.sides, flat, last, strict=True):
            ended = np.zeros(len(ids) + 1, np.int64)
            ended[at + 1] = 1
            group.append(np.cumsum(ended)[:-1])
            texts.append(_joined(_lists(np.concatenate([[0], at + 1]), side.names.take(ids)), ","))
        of_group = _column(met, "word")
        n_groups = np.bincount(of_group, minlength=len(sizes[0])).astype(np.int64)
        both = pc.binary_join_element_wise(*texts, pa.scalar("|", pa.large_string()))
        word_text = _joined(_lists(_starts(n_groups), both), ";")
        word, pair, weight = self._links(flat, group, of_group)
        offsets = _starts(np.bincount(word, minlength=len(n_groups)))
        # Words whose bytes differ come in again, without tokens.
        counts = np.zeros((4, len(words)), np.int64)
        counts[0] = -1
        counts[:, same] = [sizes[0], sizes[1], n_groups, _sums(weight, offsets)]
        place = pa.array(np.where(same, np.cumsum(same) - 1, len(n_groups)))
        lengths = np.zeros(len(words), np.int64)
        lengths[same] = np.diff(offsets)
        self.counts = np.concatenate([self.counts, counts], axis=1)
        self.text = pa.concat_arrays([self.text, pa.concat_arrays([word_text, pa.array([""], pa.large_string())]).take(place)])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths)])
        self.pairs, self.weights = np.concatenate([self.pairs, pair.astype(np.int32)]), np.concatenate([self.weights, weight])

    def _links(self, flat: list[pa.Array], group: list[np.ndarray], of_group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, pair, number of links), by word: tokens of both sides joined on their group, equal ids of a group at once."""
        ids = []
        for i, (f, g) in enumerate(zip(flat, group, strict=True)):
            table = pa.table({"group": pa.array(g), f"id{i}": f}).group_by(["group", f"id{i}"], use_threads=False)
            ids.append(table.aggregate([([], "count_all")]).rename_columns(["group", f"id{i}", f"n{i}"]).sort_by("group"))
        partners = np.bincount(_column(ids[1], "group"), minlength=len(of_group))
        made = _starts(partners[_column(ids[0], "group")])
        out, at = [], 0
        while at < len(ids[0]):
            upto = max(at + 1, int(np.searchsorted(made, made[at] + LINKS, "right")) - 1)
            part = ids[0].slice(at, upto - at)
            own = _column(part, "group")
            lo, hi = np.searchsorted(_column(ids[1], "group"), [own[0], own[-1] + 1])
            met = part.join(ids[1].slice(lo, hi - lo), "group", join_type="inner", use_threads=False)
            pair = _column(met, "id0").astype(np.int64) * SECOND + _column(met, "id1")
            out.append(pa.table({"word": of_group[_column(met, "group")], "pair": pair, "n": _column(met, "n0") * _column(met, "n1")}))
            at = upto
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        counted = pa.concat_tables(out).group_by(["word", "pair"], use_threads=False).aggregate([("n", "sum")]).sort_by([("word", "ascending"), ("pair", "ascending")])
        return _column(counted, "word"), _column(counted, "pair"), _column(counted, "n_sum")


def words_of(text: pa.Array) -> pa.Array:
    """The words of texts as lists: cut at single spaces between other characters than white space."""
    cut = pc.split_pattern(text, " ")
    odd = pc.match_substring_regex(text, UNSAFE)
    if not pc.any(odd).as_py():
        return cut
    rows = zip(text.to_pylist(), cut.to_pylist(), odd.to_pylist(), strict=True)
    return pa.array([INNER.split(t) if o else c for t, c, o in rows], pa.large_list(pa.large_string()))


def _slices(text: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, length) of slices of whole texts of SLICE bytes, or one longer text."""
    upto = np.cumsum(pc.binary_length(text).fill_null(0).to_numpy())
    at = 0
    while at < len(text):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SLICE, "right")))
        yield at, end - at
        at = end


def _documents(text: pa.Array, aligned: Aligned) -> tuple[dict[str, pa.Array], pa.Table]:
    """Columns of documents (numbers, digests, pairs with their numbers of links), and (pair) of every document that holds it."""
    said = pc.cast(text.fill_null(""), pa.large_string())
    words = words_of(said).filter(pc.greater(pc.binary_length(said), 0))
    kept = np.flatnonzero(pc.binary_length(said).to_numpy())
    coded = words.flatten().dictionary_encode()
    word = aligned.of(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    starts = words.offsets.to_numpy() - words.offsets[0].as_py()
    whole = _sums(aligned.counts[0, word] < 0, starts) == 0
    if not whole.all():  # documents that are not given back lose their words
        sizes = np.diff(starts) * whole
        word, starts = word[np.repeat(whole, np.diff(starts))], _starts(sizes)
    counts = np.zeros((4, len(text)), np.int64)
    counts[:, kept] = [_sums(c, starts) for c in aligned.counts[:, word]]
    digests = [""] * len(text)
    for row, lo, hi in zip(kept, starts[:-1], starts[1:], strict=True):
        if hi > lo:
            sha = hashlib.sha256()
            for at in range(lo, hi, HASHED):
                part = aligned.text.take(pa.array(word[at : min(hi, at + HASHED)]))
                sha.update(b";" if at > lo else b"")
                sha.update(_joined(_lists([0, len(part)], part), ";")[0].as_buffer())
            digests[row] = sha.hexdigest()
    # The different words of each document, then the pairs of these words, then the different pairs.
    parent = np.repeat(kept, np.diff(starts))
    held = pa.table({"doc": parent, "word": word}).group_by(["doc", "word"], use_threads=False).aggregate([([], "count_all")])
    own, times = _column(held, "word"), _column(held, "count_all")
    sizes = np.diff(aligned.offsets)[own]
    at = np.arange(sizes.sum()) + np.repeat(aligned.offsets[own] - _starts(sizes)[:-1], sizes)
    rows = pa.table({"doc": np.repeat(_column(held, "doc"), sizes), "pair": aligned.pairs[at], "n": aligned.weights[at] * np.repeat(times, sizes)})
    # Pairs are numbered by document, so that one sort puts them in place.
    linked = rows.group_by(["doc", "pair"], use_threads=False).aggregate([("n", "sum")])
    order = np.argsort(_column(linked, "doc"), kind="stable")
    doc, pair, weight = _column(linked, "doc")[order], _column(linked, "pair")[order], _column(linked, "n_sum")[order]
    offsets = pa.array(_starts(np.bincount(doc, minlength=len(text))), pa.int32())
    columns = {c: pa.array(v) for c, v in zip(NUMBERS, counts, strict=True)} | {
        "groups_sha256": pa.array(digests, pa.string()),
        "pairs": pa.ListArray.from_arrays(offsets, pa.array(pair, pa.int32())),
        "weights": pa.ListArray.from_arrays(offsets, pa.array(weight, pa.int64())),
    }
    return columns, pa.table({"pair": pair, "docs": np.ones(len(pair), np.int64)})


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _merged(partial: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(partial).group_by("pair", use_threads=False).aggregate([("docs", "sum")]).rename_columns(["pair", "docs"])


def aligned_rows(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Of rows (id, text): a row for every document (row, id, its numbers, digest and linked pairs), and rows of partial
    counts (pair, docs), in which row is null."""
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, weights array<long>, pair int, docs long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        aligned, partial, held = Aligned(*sides(a_path, b_path)), [], 0
        made, id_type = TaskContext.get().partitionId() << 40, pa.null()

        def counts() -> pa.RecordBatch:
            merged = _merged(partial).combine_chunks().to_batches()
            columns = merged[0].columns if merged else [pa.array([], pa.int32()), pa.array([], pa.int64())]
            n = len(columns[0])
            types = [pa.int64(), id_type, *[pa.int64()] * 4, pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.nulls(n, t) for t in types] + [pc.cast(columns[0], pa.int32()), columns[1]], NAMES)

        for batch in batches:
            id_type = batch.column(0).type
            for at, n in _slices(batch.column(1)):
                columns, pairs = _documents(batch.column(1).slice(at, n), aligned)
                partial.append(_merged([pairs]))
                held += len(partial[-1])
                if held > PARTIAL:
                    partial = [_merged(partial)]
                    held = len(partial[0])
                    if held > PARTIAL:
                        yield counts()
                        partial, held = [], 0
                if len(aligned.index) > MOST_WORDS:
                    aligned.clear()
                names = pa.array(np.arange(made, made + n))
                made += n
                yield pa.RecordBatch.from_arrays([names, batch.column(0).slice(at, n), *columns.values(), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], NAMES)
        if partial:
            yield counts()

    return rows.mapInArrow(run, schema)


NAMES = ["row", "id", *NUMBERS, "groups_sha256", "pairs", "weights", "pair", "docs"]


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents and id pairs.

    Documents: id, n_a, n_b, n_groups, n_links, n_best (links whose pair is counted most of all pairs of its first id), count_sum
    (the counts of all links), groups_sha256. Pairs: a, b, docs (how many documents link them), best.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    stage = write_stage(aligned_rows(rows, a_path, b_path), "aligned")
    counted = write_stage(stage.where("pair is not null").groupBy("pair").agg(F.sum("docs").alias("docs")), "pair-counts")
    first = F.floor(F.col("pair") / SECOND).cast("int")
    most = counted.groupBy(first.alias("a")).agg(F.max("docs").alias("most"))  # as many rows as the first vocabulary has ids
    pairs = write_stage(
        counted.withColumn("a", first).join(F.broadcast(most), "a").select("pair", "a", F.col("pair") % SECOND, "docs", F.col("docs") == F.col("most")).toDF("pair", "a", "b", "docs", "best"),
        "pairs",
    )
    known = pairs.select("pair", "docs", "best")
    known = F.broadcast(known) if known.count() <= MOST_BROADCAST else known
    links = stage.where("row is not null").select("row", F.inline(F.arrays_zip("pairs", "weights"))).withColumnRenamed("pairs", "pair")
    sums = links.join(known, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("weights")).otherwise(0)).alias("n_best"), F.sum(F.col("weights") * F.col("docs")).alias("count_sum")
    )
    sums = write_stage(sums, "link-sums")
    found = stage.where("row is not null").select("row", "id", *NUMBERS, "groups_sha256").join(sums, "row", "left")
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select("id", *NUMBERS, none("n_best"), none("count_sum"), "groups_sha256"), pairs.drop("pair")
