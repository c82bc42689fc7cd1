"""Licence scan with a positional rare-token index.

Only words of the templates matter, and of those only each template's words of highest inverse document frequency, as
counted over all files, stand in the index with their places in the template. A file's hits on these rare words name a
template and the place where it would begin; hits that agree on both are intersected, and only there the template is
compared. A template counts if all its mandatory key phrases stand in place and the found words hold enough of its weight.
Phrases that must be found wherever they stand are templates that are mandatory as a whole.

Defined results: null and empty texts hold no word and no licence, with score 0; rows with equal ids are scanned each by
itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """A licence notice: its label, its text, and phrases in it that must all be found. base: a phrase to count."""

    label: str
    text: str
    mandatory: tuple[str, ...] = ()
    base: bool = False


#: Phrases to be counted and common notices with what they cannot do without (fixed values).
TEMPLATES = (
    Template("cc-by", "cc by", ("cc by",), True),
    Template("gpl", "general public license", ("general public license",), True),
    Template("reserved", "all rights reserved", ("all rights reserved",), True),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license version 3",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license version 2",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
)
#: Rare words indexed per template, and the share of a template's weight that must be found in place.
ANCHORS, MIN_SCORE = 3, 0.6
#: Lower-cases A-Z; all other ASCII but letters and digits becomes a space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def frequencies(docs: DataFrame, text_col: str, templates: tuple[Template, ...]) -> tuple[int, dict[bytes, int]]:
    """Number of files, and of files with each word of the templates. One row per word and task is shuffled."""
    vocabulary = frozenset(w for t in templates for w in words(t.text))

    def count(batches):
        found, files = Counter(), 0
        for batch in batches:
            files += batch.num_rows
            for text in batch.column(0):
                found.update(vocabulary.intersection(words(text.as_py())))
        rows = [(b"", files), *found.items()]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())], ["word", "n"])

    counted = docs.select(text_col).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r["word"]): r["n"] for r in counted.collect()}  # as many rows as the templates have words
    return found.pop(b"", 0), found


class Index:
    """Postings of each template's rarest words: word -> [(template, place of the word in it)]."""

    def __init__(self, templates: tuple[Template, ...], files: int, found: dict[bytes, int]):
        self.templates = templates
        self.words = [words(t.text) for t in templates]
        self.phrases = [[words(p) for p in t.mandatory] for t in templates]
        self.weight = {w: math.log((files + 1) / (found.get(w, 0) + 1)) + 1 for ws in self.words for w in ws}
        self.total = [sum(self.weight[w] for w in ws) for ws in self.words]
        self.needed, self.postings = [], defaultdict(list)
        for t, ws in enumerate(self.words):
            rare = sorted(set(ws), key=lambda w: (-self.weight[w], w))[: 1 if templates[t].base else ANCHORS]
            self.needed.append(min(2, len(rare)))
            for w in rare:
                self.postings[w] += [(t, at) for at, x in enumerate(ws) if x == w]

    def scan(self, text: str | None) -> tuple:
        """(n_words, n_base, first_word, last_word, base_labels, labels, score)."""
        ws = words(text)
        votes: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        postings = self.postings
        for i in [i for i, w in enumerate(ws) if w in postings]:
            for t, at in postings[ws[i]]:
                votes[t, i - at].add(ws[i])
        places, base, labels, score = [], set(), set(), 0.0
        for (t, start), rare in votes.items():
            if len(rare) < self.needed[t]:
                continue
            share = self._share(t, start, ws)
            if share < MIN_SCORE or not all(self._stands(p, t, start, ws) for p in self.phrases[t]):
                continue
            labels.add(self.templates[t].label)
            score = max(score, share)
            if self.templates[t].base:
                base.add(self.templates[t].label)
                places.append(start)
        return (
            len(ws), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), min(1.0, score),
        )

    def _share(self, t: int, start: int, ws: list[bytes]) -> float:
        """Share of the template's weight found in place."""
        own = self.words[t]
        return sum(self.weight[w] for at, w in enumerate(own) if 0 <= start + at < len(ws) and ws[start + at] == w) / self.total[t]

    def _stands(self, phrase: list[bytes], t: int, start: int, ws: list[bytes]) -> bool:
        """Whether the phrase stands where the template has it."""
        own, n = self.words[t], len(phrase)
        return any(own[at : at + n] == phrase and start + at >= 0 and ws[start + at : start + at + n] == phrase for at in range(len(own) - n + 1))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per file: counts and places of the base phrases, labels of all licences found, and the best score."""
    index = Index(templates, *frequencies(docs, text_col, templates))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def look(batches):
        for batch in batches:
            found = [index.scan(text.as_py()) for text in batch.column(1)]
            columns = zip(*found, strict=True) if found else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], [id_col, *names])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.select(id_col, text_col).mapInArrow(look, schema)
