import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import *  # noqa: F403

from variantrank.llm import harmonic, length_histogram
from variantrank.llm.tokens import encoder

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_ids_equal_the_tokenizers(tokenizer, odd_rows):
    encode, pick = encoder(RANKS), random.Random(3)
    letters = list(" \t\n\r\x0b\x0c\x1c\x1d\x85\xa0   　​﻿'sabcAB1 2.,!é中²½|") + ["<|endoftext|>", " ", " ", "'ll"]
    texts = [t for _, t, _, _ in odd_rows] + ["".join(pick.choice(letters) for _ in range(pick.randint(0, 14))) for _ in range(5000)]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == ids_of(tokenizer, text).tolist()[:-1], repr(text)


@pytest.mark.parametrize("length", [1, 2, 15, 16, 17, 500, 512, 700, 1023, 1024, 1025, 9999])
def test_cut(length):
    pieces = harmonic.cut(length)
    assert sum(n for n, _ in pieces) == length
    assert all(n * k <= 1024 < n * (k + 1) for n, k in pieces)
    assert len(pieces) <= length // 1024 + 5


def check_packing(rows, pieces, tokenizer, capacity=1024):
    want = Counter((i, len(ids_of(tokenizer, t))) for i, t in rows)
    starts, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        starts[p.doc_id, p.doc_tokens].append((p.start, p.length, p.ids_crc32))
        sequences[p.sequence_id].append((p.offset, p.length))
    assert Counter({k: sum(s == 0 for s, _, _ in v) for k, v in starts.items()}) == want
    for (i, n), found in starts.items():
        assert sum(x for _, x, _ in found) == n * want[i, n]
    texts = dict(rows)
    for (i, _), found in starts.items():
        if i is not None:
            ids = ids_of(tokenizer, texts[i])
            assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in found)
    for found in sequences.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= capacity
    return sequences


def test_packing(spark, odd, odd_rows, none, tokenizer, monkeypatch):
    rows = [(i, t) for i, t, _, _ in odd_rows]
    for fan_in in (64, 2):
        monkeypatch.setattr(harmonic, "FAN_IN", fan_in)
        pieces = harmonic.pack(odd.repartition(7), RANKS).collect()
        sequences = check_packing(rows, pieces, tokenizer)
        tokens = sum(p.length for p in pieces)
        assert len(sequences) <= tokens / 1024 + 2
    assert harmonic.pack(none, RANKS).count() == 0


def test_pieces_carry_ids(odd, odd_rows, tokenizer):
    texts = dict((i, t) for i, t, _, _ in odd_rows)
    for p in harmonic.pack(odd, RANKS, with_ids=True).collect():
        if p.doc_id is not None:
            assert ids_of(tokenizer, texts[p.doc_id])[p.start : p.start + p.length].tobytes() == bytes(p.ids)


def test_histogram(odd, odd_rows, none, tokenizer):
    lengths = defaultdict(list)
    for _, t, lang, _ in odd_rows:
        lengths[lang].append(len(ids_of(tokenizer, t)) - 1)
    table = length_histogram.totals(length_histogram.histogram(odd, RANKS, "lang")).cache()
    for r in table.collect():
        own = lengths[r.group]
        assert r.n_docs == own.count(r.length)
        assert (r.docs_from, r.tokens_from) == (sum(x >= r.length for x in own), sum(x for x in own if x >= r.length))
        assert r.cut_tokens == sum(min(x, r.length) for x in own)
        assert r.share_to == pytest.approx(sum(x <= r.length for x in own) / len(own))
    for limit in (0, 1, 77, 4096):
        assert {r.group: r.tokens for r in length_histogram.cut_total(table, limit).collect()} == {g: sum(min(x, limit) for x in v) for g, v in lengths.items()}
    middle = {r.group: r.length for r in length_histogram.quantile(table, 0.5).collect()}
    assert middle == {g: sorted(v)[(len(v) + 1) // 2 - 1] for g, v in lengths.items()}
    assert length_histogram.totals(length_histogram.histogram(none, RANKS, "lang")).count() == 0
