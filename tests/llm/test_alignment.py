import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import *  # noqa: F403

from variantrank.llm import alignment

tokenizers = pytest.importorskip("public_tokenizers")
A, B = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(texts):
    """Whole texts by both tokenizers, byte by byte, links one by one."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    stand_in = {}
    n = 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            stand_in[chr(byte)] = byte
        else:
            stand_in[chr(256 + n)] = byte
            n += 1
    links, rows = [], []
    for text in texts:
        groups = []
        if text:
            ours, theirs = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            left = [bytes(stand_in[c] for c in a.id_to_token(i)) for i in ours]
            right = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in theirs for p in [b.id_to_piece(i)]]
            if b"".join(left) == b"".join(right) == (" " + text).encode():
                ends = [np.cumsum([len(x) for x in side]) for side in (left, right)]
                both = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
                cut = [np.searchsorted(both, e) for e in ends]
                groups = [([ours[i] for i in np.flatnonzero(cut[0] == g)], [theirs[i] for i in np.flatnonzero(cut[1] == g)]) for g in range(len(both))]
        links.append(Counter((x, y) for xs, ys in groups for x in xs for y in ys))
        said = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        rows.append([sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), hashlib.sha256(said.encode()).hexdigest() if groups else ""])
    held = Counter(pair for link in links for pair in link)
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (n_a, n_b, n_groups, digest), link in zip(rows, links, strict=True):
        best = sum(n for p, n in link.items() if held[p] == most[p[0]])
        out.append((n_a, n_b, n_groups, sum(link.values()), best, sum(n * held[p] for p, n in link.items()), digest))
    return out, held


ODD = [
    "<|endoftext|> and </s> <unk> <0x41>", "a  b", " lead", "trail ", "tab\there\nand\r\n\r\nmore", "▁piece ▁", "x▁y z", "don't we'll 12,345.67",
    "日本語のテキスト 中文", "🙂🙂👩‍👩‍👧 é é", " nb  em　id", "\u0085 next", "a\x00b", "naïve ﬁ ½", " ", "\n", "  ", "ends  ",
]


def check(spark, rows):
    got = alignment.align(spark, A, B)[0].select("id", *COLUMNS).collect()
    want, _ = brute([t for _, t, *_ in rows])
    assert Counter(tuple(r) for r in got) == Counter((r[0], *w) for r, w in zip(rows, want, strict=True))


def test_equals_brute_force(spark, odd_rows, monkeypatch):
    rows = [r for r in odd_rows if r[1] is None or len(r[1]) < 30_000] + [(500 + i, t, "en", "s") for i, t in enumerate(ODD)]
    docs = documents(spark, rows).repartition(3)  # noqa: F405
    check(docs, rows)
    for name, value in (("SLICE", 300), ("LINKS", 5), ("MOST_WORDS", 20), ("HASHED", 3), ("PARTIAL", 10)):
        monkeypatch.setattr(alignment, name, value)
    some = rows[:6] + rows[-24:]
    check(documents(spark, some), some)  # noqa: F405


def test_pairs_and_shuffled_join(spark, monkeypatch):
    rows = [(i, prose(i, 40 + i), "en", "s") for i in range(12)]  # noqa: F405
    monkeypatch.setattr(alignment, "MOST_BROADCAST", -1)
    docs, pairs = alignment.align(documents(spark, rows), A, B)  # noqa: F405
    want, held = brute([t for _, t, *_ in rows])
    assert sorted(tuple(r) for r in docs.select("id", *COLUMNS).collect()) == [(i, *w) for i, w in enumerate(want)]
    assert {(r.a, r.b): r.docs for r in pairs.collect()} == dict(held)


def test_one_word_without_common_ends(spark):
    """A group of thousands of tokens is linked in slices."""
    rows = [(1, "x" * 3000, "en", "s"), (2, "ab" * 900 + "é" * 500, "en", "s")]
    check(documents(spark, rows), rows)  # noqa: F405


def test_no_rows(spark, none):
    docs, pairs = alignment.align(none, A, B)
    assert docs.collect() == pairs.collect() == []


def test_words():
    cut = alignment.words_of(pa.array(["a b", "a  b c", " a b ", "a\n b"], pa.large_string())).to_pylist()
    assert cut == [["a", "b"], ["a  b", "c"], [" a", "b "], ["a\n b"]]
