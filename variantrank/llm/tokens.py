"""Token ids of whole texts by a public byte-level BPE vocabulary, with a cache of the words that recur.

The vocabulary is read from its rank file, whose ids equal those of the tokenizer file of the same name (a test compares
them over whole texts and odd white space).
"""

from __future__ import annotations

import array
import base64
import re
from collections.abc import Callable

#: Unicode white space as the tokenizer's splitting pattern sees it, and that pattern (fixed values).
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where a cut at single spaces could change the pieces: next to more white space, and at the ends of the text.
UNSAFE = re.compile(f" [{SPACES}]|[{SPACES}] |^[{SPACES}]|[{SPACES}]\\Z")
#: Any other white space than the space and the line feed: rare, and found much faster than UNSAFE.
RARE = re.compile(f"[{SPACES.replace('\\t-\\r ', '\\t\\x0b-\\r')}]")
MOST_CACHED, LONGEST_CACHED = 400_000, 48
SPECIAL = {"<|endoftext|>": 50256}


def unsafe(text: str) -> bool:
    """Whether UNSAFE is found in a text that is not empty."""
    if "  " in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n":
        return True
    return RARE.search(text) is not None and UNSAFE.search(text) is not None


def encoder(path: str) -> Callable[[str | None], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit numbers; null counts as empty.

    A word after a single space is encoded by itself: the pattern never joins it with what stands before the space.
    Other texts, and those that spell the special token out, are encoded whole.
    """
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    bpe = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def packed(ids: list[int]) -> bytes:
        out = array.array("I", ids)
        if out.itemsize != 4:
            out = array.array("L", ids)
        return out.tobytes()

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            if word[-1] in ".,!?;:" and word[:-1].isalpha():  # letters and a mark are two pieces
                found = self[word[:-1]] + marks[word[-1]]
            else:
                found = packed(bpe.encode_ordinary(" " + word))
            if len(word) <= LONGEST_CACHED:
                if len(self) >= MOST_CACHED:
                    self.clear()
                self[word] = found
            return found

    marks = {mark: packed(bpe.encode_ordinary(mark)) for mark in ".,!?;:"}
    known = Words()

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in SPECIAL):
            return _whole(bpe, text, packed)
        if unsafe(text):
            return packed(bpe.encode_ordinary(text))
        first, *rest = text.split(" ")
        return packed(bpe.encode_ordinary(first)) + b"".join(map(known.__getitem__, rest))

    return encode


def _whole(bpe, text: str, packed) -> bytes:
    """Special tokens first, then each stretch between them as a text of its own."""
    special = "|".join(map(re.escape, SPECIAL))
    out = []
    for part in re.split(f"({special})", text):
        out += [SPECIAL[part]] if part in SPECIAL else bpe.encode_ordinary(part)
    return packed(out)
