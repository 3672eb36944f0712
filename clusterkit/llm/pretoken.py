"""Splitting text into the pieces that byte-level BPE encodes one by one.

The pattern is that of the public tokenizer, in terms of Python's own character classes, which run
twice as fast as full Unicode properties. Texts with a code point on which the two differ (letters
and digits newer than Python's tables, fractions and roman numerals, four control characters)
are split by the tokenizers library itself.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import lru_cache

# Contractions, words, digits, other signs, white space.
PATTERN = r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"

_split = re.compile(PATTERN).findall


#: Code points that both see alike; grows with the texts, up to all of Unicode.
_alike: set[str] = set()


def _odd(text: str) -> bool:
    """Whether the fast pattern and the library may see a code point of the text differently."""
    new = set(text) - _alike
    odd = {c for c in new if "\x1c" <= c <= "\x1f" or unicodedata.category(c) in ("Cn", "No", "Nl")}
    _alike.update(new - odd)
    return bool(odd)


@lru_cache(4)
def library(path: str):
    """The tokenizer of a file, without threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def pieces(text: str, path: str) -> list[str]:
    """The pieces of a text without special strings, in order; together they are the text."""
    if _odd(text):
        cuts = library(path).pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in cuts]
    return _split(text)


@lru_cache(1)
def alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where printable, else the next free code."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE file: bytes of each id, rank and halves of each merge, special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        byte = alphabet()
        model = data["model"]
        self.path = path
        self.id_of = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()}
        size = 1 + max([*self.id_of.values(), *(t["id"] for t in data["added_tokens"])])
        self.bytes_of = [b""] * size
        for token, i in self.id_of.items():
            self.bytes_of[i] = token
        self.rank = [-1] * size
        self.halves = [(-1, -1)] * size
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = model["vocab"][left], model["vocab"][right]
            whole = model["vocab"][left + right]
            self.merge[a, b] = whole
            self.rank[whole], self.halves[whole] = rank, (a, b)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split

    def parts(self, text: str) -> list[str]:
        """Ordinary text and special strings by turns; the special ones have the odd places."""
        return self._cut(text) if self.special else [text]

    def split(self, text: str) -> list[str]:
        """All pieces of a text; a special string is a piece of its own."""
        out: list[str] = []
        for k, part in enumerate(self.parts(text)):
            if k % 2:
                out.append(part)
            elif part:
                out += pieces(part, self.path)
        return out


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# Fixed value: the public tokenizer's own pattern.
LIBRARY_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(2)
def rank_encoding(path: str):
    """The file's vocabulary in the rank-based library, which gives the ids of the tokenizers library
    (tested on every code point) in a quarter of its time. Ids must rise with the order of the
    merges, as they are the ranks."""
    import tiktoken

    vocab = vocabulary(path)
    merged = [i for _, i in sorted((rank, i) for i, rank in enumerate(vocab.rank) if rank >= 0)]
    if merged != sorted(merged):
        raise ValueError(f"{path}: ids do not follow the order of merges")
    return tiktoken.Encoding("file", pat_str=LIBRARY_PATTERN, mergeable_ranks=dict(vocab.id_of),
                             special_tokens=dict(vocab.special))


class PieceTable(dict):
    """What is known of each piece, filled for all new pieces of a batch together.

    ``fill(pieces)`` gives their values. At ``most`` entries the table starts anew: it is a
    store of repeated work, so this changes no result.
    """

    def __init__(self, vocab: Vocabulary, fill, special, most: int = 400_000):
        super().__init__()
        self.vocab, self.fill, self.most = vocab, fill, most
        self.start = {content: special(i) for content, i in vocab.special.items()}
        self.update(self.start)

    def learn(self, texts: list[str]) -> list[list[str]]:
        """The pieces of each text, all of them now in the table."""
        split = [self.vocab.split(text) for text in texts]
        new: set[str] = set().union(*split) - self.keys()
        if len(self) + len(new) > self.most:
            self.clear()
            self.update(self.start)
            new = set().union(*split) - self.keys()
        order = sorted(new)
        self.update(zip(order, self.fill(order)))
        return split


def blocks(texts: list[str], chars: int = 4_000_000):
    """Runs of texts with at most so many characters, or one longer text: bounds the memory."""
    run, held = [], 0
    for text in texts:
        if run and held + len(text) > chars:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run
