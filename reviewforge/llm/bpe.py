"""Byte-pair vocabularies and a bounded memo, shared by the tokenizer operators."""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata

import regex

#: Pre-tokens of the byte-level vocabulary, as its file's pre-tokenizer defines them (fixed value).
BYTE_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens of the word vocabulary, as its file's pre-tokenizer defines them (fixed value).
WORD_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


@functools.cache
def byte_chars() -> list[str]:
    """The printable character that stands for each byte in vocabulary files of byte-level BPE.

    Printable Latin-1 bytes stand for themselves; the others take the
    characters from U+0100 on, in byte order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@functools.cache
def vocabulary(path: str) -> dict:
    """The ``model`` part of a tokenizers file and its added tokens."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model = whole["model"]
    model["added"] = {t["content"]: t["id"] for t in whole["added_tokens"]}
    model["normalizer"] = whole["normalizer"]
    return model


class Merges:
    """Byte-pair merges of a tokenizers file: pair -> rank, rank -> merged id."""

    def __init__(self, path: str):
        model = vocabulary(path)
        ids = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {ids[a] << SHIFT | ids[b]: r for r, (a, b) in enumerate(pairs)}
        self.merged = [ids[a + b] for a, b in pairs]


#: Bits of an id inside a pair.
SHIFT = 24


@functools.cache
def merge_table(path: str) -> Merges:
    return Merges(path)


def merge(symbols: list[int], merges: Merges) -> int:
    """Merge ``symbols`` in place by byte-pair rank and return how many merges were made.

    The symbols are a doubly linked list over their first positions; a heap
    holds the adjacent pairs by (rank, position), packed into one integer. The
    lowest pair is popped again and again; an entry whose pair has changed
    meanwhile is skipped. O(n log n) for any length. Afterwards the surviving
    symbols are the entries that are not -1, in order.
    """
    n = len(symbols)
    get = merges.rank.get
    heap = []
    for i in range(n - 1):
        rank = get(symbols[i] << SHIFT | symbols[i + 1])
        if rank is not None:
            heap.append(rank * n + i)
    if not heap:
        return 0
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pop, push, merged_id = heapq.heappop, heapq.heappush, merges.merged
    count = 0
    while heap:
        rank, i = divmod(pop(heap), n)
        left, j = symbols[i], after[i]
        if left < 0 or j >= n or get(left << SHIFT | symbols[j]) != rank:
            continue
        merged = symbols[i] = merged_id[rank]
        symbols[j] = -1
        count += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = get(merged << SHIFT | symbols[k])
            if rank is not None:
                push(heap, rank * n + i)
        h = before[i]
        if h >= 0:
            rank = get(symbols[h] << SHIFT | merged)
            if rank is not None:
                push(heap, rank * n + h)
    return count


class Memo(dict):
    """A dictionary that computes missing values; it is emptied when it holds ``limit`` keys.

    Only speed depends on the limit, and memory stays bounded on any corpus.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


def unassigned(text: str) -> bool:
    """Whether ``text`` holds a code point that this Python's Unicode tables don't know.

    Unicode versions differ between the regex module and the tokenizers
    library; such a text is split by the library itself.
    """
    return not text.isprintable() and any(unicodedata.category(c) == "Cn" for c in text)


@functools.cache
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def pattern(text: str):
    return regex.compile(text, regex.V0)


@functools.cache
def blanks() -> frozenset[str]:
    """The characters that the pre-token patterns take as white space."""
    space = pattern(r"\s").match
    return frozenset(c for c in map(chr, range(0x10000)) if space(c))
