"""Operator 1: token counts by heap-and-linked-list byte-pair merging.

The count of a pre-token is its number of bytes minus the number of merges
made on it; no identifiers are built. Pre-tokens repeat, so counts are kept in
a bounded memo per Python worker: first by the text between two spaces, then
by pre-token. There is no shuffle: a scan, one mapping, four columns.

Defined results: a null or empty text counts 0 bytes and 0 tokens; rows with
the same id, or a null id, are counted each; a special string inside a text
counts as one token, as in the library's default; texts of any length are
counted whole. Only the two named columns are read, whatever else there is.
"""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame

from .bpe import BYTE_PRETOKEN, Memo, byte_chars, library, merge, merge_table, pattern, unassigned, vocabulary
from .common import map_batches, sole

PIECES, PRETOKENS = 400_000, 800_000


class Counter:
    """Counts tokens of texts under a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        ids = vocabulary(path)["vocab"]
        self.path = path
        self.first = [ids[c] for c in byte_chars()]
        self.table = merge_table(path)
        self.find = pattern(BYTE_PRETOKEN).findall
        self.space = pattern(r"\s")
        self.special = re.compile("|".join(map(re.escape, sorted(vocabulary(path)["added"], key=len, reverse=True))) or r"(?!)")
        self.pretokens = Memo(self.of_pretoken, PRETOKENS)
        self.pieces = Memo(self.of_piece, PIECES)

    def of_pretoken(self, word: str) -> int:
        return self.of_symbols([self.first[b] for b in word.encode()])

    def of_symbols(self, symbols: list[int]) -> int:
        return len(symbols) - merge(symbols, self.table)

    def of_piece(self, piece: str) -> int | None:
        """Tokens of a space and ``piece``, or None if the cut at that space is not certain.

        A space between two characters that are not white space always starts a
        pre-token, so texts may be cut there. A piece that is empty, or starts or
        ends with white space, makes a longer run of white space.
        """
        if not piece or self.space.match(piece) or self.space.match(piece[-1]):
            return None
        return self.of_plain(" " + piece)

    def of_plain(self, text: str) -> int:
        if unassigned(text):
            code = {c: b for b, c in enumerate(byte_chars())}
            parts = (w for w, _ in library(self.path).pre_tokenizer.pre_tokenize_str(text))
            return sum(self.of_symbols([self.first[code[c]] for c in w]) for w in parts)
        return sum(map(self.pretokens.__getitem__, self.find(text)))

    def of_segment(self, text: str) -> int:
        head, *rest = text.split(" ")
        if not rest or not head or self.space.match(head[-1]):
            return self.of_plain(text)
        try:
            return self.of_plain(head) + sum(map(self.pieces.__getitem__, rest))
        except TypeError:  # a piece is None
            return self.of_plain(text)

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        segments = self.special.split(text)
        return sum(map(self.of_segment, segments)) + len(segments) - 1


def counter(path: str) -> Counter:
    """One per Python worker process, so that its memo serves all tasks."""
    return sole(Counter, path)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 1024, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    ``path``: a tokenizers file of byte-level BPE; ``limit``: the context
    length above which ``over_limit`` is true.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def run(cols: dict[str, list]) -> dict[str, list]:
        count = counter(path)
        tokens = [count(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "n_bytes": [len(t.encode()) if t else 0 for t in cols["text"]], "n_tokens": tokens, "over_limit": [n > limit for n in tokens]}

    rows = docs.select(docs[doc_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return map_batches(rows, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
