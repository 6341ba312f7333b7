"""Operator 4: BPE encoding and decoding with forced-boundary splitting.

A pair of adjacent symbols that occurs inside no vocabulary token can never be
merged, so it marks a certain cut. Words are cut at such pairs, the fragments
are encoded independently and their ids concatenated. Fragments and words
repeat, so both are kept in bounded memos per Python worker.

The symbols of the word vocabulary are bytes, the last byte of a word carrying
the end mark; texts are brought to NFC and lower case first, as the vocabulary
file says. Decoding joins the token strings by spaces: the file names no
decoder, and that is what the library then does.

Defined results: a null or empty text has no tokens, its digests are those of
the empty string; special strings inside a text are one id each; rows with the
same id or a null id are each encoded; texts of any length are encoded whole.
Only the two named columns are read, whatever else there is.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import public_tokenizers
from pyspark.sql import DataFrame

from .bpe import WORD_PRETOKEN, Memo, byte_chars, library, merge, merge_table, pattern, unassigned, vocabulary
from .common import map_batches, sole

PIECES, WORDS, FRAGMENTS = 300_000, 500_000, 300_000


class Codec:
    """Encodes and decodes texts under a BPE vocabulary file with word ends."""

    def __init__(self, path: str):
        model = vocabulary(path)
        self.path = path
        self.ids, self.end = model["vocab"], model["end_of_word_suffix"]
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in model["added"].items()}
        self.added = model["added"]
        self.table = merge_table(path)
        chars = byte_chars()
        self.inner = [self.ids[c] for c in chars]
        self.last = [self.ids[c + self.end] for c in chars]
        self.joined = self._joined_pairs(model)
        self.find = pattern(WORD_PRETOKEN).findall
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.fragments = Memo(self.of_fragment, FRAGMENTS)
        self.words = Memo(self.of_word, WORDS)
        self.pieces = Memo(self.of_piece, PIECES)

    def _joined_pairs(self, model: dict) -> set[tuple[int, int]]:
        """Adjacent symbols inside any vocabulary token."""
        pairs = set()
        for token, i in model["vocab"].items():
            if token in model["added"]:
                continue
            body = token.removesuffix(self.end) if len(token) > len(self.end) else token
            symbols = [self.ids[c] for c in body]
            if body != token:
                symbols[-1] = self.ids[body[-1] + self.end]
            pairs.update(zip(symbols, symbols[1:]))
        return pairs

    def of_fragment(self, fragment: tuple[int, ...] | list[int]) -> tuple[int, ...]:
        symbols = list(fragment)
        merge(symbols, self.table)
        return tuple(s for s in symbols if s >= 0)

    def of_word(self, word: str) -> tuple[int, ...]:
        return self.of_bytes(word.encode())

    def of_bytes(self, data: bytes) -> tuple[int, ...]:
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        cuts = [i for i, pair in enumerate(zip(symbols, symbols[1:]), 1) if pair not in self.joined]
        if not cuts:
            return self.of_fragment(symbols)
        found: tuple[int, ...] = ()
        for start, stop in zip([0, *cuts], [*cuts, len(symbols)]):
            found += self.fragments[tuple(symbols[start:stop])]
        return found

    def of_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of the text between two spaces; no pre-token goes across a space."""
        if unassigned(piece):
            lib, code = library(self.path), {c: b for b, c in enumerate(byte_chars())}
            parts = (w for w, _ in lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(piece)))
            return tuple(i for w in parts for i in self.of_bytes(bytes(code[c] for c in w)))
        plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()  # capital sigma has no final form in the file's rule
        return tuple(i for w in self.find(plain) for i in self.words[w])

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for k, segment in enumerate(self.special.split(text or "")):
            if k % 2:
                out.append(self.added[segment])
            elif segment:
                for ids in map(self.pieces.__getitem__, segment.split(" ")):
                    out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def codec(path: str) -> Codec:
    """One per Python worker process, so that its memos serve all tasks."""
    return sole(Codec, path)


def encode(docs: DataFrame, path: str | None = None, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) for every row of ``docs``: the ids of the whole text and the text decoded from them."""
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def run(cols: dict[str, list]) -> dict[str, list]:
        c = codec(path)
        ids = [c.encode(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "ids": ids, "decoded": [c.decode(x) for x in ids]}

    rows = docs.select(docs[doc_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return map_batches(rows, run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what :func:`encode` returns, digested beside the encoder.

    The ids never leave the Python worker, which halves the work between it and the JVM.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def run(cols: dict[str, list]) -> dict[str, list]:
        c = codec(path)
        out = {"doc_id": cols["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in cols["text"]:
            ids = c.encode(text)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
        return out

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return map_batches(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
