"""Operator 12: how two tokenizers cut the same texts, as an Arrow pipeline.

A text's tokens under A and B are byte ranges of one string. Where both end, the
tokens fall into groups; an A token and a B token are linked where their ranges
overlap. Every end of a token of either kind closes exactly one such overlap, so
the links are the union of the two lists of ends, both of which are sorted.

Each slice of a batch is a few Arrow calls over all its documents: the lists of
ids are flattened with their parent indices, lengths of the tokens are summed up
within each document, merging the ends of A and of B finds those that they share
and those that they don't, and a search gives each end the token that it lies in.
Ids of a link are one number, ``a << 32 | b``.

A bundle is some megabytes of documents of one task. Its links, written with the
documents, are counted by ``Table.group_by``; Spark adds the bundles' counts up,
finds the highest of each B id, and deals the counts back to the bundles that
hold the pair. A pair that is in every document is thus one row a bundle, never
one a document. A hash join in each bundle ends it.

Defined results: a text that is null or empty, or that A or B does not spell as a
space and the text byte by byte, has no tokens: zeros and an empty digest; rows
with the same id are aligned each; an empty table gives no row. Texts of any
length are taken whole. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_chars, vocabulary
from .common import python_ready, sole, stored
from .token_files import Encoder

#: Bytes of text that are aligned at once, and that make a bundle.
SLICE, BUNDLE = 1 << 20, 4 << 20
#: Pieces that A's memo holds: less than where the encoder is alone, for the joins beside it.
PIECES = 300_000

ALIGNED = "bundle long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>"
PARTIAL = "bundle long, pair long, n long"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# -- the two tokenizers -----------------------------------------------------------------------


class Bytewise(Encoder):
    """A: a space and the text by a byte-level vocabulary; special strings are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(path)
        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        self.model, self.special = self.lib.model, []
        self.pieces.limit = PIECES
        code = {c: b for b, c in enumerate(byte_chars())}
        model = vocabulary(path)
        names = {i: t for t, i in {**model["added"], **model["vocab"]}.items()}
        self.spelling = pa.array([bytes(map(code.__getitem__, names[i])) if i in names and all(c in code for c in names[i]) else b"" for i in range(max(names) + 1)], pa.binary())

    def __call__(self, text: str) -> np.ndarray:
        try:
            data = b"".join(map(self.pieces.__getitem__, text.split(" ")))
        except TypeError:  # white space that may not be cut
            data = self.whole(" " + text)
        return np.frombuffer(data, "<u4").view("<i4")


class Piecewise:
    """B: the text by a sentencepiece model, which puts the space before it."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.lib = SentencePieceProcessor(model_file=path)
        self.spelling = pa.array([self._bytes(i) for i in range(self.lib.get_piece_size())], pa.binary())

    def _bytes(self, i: int) -> bytes:
        piece = self.lib.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.lib.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.lib.encode(texts, num_threads=1)


def _pair(a: str, b: str) -> tuple[Bytewise, Piecewise]:
    return Bytewise(a), Piecewise(b)


def tokenizers(a: str, b: str) -> tuple[Bytewise, Piecewise]:
    """One pair per Python worker process."""
    return sole(_pair, a, b)


# -- one slice --------------------------------------------------------------------------------


def _ends(ids: pa.ListArray, spelling: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(document << 32 | end, id) of every token: its bytes' end within its document."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids).cast(pa.int64())
    if not len(flat):
        return doc, flat
    total = pc.cumulative_sum(pc.binary_length(spelling).take(flat).cast(pa.int64()))
    # Segmented: less the sum at the end of the document before.
    before = pc.subtract(ids.offsets.slice(0, len(ids)), 1)
    base = pc.if_else(pc.less(before, 0), 0, total.take(pc.max_element_wise(before, 0)))
    return pc.add(pc.shift_left(doc, 32), pc.subtract(total, base.take(doc))), flat


def _grouped(tokens: pa.Array, last: pa.Array) -> pa.Array:
    """Each group's ids, decimal, joined by commas; ``last``: the place of each group's last token."""
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.add(last, 1).cast(pa.int32())])
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.cast(tokens, pa.string())), ",")


def aligned(a: pa.ListArray, b: pa.ListArray, spell_a: pa.Array, spell_b: pa.Array) -> dict[str, pa.Array]:
    """The counts, group digests and link pairs of documents whose ids spell the same bytes."""
    n = len(a)
    none = pa.array(np.zeros(n, np.int64))
    key_a, ids_a = _ends(a, spell_a)
    key_b, ids_b = _ends(b, spell_b)
    ends_a, ends_b = key_a.to_numpy(), key_b.to_numpy()
    both = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # two sorted runs: merged
    both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
    # An end that only one side has lies in the other side's next token; a document ends on both sides.
    in_a, in_b = np.searchsorted(ends_a, both), np.searchsorted(ends_b, both)
    shared = (ends_a[in_a] == both) & (ends_b[in_b] == both)
    pair = pa.array(ids_a.to_numpy()[in_a].astype(np.int64) << 32 | ids_b.to_numpy()[in_b])

    def per_doc(keys: np.ndarray) -> np.ndarray:
        return np.bincount(keys >> 32, minlength=n)

    links, groups = per_doc(both), per_doc(both[shared])
    texts = pc.binary_join_element_wise(_grouped(ids_a, pa.array(in_a[shared])), _grouped(ids_b, pa.array(in_b[shared])), "|")
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(groups)]), pa.int32()), texts)
    digests = [hashlib.sha256(t).hexdigest() if t else "" for t in pc.binary_join(lists, ";").cast(pa.binary()).to_pylist()]
    return {
        "n_a": pc.add(none, pc.list_value_length(a)),
        "n_b": pc.add(none, pc.list_value_length(b)),
        "n_groups": pa.array(groups, pa.int64()),
        "n_links": pa.array(links, pa.int64()),
        "groups_sha256": pa.array(digests, pa.string()),
        "pairs": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(links)]), pa.int32()), pair),
    }


def _spells(ids: pa.ListArray, spelling: pa.Array, data: list[bytes]) -> list[bool]:
    """Whether every list's tokens join to its text; at once, and one by one only if some do not."""
    spelled = spelling.take(pc.list_flatten(ids))
    whole = spelled.buffers()[2]
    if len(spelled) and whole is not None and whole.to_pybytes() == b"".join(data):
        # The joined bytes are equal; so are the texts where each list has its text's length.
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(spelled).to_numpy(), dtype=np.int64)])[ids.offsets.to_numpy()]
        if (np.diff(ends) == [len(d) for d in data]).all():
            return [True] * len(data)
    return [x == d for x, d in zip(pc.binary_join(pa.ListArray.from_arrays(ids.offsets, spelled), b"").to_pylist(), data)]


def _lists(rows: list[np.ndarray] | list[list[int]]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
    values = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def align_texts(texts: list[str | None], a_path: str, b_path: str) -> dict[str, pa.Array]:
    """:func:`aligned` for texts; one that is empty or not spelled out by A and B has no tokens."""
    a, b = tokenizers(a_path, b_path)
    ids_a = _lists([a(t) if t else [] for t in texts])
    ids_b = _lists(b([t or "" for t in texts]))
    data = [b" " + t.encode() if t else b"" for t in texts]
    fine = [x and y for x, y in zip(_spells(ids_a, a.spelling, data), _spells(ids_b, b.spelling, data))]
    if not all(fine):
        keep = lambda ids: pa.array([row if ok else [] for row, ok in zip(ids.to_pylist(), fine)], ids.type)
        ids_a, ids_b = keep(ids_a), keep(ids_b)
    return aligned(ids_a, ids_b, a.spelling, b.spelling)


# -- the corpus -------------------------------------------------------------------------------


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int, int]]:
    """(start, stop, bytes at least) of runs of texts of some ``SLICE`` characters, one text at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE or i == len(texts) - 1:
            yield start, i + 1, size
            start, size = i + 1, 0


def links(docs: DataFrame, a: str | None = None, b: str | None = None, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its counts, its groups' digest and the pair of every link, in bundles; written out."""
    a, b = a or public_tokenizers.path("byte_bpe_50k.json"), b or public_tokenizers.path("piece_bpe_32k.model")
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, size, row = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop, more in _slices(texts):
                if size >= BUNDLE:
                    bundle, size, row = bundle + 1, 0, 0
                found = align_texts(texts[start:stop], a, b)
                n = stop - start
                own = {"bundle": pa.array([bundle] * n, pa.int64()), "row": pa.array(range(row, row + n), pa.int32()), "doc_id": batch.column("doc_id").slice(start, n)}
                cols = own | found
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
                size, row = size + more, row + n

    rows = docs.select(docs[doc_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return stored(rows.mapInArrow(run, ALIGNED), "alignment-links")


def pair_counts(linked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((bundle, pair, n) of every bundle, (pair, n, best) of the corpus); ``best``: no other pair of the B id has more."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def counted(tables: list[pa.Table]) -> pa.Table:
            return pa.concat_tables(tables).group_by(["bundle", "pair"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["bundle", "pair", "n"])

        for batch in batches:
            flat, parent = pc.list_flatten(batch.column("pairs")), pc.list_parent_indices(batch.column("pairs"))
            held.append(counted([pa.table({"bundle": batch.column("bundle").take(parent), "pair": flat, "n": pa.array(np.ones(len(flat), np.int64))})]))
            if len(held) > 64:  # bounded: what is counted so far goes on
                yield from counted(held).to_batches()
                held = []
        if held:
            yield from counted(held).to_batches()

    parts = linked.select("bundle", "pairs").mapInArrow(partial, PARTIAL).groupBy("bundle", "pair").agg(F.sum("n").alias("n"))
    parts = stored(parts, "alignment-parts")
    totals = stored(parts.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-pairs")
    b_id = F.col("pair").bitwiseAND((1 << 32) - 1)
    highest = totals.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    return parts, totals.join(highest, b_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    linked = links(docs, a, b)
    parts, totals = pair_counts(linked)
    known = parts.select("bundle", "pair").join(totals, "pair")

    def finish(own: pa.Table, counts: pa.Table) -> pa.Table:
        own, n = own.combine_chunks(), own.num_rows
        pairs = pa.concat_arrays(own["pairs"].chunks) if own["pairs"].num_chunks else pa.array([], pa.list_(pa.int64()))
        flat = pa.table({"doc": pc.list_parent_indices(pairs), "pair": pc.list_flatten(pairs)})
        if counts.num_rows and flat.num_rows:
            told = flat.join(counts.select(["pair", "n", "best"]), "pair", join_type="inner", use_threads=False)
            sums = told.group_by("doc", use_threads=False).aggregate([("n", "sum"), ("best", "sum")])
            at = sums["doc"].to_numpy()
            count_sum, n_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
            count_sum[at], n_best[at] = sums["n_sum"].to_numpy(), sums["best_sum"].to_numpy().astype(np.int64)
        else:
            count_sum = n_best = np.zeros(n, np.int64)
        cols = {c: own[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(cols | {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "groups_sha256": own["groups_sha256"]})

    return linked.groupBy("bundle").cogroup(known.groupBy("bundle")).applyInArrow(finish, RESULT)
