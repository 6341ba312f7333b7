"""Operator 6: best-two-fit packing of documents into sequences of fixed length.

A document is its ids and an end id; only a document longer than a sequence is
cut, into full pieces and a rest. What packs together depends on the lengths
alone, and there are at most ``size`` of them, so the method runs on the
histogram of lengths: fill a bin greedily with the longest that fits, again and
again; then take its smallest document out and put in the two unpacked
documents that fit the widened gap most tightly, if they fit it better. The
same bin is repeated as often as the counts allow. That takes some thousand
steps whatever the number of documents.

The plan (so many bins of these lengths) says which ranks of a length go to
which bin and place. Documents are numbered within their length: each task
counts its own, a window over (length, task) adds what earlier tasks have. No
task holds all documents of a length, and no document's id matters, so rows
with the same id are fine.

Defined results: a null or empty text is the end id alone; rows with the same
id are packed each; an empty table gives no row. Only the two named columns
are read.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewforge.plans.joins import join_per_key

from .bpe import Memo, byte_chars, library
from .bpe_codec import Codec
from .common import python_ready, sole, stored
from .token_files import MARKS

PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, rank long"
SLOT = "length int, first long, stop long, per int, bin long, place int"


class Encoder(Codec):
    """Whole texts to ids; each distinct word is encoded once by the tokenizers library's model."""

    def __init__(self, path: str):
        super().__init__(path)
        self.model, self.chars = library(path).model, dict(enumerate(byte_chars()))
        self.marks = {m: np.array(self.of_word(m), "<u4").tobytes() for m in MARKS}
        self.packed = Memo(self.packed_piece, 1_000_000)

    def of_bytes(self, data: bytes) -> tuple[int, ...]:
        return tuple(t.id for t in self.model.tokenize(data.decode("latin-1").translate(self.chars)))

    def packed_piece(self, piece: str) -> bytes:
        if piece.isascii():  # no normal form to find, and letters are one word
            if piece.isalpha():
                ids = [t.id for t in self.model.tokenize(piece.lower())]
                return struct.pack(f"<{len(ids)}I", *ids)
            if piece and piece[-1] in MARKS and piece[:-1].isalpha():
                return self.packed[piece[:-1]] + self.marks[piece[-1]]
        ids = self.of_piece(piece)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.special.search(text):
            return np.array(self.encode(text), "<u4").tobytes()
        return b"".join(map(self.packed.__getitem__, text.split(" ")))


def encoder(path: str) -> Encoder:
    """One per Python worker process, so that its memos serve all tasks."""
    return sole(Encoder, path)


def pieces(docs: DataFrame, size: int, end_id: int, tokenizer: str, doc_col: str, text_col: str) -> DataFrame:
    """The pieces of every document, with the task that made them and their rank within (task, length).

    Written out, so that task and rank hold for what follows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, encode = TaskContext.get().partitionId(), Counter(), encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = encode(text) + np.array([end_id], "<u4").tobytes()
                for k in range(0, len(data) // 4, size):
                    part = data[4 * k : 4 * (k + size)]
                    length = len(part) // 4
                    rows.append((doc, k // size, k, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    python_ready(docs.sparkSession)
    return stored(docs.select(docs[doc_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, PIECE), "pieces")


def best_two_fit(counts: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """(how many bins, the lengths in each), using up ``counts`` of each length."""
    left = {k: v for k, v in counts.items() if v > 0}
    lengths = sorted(left)
    plan = []
    while lengths:
        used: Counter = Counter()
        gap = size

        def longest(limit: int) -> int:
            """The longest length up to ``limit`` that is not used up, or 0."""
            at = bisect.bisect_right(lengths, limit) - 1
            while at >= 0 and left[lengths[at]] <= used[lengths[at]]:
                at -= 1
            return lengths[at] if at >= 0 else 0

        while gap and (item := longest(gap)):
            times = min(gap // item, left[item] - used[item])
            used[item] += times
            gap -= times * item
        if gap:
            small = min(used)
            used[small] -= 1
            pair = _tightest_pair(lengths, left, used, small, gap + small)
            if pair:
                used.update(pair)
            else:
                used[small] += 1
        used = +used
        bins = min(left[k] // n for k, n in used.items())
        plan.append((bins, sorted(used.elements(), reverse=True)))
        for k, n in used.items():
            left[k] -= bins * n
            if not left[k]:
                del left[k]
                lengths.pop(bisect.bisect_left(lengths, k))
    return plan


def _tightest_pair(lengths: list[int], left: dict[int, int], used: Counter, least: int, gap: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum in (least, gap]."""
    best, found = least, None
    i, j = 0, bisect.bisect_right(lengths, gap) - 1
    while i <= j:
        a, b = lengths[i], lengths[j]
        if a + b > gap or left[b] <= used[b]:
            j -= 1
        elif left[a] <= used[a] or (i == j and left[a] - used[a] < 2):
            i += 1
        else:
            if a + b > best:
                best, found = a + b, (a, b)
                if best == gap:
                    break
            i += 1
    return found


def slots(plan: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, stop rank, how many per bin, first bin, place of the first): which ranks go where."""
    out, taken, first_bin = [], Counter(), 0
    for bins, items in plan:
        place = 0
        for length, per in Counter(items).items():  # longest first
            out.append((length, taken[length], taken[length] + bins * per, per, first_bin, place))
            taken[length] += bins * per
            place += length * per
        first_bin += bins
    return out


def pack(docs: DataFrame, size: int = 2048, end_id: int = 0, tokenizer: str | None = None, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row per piece."""
    spark = docs.sparkSession
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    rows = pieces(docs, size, end_id, tokenizer, doc_col, text_col)
    by_task = stored(rows.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    earlier = Window.partitionBy("length").orderBy("task")
    before = by_task.select("length", "task", (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    # A plan has a few slots per length at most, so its table is bounded by ``size`` and may be broadcast.
    where = spark.createDataFrame(slots(best_two_fit(counts, size)), SLOT)
    ranked = join_per_key(rows, before, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("before"))
    at = ranked.join(F.broadcast(where.withColumnRenamed("length", "l")), F.expr("length = l and rank >= first and rank < stop"))
    nth = F.col("rank") - F.col("first")
    return at.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        (F.col("bin") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("place") + (nth % F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )
