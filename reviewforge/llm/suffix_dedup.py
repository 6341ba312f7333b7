"""Operator 5: removal of repeated byte strings by suffix arrays.

Every byte covered by a string of 400 bytes that also starts anywhere else goes
(``Window`` sets other lengths; the figures below are those of 400).

Anchors. In each 400-byte window the 128-byte gram with the smallest hash (the
leftmost of equals) is the window's anchor. Equal windows choose the same gram
at the same offset, so only windows whose anchors have equal grams can be
equal. An anchor stands for a run of windows; its context is the bytes of that
run. Grams that occur once drop out at once, with one aggregation of hashes.

Contexts. Anchors with equal contexts prove all their windows repeated, again
by an aggregation. What is left are contexts that occur once beside others
with the same gram: the edges of repeated passages. Only their bytes are
fetched, one join with the documents.

Suffix arrays. Contexts of one gram are aligned at it. Bytes right of the
anchor, and bytes left of it reversed, are cut into blocks; equal blocks are one
symbol, numbered in byte order. All contexts of a bundle of groups make one
text, and the suffix array (Lyndon-group construction, ``suffix_groups``) sorts
them. Neighbours' common prefixes then say, for every distance ``a`` of a
window's start from the anchor, which contexts share both the ``a`` bytes to
the left and the ``400 - a`` bytes to the right.

Skew. All counting is by aggregations that combine before the shuffle. A group
of more contexts than fit a task is cut by distance: windows with ``a`` in one
of 18 intervals share a core of 385 bytes, whose hash makes a finer key; groups
that are still too large are cut into single windows, and those need only be
counted. Nothing is capped, and no group of unbounded size meets in one task.

Defined results: a null or empty text has no byte; matches never cross
documents; equal texts (repeated rows too) repeat each other from 400 bytes on;
any bytes, texts of any length. Rows are judged by their text, whatever their
id. Equality of grams, contexts and texts is by 64-bit hashes (texts: with
their length); the suffix arrays compare bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, python_ready, stored
from .suffix_groups import suffix_array



class Window(NamedTuple):
    """Bytes of the strings that must repeat, and of the gram that anchors one."""

    span: int = 400
    gram: int = 128


#: Contexts that one task compares at once, and symbols of its suffix array in bytes.
GROUP, BUNDLE, SYMBOL = 8192, 4096, 68
#: Distances per interval when a group is too large; then single windows.
WIDTHS = (16, 1)

_CODE = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


_TABLES: dict[str, np.ndarray] = {}


def _table(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; the table grows up to 1M entries and is computed anew for longer texts."""
    key = str(base)
    if key not in _TABLES or len(_TABLES[key]) < n:
        made = _powers(base, max(n, 1 << 16))
        if n > 1 << 20:
            return made
        _TABLES[key] = made
    return _TABLES[key][:n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the gram that starts at each byte: differences of one running sum."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * _table(_BASE, n), out=total[1:])
    h = (total[gram:] - total[:-gram]) * _table(_INVERSE, n - gram + 1)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def anchors(data: np.ndarray, size: Window) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, anchor, first start, last start) of each run of windows with one anchor."""
    hashes = gram_hashes(data, size.gram)
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width, want = 1, size.span - size.gram + 1
    while width < want:  # least over ever wider runs of grams, up to those of one window
        step = min(width, want - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    return hashes[at[first]].view(np.int64), at[first], first, last


def text_id(data: bytes) -> int:
    return _signed(xxhash.xxh3_64_intdigest(data))


ANCHOR = "tid long, n long, gram long, ctx long, start int, low short, high short"


def find_anchors(docs: DataFrame, text_col: str, size: Window) -> DataFrame:
    """A row per anchor: text, gram, context hash, first start, distances of the last and the first window's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            cols: list[list[np.ndarray]] = [[] for _ in range(7)]
            for text in batch.column(0).to_pylist():
                data = (text or "").encode()
                if len(data) < size.span:
                    continue
                gram, at, first, last = anchors(np.frombuffer(data, np.uint8), size)
                low, high = at - last, at - first
                ctx = np.array([_signed(xxhash.xxh3_64_intdigest(data[s : e + size.span], lo << 10 | hi)) for s, e, lo, hi in zip(first.tolist(), last.tolist(), low.tolist(), high.tolist())], np.int64)
                for col, x in zip(cols, (np.full(len(at), text_id(data)), np.full(len(at), len(data)), gram, ctx, first.astype(np.int32), low.astype(np.int16), high.astype(np.int16))):
                    col.append(x)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=["tid", "n", "gram", "ctx", "start", "low", "high"])

    python_ready(docs.sparkSession)
    return docs.select(docs[text_col].alias("text")).mapInArrow(run, ANCHOR)


# -- groups of aligned contexts ----------------------------------------------------------------


def _ranks(rows: list[bytes]) -> list[list[int]]:
    """Each row as block symbols from 1 on, numbered in byte order; equal blocks are equal symbols."""
    width = max(map(len, rows), default=0)
    blocks = max(1, -(-width // SYMBOL))
    padded = np.zeros((len(rows), blocks * SYMBOL), np.uint8)
    length = np.array([len(r) for r in rows])
    padded[np.arange(padded.shape[1]) < length[:, None]] = np.frombuffer(b"".join(rows), np.uint8)
    parts = padded.reshape(len(rows) * blocks, SYMBOL)
    held = np.clip(length[:, None] - np.arange(blocks) * SYMBOL, 0, SYMBOL).reshape(-1, 1).astype(np.uint8)
    marked = np.ascontiguousarray(np.concatenate([parts, held], axis=1))
    _, rank = np.unique(marked.view(f"V{SYMBOL + 1}").ravel(), return_inverse=True)
    rank = rank.reshape(len(rows), blocks) + 1
    used = -(-length // SYMBOL)
    return [r[:u].tolist() for r, u in zip(rank, used)]


def _sorted_rows(group: list[int], rows: list[bytes]) -> list[int]:
    """Row numbers by group, then by bytes: one suffix array over all rows.

    A row's text is its group's symbol, its blocks and a separator, which is
    smaller than all blocks; group symbols are larger than all blocks.
    """
    symbols = _ranks(rows)
    above = max((max(s, default=0) for s in symbols), default=0) + 1
    text, start = [], {}
    for k, (g, s) in enumerate(zip(group, symbols)):
        start[len(text)] = k
        text += [above + g + 1, *(t + 1 for t in s), 1]
    return [start[i] for i in suffix_array([*text, 0]) if i in start]


def _common(rows: list[bytes], order: list[int]) -> np.ndarray:
    """Bytes that each row of ``order`` has in common with the one before it (0 for the first)."""
    width = max(map(len, rows), default=0)
    length = np.array([len(rows[k]) for k in order])
    padded = np.zeros((len(order), width + 1), np.uint8)
    padded[np.arange(width + 1) < length[:, None]] = np.frombuffer(b"".join(rows[k] for k in order), np.uint8)
    out = np.zeros(len(order), np.int64)
    if len(order) > 1:
        unlike = padded[1:] != padded[:-1]
        first = np.where(unlike.any(axis=1), unlike.argmax(axis=1), width)
        out[1:] = np.minimum(first, np.minimum(length[1:], length[:-1]))
    return out


def shared_windows(groups: list[int], contexts: list[tuple[int, int, bytes]], span: int) -> list[list[tuple[int, int]]]:
    """For each context the ranges of distances whose windows another context of its group has, too.

    A context is (low, high, bytes): its windows start ``low`` to ``high`` bytes
    before the anchor, and its bytes run from ``high`` before the anchor to
    ``span - low`` after it. ``groups`` numbers the group of each.
    """
    rights = [c[high:] for _, high, c in contexts]
    lefts = [c[:high][::-1] for _, high, c in contexts]
    found: list[list[tuple[int, int]]] = [[] for _ in contexts]
    by_right, by_left = _sorted_rows(groups, rights), _sorted_rows(groups, lefts)
    right_common, left_common = _common(rights, by_right), _common(lefts, by_left)
    # Both orders have the groups one after another, in the same order.
    k = 0
    while k < len(by_right):
        stop = k + 1
        while stop < len(by_right) and groups[by_right[stop]] == groups[by_right[k]]:
            stop += 1
        _sweep(by_right[k:stop], right_common[k:stop], by_left[k:stop], left_common[k:stop], contexts, found, span)
        k = stop
    return found


def _sweep(by_right, right, by_left, left, contexts, found, span) -> None:
    n = len(by_right)
    if n < 2:
        return
    if n == 2:
        i, j = by_right
        first = max(span - int(right[1]), contexts[i][0], contexts[j][0])
        last = min(int(left[1]), contexts[i][1], contexts[j][1])
        if first <= last:
            found[i].append((first, last))
            found[j].append((first, last))
        return
    members = np.array(sorted(by_right))
    low = np.array([contexts[m][0] for m in members])
    high = np.array([contexts[m][1] for m in members])
    at_right, at_left = np.searchsorted(members, by_right), np.searchsorted(members, by_left)
    # The classes by right bytes grow and those by left bytes split as the distance grows; between these points nothing changes.
    turns = np.unique(np.concatenate([[0], span - right[1:], left[1:] + 1, low, high + 1]))
    turns = turns[(turns >= 0) & (turns <= int(high.max()) + 1)]
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for a, b in zip(turns, [*(turns[1:] - 1), turns[-1]]):
        right_class[at_right] = np.cumsum(np.concatenate([[0], right[1:] < span - a]))
        left_class[at_left] = np.cumsum(np.concatenate([[0], left[1:] < a]))
        valid = (low <= a) & (a <= high)
        code = np.where(valid, right_class * n + left_class, -1 - np.arange(n))
        _, which, count = np.unique(code, return_inverse=True, return_counts=True)
        for m in members[(count[which] > 1) & valid]:
            if found[m] and found[m][-1][1] == a - 1:
                found[m][-1] = (found[m][-1][0], int(b))
            else:
                found[m].append((int(a), int(b)))


ROW = "key long, ctx long, tid long, n long, start int, low short, high short, c long, bytes binary"
SPANS = "tid long, n long, start long, stop long"


def _compare(rows: DataFrame, span: int) -> DataFrame:
    """Spans of the windows that contexts occurring once share with others of their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()

        def spans(held):
            key = {}
            groups = [key.setdefault(r[0], len(key)) for r in held]
            out = []
            for r, ranges in zip(held, shared_windows(groups, [(r[5], r[6], r[8]) for r in held], span)):
                if r[7] == 1:
                    anchor = r[4] + r[6]
                    out += [(r[2], r[3], anchor - b, anchor - a + span) for a, b in ranges]
            return pa.RecordBatch.from_arrays([pa.array([s[k] for s in out], pa.int64()) for k in range(4)], names=["tid", "n", "start", "stop"])

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= BUNDLE and row[0] != held[-1][0]:
                    yield spans(held)
                    held = []
                held.append(row)
        if held:
            yield spans(held)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, SPANS)


def _cut(rows: DataFrame, width: int, span: int) -> tuple[DataFrame, DataFrame]:
    """(classes, places) by finer keys: the windows of each interval of ``width`` distances, under the hash of the bytes they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.int64(), pa.binary()]
        names = [f.split()[0] for f in ROW.split(", ")]
        for batch in batches:
            out = []
            for key, _, tid, n, start, low, high, c, data in zip(*(x.to_pylist() for x in batch.columns)):
                for piece in range(low // width, high // width + 1):
                    a, b = max(low, piece * width), min(high, piece * width + width - 1)
                    core = data[high - piece * width : high + span - (piece * width + width - 1)] if width > 1 else data[high - a : high - a + span]
                    part = data[high - b : high - a + span]
                    finer = _signed(xxhash.xxh3_64_intdigest(core, (key ^ piece * _BASE) & (2**64 - 1)))
                    out.append((finer, _signed(xxhash.xxh3_64_intdigest(part, a << 10 | b)), tid, n, start + high - b, a, b, c, part))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(9)], names=names)

    pieces = rows.mapInArrow(run, ROW)
    # A class that occurred more than once has been covered; it still counts as a partner.
    first = [F.first(c).alias(c) for c in ("tid", "n", "start", "low", "high", "bytes")]
    return stored(pieces.groupBy("key", "ctx").agg(F.sum("c").alias("c"), *first), "windows"), stored(pieces.drop("bytes"), "places")


def repeated_spans(docs: DataFrame, text_col: str, size: Window) -> tuple[DataFrame, DataFrame]:
    """(spans, texts): covered spans (tid, n, start, stop), with overlaps, and (tid, n, text) of texts that may have some."""
    found = stored(find_anchors(docs, text_col, size), "anchors")
    # Written, so that the join reads two plain shuffles and AQE can split a gram with very many anchors.
    grams = stored(found.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("gram"), "grams")
    shared = stored(found.join(grams, "gram"), "shared")
    classes = stored(shared.groupBy("gram", "ctx").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("tid", "start")).alias("rep")), "contexts")
    groups = stored(classes.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("least")).where("k > 1 and least = 1").select("gram", "k"), "groups")
    told = shared.join(classes, ["gram", "ctx"])
    spans = told.where("c > 1").select("tid", "n", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("high") - F.col("low") + size.span).cast("long").alias("stop")).distinct()
    open_ = told.where("rep.tid = tid and rep.start = start").join(groups, "gram")
    needs = open_.groupBy("tid", "n").agg(F.collect_set(F.struct(F.col("gram").alias("key"), "ctx", "start", "low", "high", "c", "k")).alias("needs"))
    touched = shared.select("tid", "n").distinct().join(needs, ["tid", "n"], "left")
    return spans, touched


def _bytes_of(texts: DataFrame, span: int) -> DataFrame:
    """The context rows that a text stands for, with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.int64(), pa.binary(), pa.int64()]
        names = [f.split()[0] for f in ROW.split(", ")] + ["k"]
        for batch in batches:
            out = []
            for tid, n, text, needs in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                out += [(d["key"], d["ctx"], tid, n, d["start"], d["low"], d["high"], d["c"], data[d["start"] : d["start"] + d["high"] - d["low"] + span], d["k"]) for d in needs]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(10)], names=names)

    return texts.mapInArrow(run, f"{ROW}, k long")


def remove_repeats(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), with_text: bool = False, size: Window = Window()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row, and the columns ``keep`` of ``docs``.

    ``size`` says how long the repeated strings are. ``with_text`` adds ``kept_text``, the bytes that stay (characters that a
    cut went through are dropped).
    """
    spark = docs.sparkSession
    python_ready(spark)
    spans, touched = repeated_spans(docs, text_col, size)
    rows = docs.select(docs[doc_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), *[docs[c].alias(f"own_{c}") for c in keep])
    own = ", ".join(f"own_{c} {docs.schema[c].dataType.simpleString()}" for c in keep)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            data = [(t or "").encode() for t in batch.column("text").to_pylist()]
            yield batch.append_column("tid", pa.array([text_id(d) for d in data], pa.int64())).append_column("n", pa.array([len(d) for d in data], pa.int64()))

    known = rows.mapInArrow(named, f"doc_id long, text string{', ' + own if own else ''}, tid long, n long")
    # The one shuffle of texts: texts without a repeated gram are finished here.
    placed = stored(known.join(touched.withColumn("touched", F.lit(True)), ["tid", "n"], "left"), "texts")

    contexts = _bytes_of(placed.where("needs is not null").select("tid", "n", "text", "needs"), size.span)
    level = stored(contexts.groupBy("key", "ctx", "tid", "n", "start", "low", "high", "c", "k").agg(F.first("bytes").alias("bytes")), "bytes")
    columns = [f.split()[0] for f in ROW.split(", ")]
    every = [spans, _compare(level.where(F.col("k") <= GROUP).select(columns), size.span)]
    large = level.where(F.col("k") > GROUP)
    for width in WIDTHS:
        if large.isEmpty():
            break
        classes, places = _cut(large.select(columns), width, size.span)
        sizes = classes.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("least"))
        told = places.drop("c").join(classes.select("key", "ctx", "c"), ["key", "ctx"])
        every.append(told.where("c > 1").select("tid", "n", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("high") - F.col("low") + size.span).cast("long").alias("stop")))
        level = classes.join(sizes, "key").where("k > 1 and least = 1")
        every.append(_compare(level.where(F.col("k") <= GROUP).select(columns), size.span))
        large = level.where(F.col("k") > GROUP)  # a single window's key has one context, so none is left after the last width

    whole = every[0]
    for more in every[1:]:
        whole = whole.unionByName(more)
    merged = whole.groupBy("tid", "n").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    tail = [pa.field("n_bytes", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("n_spans", pa.int64()), pa.field("kept_sha256", pa.string())] + ([pa.field("kept_text", pa.string())] if with_text else [])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data = (text or "").encode()
                kept, at, n_spans = [], 0, 0
                last = -1
                for s in sorted((r["start"], r["stop"]) for r in ranges or ()):
                    if s[0] > last:
                        n_spans += 1
                        kept.append(data[at : s[0]])
                    at = last = max(last, s[1])
                kept.append(data[at:])
                rest = b"".join(kept)
                out.append((len(data), len(data) - len(rest), n_spans, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")))
            own_columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name == "doc_id" or name.startswith("own_")]
            yield pa.RecordBatch.from_arrays(own_columns + [pa.array([r[k] for r in out], f.type) for k, f in enumerate(tail)], names=["doc_id", *[f"own_{c}" for c in keep], *[f.name for f in tail]])

    fields = f"doc_id long, " + (own + ", " if own else "") + "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string" if with_text else "")
    order = ["doc_id", *[f"own_{c}" for c in keep], "text"]
    hit = placed.where("touched").join(merged, ["tid", "n"], "left").select(*order, "spans")
    clean = placed.where("touched is null").select(*order, F.lit(None).cast(merged.schema["spans"].dataType).alias("spans"))
    done = hit.unionByName(clean).mapInArrow(finish, fields)
    return done.select("doc_id", *[F.col(f"own_{c}").alias(c) for c in keep], "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] if with_text else []))
