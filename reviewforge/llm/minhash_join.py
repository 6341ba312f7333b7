"""Operator 2: near-duplicates by b-bit MinHash signatures and a multi-index Hamming join.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Its
signature has 384 MinHash values of 16 bits; two documents of similarity J
differ in about 384 * (1 - J) of them.

The index covers the first 50 values in 10 chunks of 5. Signatures that differ
there in at most 19 values differ in at most one value of some chunk (19 // 10
= 1), so with a key for every chunk and every value left out of it (50 keys of
4 values) each such pair shares a key: no pair under the threshold is lost. Two
documents of similarity 0.85 differ in 20 or more of 50 values with a chance of
about 1 in 30,000, and must then also miss each other in all chunks.

Pairs of a bucket are never all emitted. Documents with equal sets are one node
from the start. Then links are sought where they can still matter, that is
between members of different components:

1. every document is compared with one other, the member with the smallest hash
   in all its buckets;
2. again with one of another component, where a bucket still holds one;
3. in the buckets that still hold several components, every pair of different
   components goes on, from the first bucket that it shares, unless the sizes of
   the two sets alone rule the similarity out.

Every pair that goes on is confirmed on the full sets. Only the first two steps
leave out pairs by their signatures (more than ``limit`` of 384 values differ);
the third meets those again, so what the index brings together is decided by
the full sets alone. The pairs of a pair of blocks stay together in one row, and
each set that they need goes there once, so no join gives a row per pair.
Buckets larger than a block are split over many tasks, so a bucket with a third
of all documents is no hot group.

Defined results: a null or blank text has the empty set and links with nothing,
nor does a row with a null id; its component is its own id. Rows are judged by
their own text, rows with the same id included; repeated rows share a
component. Words are runs of bytes other than ASCII white space, so texts of
any length and script work. An empty table gives no row. Only the two named
columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Memo
from .common import components, extended, forget, nearest, python_ready, sole, stored

SHINGLE = 5
VALUES, INDEXED, CHUNK = 384, 50, 5
#: Most differing values of the indexed ones (guaranteed by the keys).
INDEX_LIMIT = 2 * (INDEXED // CHUNK) - 1
BLOCK = 2048
#: Shingles whose sets one task holds at once, twice, when pairs are confirmed; a larger set is taken by itself.
HELD = 2_000_000
#: Pairs that a row of them is cut at; each row brings its sets along once.
PAIRS = 1_000_000

_ROUND = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93)]
_FACTORS = np.random.default_rng(20).integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _words() -> Memo:
    return sole(Memo, xxhash.xxh3_64_intdigest, 500_000)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text (words: A-Z lower-cased)."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(_words().__getitem__, words), np.uint64, len(words))
    out = np.full(max(1, len(words) - SHINGLE + 1), min(len(words), SHINGLE), np.uint64)
    for k in range(min(SHINGLE, len(words))):
        out += hashed[k : k + len(out)] * _ROUND[k]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """384 values of 16 bits."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingle_set), 2048):
        np.minimum(least, (shingle_set[k : k + 2048, None] * _FACTORS).min(axis=0), out=least)
    return ((least * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype("<u2")


def _kept_columns() -> np.ndarray:
    """The columns of each key: a chunk without one of its values."""
    return np.array([[c for c in range(s, s + CHUNK) if c != left] for s in range(0, INDEXED, CHUNK) for left in range(s, s + CHUNK)])


KEYS = _kept_columns()


def keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key per signature (rows) and left-out value (columns)."""
    parts = signatures.astype(np.uint64)[:, KEYS]
    whole = parts[:, :, 0] << np.uint64(48) | parts[:, :, 1] << np.uint64(32) | parts[:, :, 2] << np.uint64(16) | parts[:, :, 3]
    whole = (whole + np.arange(1, len(KEYS) + 1, dtype=np.uint64) * _ROUND[0]) * _ROUND[3]
    return (whole ^ (whole >> np.uint64(31))).view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), VALUES)


def limit(percent: int) -> int:
    """Most differing values of all 384 for a pair that the first two comparisons confirm: 3.72 deviations above the mean."""
    unlike = VALUES * (100 - percent) / 100
    return math.ceil(unlike + 3.72 * math.sqrt(unlike * percent / 100))


def describe(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, node, twin, sig, text_hash): node and twin are two 64-bit hashes of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            signed = lambda s, seed: np.uint64(xxhash.xxh3_64_intdigest(s.tobytes(), seed)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signed(s, 1) for s in sets], pa.int64()),
                    pa.array([signed(s, 2) for s in sets], pa.int64()),
                    pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    batch.column(2),
                ],
                names=["doc_id", "n_shingles", "node", "twin", "sig", "text_hash"],
            )

    python_ready(docs.sparkSession)
    rows = docs.select(docs[doc_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, node long, twin long, sig binary, text_hash long")


def _members(nodes: DataFrame) -> DataFrame:
    """(key, node) of the buckets with several nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            if batch.num_rows:
                found = keys(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(found.reshape(-1)), pa.array(np.repeat(batch.column(0).to_numpy(), len(KEYS)))], names=["key", "node"])

    every = nodes.select("node", "sig").mapInArrow(run, "key long, node long")
    # Written, so that the join reads two plain shuffles and AQE can split a bucket with very many nodes.
    shared = stored(every.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared")
    return stored(every.join(shared, "key"), "buckets")


def _close(pairs: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """The pairs whose whole signatures differ in at most ``most`` values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            if batch.num_rows:
                near = (_matrix(batch.column(2)) != _matrix(batch.column(3))).sum(axis=1) <= most
                yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(near)) for k in (0, 1)], names=["a", "b"])

    one, two = nodes.select(F.col("node").alias("a"), F.col("sig").alias("x")), nodes.select(F.col("node").alias("b"), F.col("sig").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union for two sets given sorted."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    union = len(np.unique(np.concatenate([x, y])))
    return 100 * (len(x) + len(y) - union) >= percent * union


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union on the full sets, written out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            links = [(a, b) for a, b, x, y in zip(*(batch.column(k).to_pylist() for k in range(4))) if similar(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent)]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    one, two = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return stored(pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the ``wanted`` nodes, each from the document that stands for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(n, s.tobytes()) for n, t, s in ((n, t, shingles(x)) for n, t, x in zip(*(batch.column(k).to_pylist() for k in range(3)))) if np.uint64(xxhash.xxh3_64_intdigest(s.tobytes(), 2)).view(np.int64) == t]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())], names=["node", "shingles"])

    return stored(docs.join(wanted, "doc_id").select("node", "twin", "text").mapInArrow(run, "node long, shingles binary"), "sets")


def _labelled(members: DataFrame, parts: DataFrame) -> DataFrame:
    """``members`` with the name of their part: nodes of a part are known to be connected."""
    told = parts.select("node", F.col("up").alias("part"))
    return stored(members.join(told, "node", "left").withColumn("part", F.coalesce("part", "node")), "labelled")


def _open(labelled: DataFrame, *more) -> DataFrame:
    """The buckets that hold several components."""
    return stored(labelled.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), *more).where("low <> high").drop("low", "high"), "open")


def _star_pairs(labelled: DataFrame, *order: str) -> DataFrame:
    """Each node with one member of its buckets that is of another component: of the first in each, the first."""
    centre = F.min(F.struct(F.xxhash64(*order), "node", "part")).alias("centre")
    return (
        labelled.join(_open(labelled, centre), "key")
        .where("part <> centre.part")
        .groupBy("node")
        .agg(F.min("centre").alias("centre"))
        .select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"))
        .distinct()
    )


def _block_pairs(labelled: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(id, a, b): the pairs of different components that share an open bucket and have sets of like enough sizes, as lists.

    A bucket of n members has ceil(n / BLOCK) blocks; each pair of blocks is
    compared by itself and gives a row, or several if its sets are large or its
    pairs many (a row ends with the node that reaches ``PAIRS``).
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    indexed = nodes.select("node", F.substring("sig", 1, 2 * INDEXED).alias("sig"), "n_shingles")
    rows = labelled.join(_open(labelled), "key").join(indexed, "node").withColumn("block", F.pmod(F.xxhash64("node", "key"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    sent = rows.select("key", "node", "part", "sig", "block", "n_shingles", other).select(
        "key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "node", "part", "sig", "block", "n_shingles"
    )

    def compare(group: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        key, p, q = group[0][:3]
        node = np.array([g[3] for g in group])
        part = np.array([g[4] for g in group])
        if (part == part[0]).all():
            return
        in_keys = keys(np.frombuffer(b"".join(g[5] for g in group), "<u2").reshape(len(group), INDEXED))
        block = np.array([g[6] for g in group])
        size = np.array([g[7] for g in group])
        names, sizes = np.unique(part, return_counts=True)
        inner = part == names[sizes.argmax()]
        tile = np.cumsum(size) // HELD
        place = np.arange(len(group))
        tiles = [np.flatnonzero(tile == t) for t in np.unique(tile)]
        # A pair of different components has a member outside the largest one; if both are, the later one is met.
        for ones in tiles:
            ones = ones[~inner[ones]]
            for others in tiles:
                a, b, listed = [], [], 0
                for i in ones:
                    meets = (part[others] != part[i]) & (inner[others] | (place[others] > i)) & ((block[others] != block[i]) | (p == q))
                    near = others[meets & (100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i]))]
                    near = near[in_keys[i][(in_keys[near] == in_keys[i]).argmax(axis=1)] == key]
                    if len(near):
                        a.append(np.full(len(near), node[i]))
                        b.append(node[near])
                        listed += len(near)
                    if listed >= PAIRS:
                        yield np.concatenate(a), np.concatenate(b)
                        a, b, listed = [], [], 0
                if a:
                    yield np.concatenate(a), np.concatenate(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        group: list[tuple] = []

        def rows_of(group):
            for a, b in compare(group):
                yield pa.RecordBatch.from_pydict({"a": pa.array([a], pa.list_(pa.int64())), "b": pa.array([b], pa.list_(pa.int64()))})

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(8))):
                if group and row[:3] != group[0][:3]:
                    yield from rows_of(group)
                    group = []
                group.append(row)
        if group:
            yield from rows_of(group)

    order = ("key", "p", "q")
    return sent.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a array<long>, b array<long>").withColumn("id", F.monotonically_increasing_id())


def confirm(a: np.ndarray, b: np.ndarray, held: dict[int, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (``a`` in runs of equal ones) that are similar on the sets ``held``, without those that links before them connect."""
    names = np.sort(np.fromiter(held, np.int64, len(held)))
    size = np.array([len(held[n]) for n in names])
    start = np.concatenate([[0], np.cumsum(size)])
    number = np.unique(np.concatenate([held[n] for n in names]), return_inverse=True)[1]
    marked = np.zeros(len(number), bool)
    label = np.arange(len(names))
    x, y = np.searchsorted(names, a), np.searchsorted(names, b)
    runs = np.flatnonzero(np.diff(x)) + 1
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for k, near in zip(x[np.concatenate([[0], runs])], np.split(y, runs)):
        near = near[label[near] != label[k]]
        own = number[start[k] : start[k + 1]]
        marked[own] = True
        for piece in np.array_split(near, 1 + size[near].sum() // HELD):
            if len(piece):
                first = np.concatenate([[0], np.cumsum(size[piece])])
                at = np.arange(first[-1]) + np.repeat(start[piece] - first[:-1], size[piece])
                both = np.add.reduceat(marked[number[at]].astype(np.int64), first[:-1])
                linked = piece[100 * both >= percent * (size[k] + size[piece] - both)]
                found.append((np.full(len(linked), names[k]), names[linked]))
                label[np.isin(label, label[linked])] = label[k]
        marked[own] = False
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _confirmed_lists(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``_confirmed`` for rows of pairs (id, a, b), as far as they connect: each row meets the sets of its nodes, once each."""
    lists = stored(lists, "candidates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        pairs, held = None, {}

        def links():
            return pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in confirm(*pairs, held, percent)], names=["a", "b"])

        for batch in batches:
            for k, (node, shingle_set) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if node is None:  # the first row of an id
                    if pairs:
                        yield links()
                    pairs, held = tuple(batch.column(c)[k].values.to_numpy() for c in (3, 4)), {}
                else:
                    held[node] = np.frombuffer(shingle_set, "<u8")
        if pairs:
            yield links()

    none = F.lit(None).cast("array<long>")
    needed = lists.select("id", F.explode(F.array_distinct(F.concat("a", "b"))).alias("node"))
    whole = needed.join(sets, "node").select("id", "node", "shingles", none.alias("a"), none.alias("b"))
    rows = whole.unionByName(lists, allowMissingColumns=True).select("id", "node", "shingles", "a", "b")
    return stored(rows.repartition("id").sortWithinPartitions("id", F.asc_nulls_first("node")).mapInArrow(run, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, percent: int = 85, doc_col: str = "doc_id", text_col: str = "text", named: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; ``kept`` marks the smallest id of a component.

    ``named`` adds (root, text_hash): a name of the component that rows with one
    id and unrelated texts do not share (null for a row without words), and the
    ``xxhash64`` of the text.
    """
    if percent < 80:
        raise ValueError("the index is laid out for similarities of 0.8 and more")
    most = limit(percent)
    rows = stored(describe(docs, doc_col, text_col), "described")
    linked = rows.where("n_shingles > 0 and doc_id is not null")
    nodes = stored(linked.groupBy("node", "twin").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles")), "nodes")
    members = _members(nodes)
    wanted = nodes.join(members.select("node").distinct(), "node").select("doc_id", "node", "twin")
    sets = _sets(docs.select(docs[doc_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), wanted)

    alone = members.withColumn("part", F.col("node"))
    first = _confirmed(_close(_star_pairs(alone, "node"), nodes, most), sets, percent)
    # Any connected parts will do to leave out pairs here; the components come after the second comparison.
    second = _confirmed(_close(_star_pairs(_labelled(members, nearest(first)), "node", "key"), nodes, most), sets, percent)
    parts = components(first.unionByName(second))
    third = _confirmed_lists(_block_pairs(_labelled(members, parts), nodes, percent), sets, percent)
    known = extended(parts, third).select("node", F.col("up").alias("found"))
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("found", "node"))
    rooted = rows.select("doc_id", "n_shingles", "node", "text_hash").join(known, "node", "left").withColumn("root", own)
    names = stored(rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least")), "names")
    return rooted.join(names, "root", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("least", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("least"), F.lit(True)).alias("kept"),
        *(["root", "text_hash"] if named else []),
    )


def representatives(docs: DataFrame, percent: int = 85, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: the smallest id's, and of its texts the one with the smallest hash.

    Rows without words or without an id stay, equal ones (id and text) once.
    """
    kept = near_duplicates(docs, percent, doc_col, text_col, named=True).where("kept")
    chosen = kept.groupBy("doc_id", "root", F.when(F.col("root").isNull(), F.col("text_hash")).alias("own")).agg(F.min("text_hash").alias("text_hash"))
    chosen = stored(chosen.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("text_hash").alias("_t")).distinct(), "chosen")
    name = F.coalesce(docs[doc_col].cast("string"), F.lit(""))
    rows = docs.withColumn("_id", name).withColumn("_t", F.xxhash64(docs[text_col]))
    return rows.join(chosen, ["_id", "_t"]).dropDuplicates(["_id", "_t"]).drop("_id", "_t")  # the join has dealt the rows by these already
