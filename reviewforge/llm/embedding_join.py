"""Operator 3: near-duplicate vectors by an epsilon grid order join.

Unit vectors have a cosine of at least ``c`` exactly if they are at most
``sqrt(2 - 2c)`` apart, and a projection on orthonormal directions brings no
two of them further apart. So the vectors of a label are projected on leading
principal directions, sorted by the grid cells (of that width) there, and cut
into blocks: the epsilon grid order. Blocks meet only in equal or adjacent
cells; pairs of them whose boxes in the
projection are too far apart are skipped; the others are joined recursively,
halving both sequences and skipping halves in the same way, and leaves are
compared by their cosines in double precision. The directions only steer what
can be skipped, so fitting them on a sample loses nothing.

Equal vectors of a label are one node with a weight. A pair of blocks returns
counts per node and a spanning forest of its links, in proportion to the
blocks, however dense the links are. A label with a third of all rows is many
blocks; blocks of a pair meet in one task, whole labels never.

Defined results: a null label, a null, empty or zero vector, or one with null
or non-finite components, and a row with a null id link with nothing (0 links,
own component). Vectors of different lengths don't link. Repeated rows are
vectors of their own and link with each other. An empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, python_ready, stored

#: Vectors in a block and in a leaf; directions of the grid; vectors that the directions are fitted on, at most.
BLOCK, LEAF, DIRECTIONS, SAMPLE = 512, 128, 4, 4096

#: Directions by whose cells blocks meet, and the least width of these cells (a block lies in at most 12 of a direction).
KEYED, COARSE = 3, 0.2

BLOCKS = "label string, size int, block long, low array<double>, high array<double>, nodes binary, weights binary, vectors binary"


def _nodes(rows: DataFrame) -> DataFrame:
    """(node, label, vector, weight): distinct usable vectors of a label. ``node`` is their 64-bit hash."""
    usable = rows.where("node is not null")
    return usable.groupBy("node", "label", "vector").agg(F.count(F.lit(1)).alias("weight"))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares of tiny or huge components would not do
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit_directions(nodes: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Leading principal directions for each vector length in a sample (the nodes with the smallest hashes)."""
    chosen = nodes.select("node", "vector").orderBy("node").limit(sample).collect()
    found = {}
    for size in sorted({len(r["vector"]) for r in chosen}):
        x = _unit(np.array([r["vector"] for r in chosen if len(r["vector"]) == size]))
        x = x - x.mean(axis=0)
        found[size] = np.linalg.svd(x.T @ x)[0][:, : min(DIRECTIONS, size)]
    return found


def _directions(found: dict[int, np.ndarray], size: int) -> np.ndarray:
    return found[size] if size in found else np.eye(size)[:, : min(DIRECTIONS, size)]


def grid_blocks(nodes: DataFrame, width: float, directions: dict[int, np.ndarray]) -> DataFrame:
    """The nodes in epsilon grid order, cut into blocks with their boxes."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vector in batch.column("vector").to_pylist():
                unit = _unit(np.array([vector]))
                out.append(np.floor(unit @ _directions(directions, len(vector)) / width)[0].astype(int).tolist())
            yield batch.append_column("cells", pa.array(out, pa.list_(pa.int32())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId(), 0, []

        def block():
            nonlocal made, held
            vectors = np.array([h[2] for h in held])
            at = _unit(vectors) @ _directions(directions, vectors.shape[1])
            row = {"label": [held[0][1]], "size": pa.array([vectors.shape[1]], pa.int32()), "block": pa.array([part << 32 | made], pa.int64()), "low": [at.min(axis=0).tolist()], "high": [at.max(axis=0).tolist()]}
            row |= {"nodes": [np.array([h[0] for h in held], "<i8").tobytes()], "weights": [np.array([h[3] for h in held], "<i8").tobytes()], "vectors": [vectors.astype("<f8").tobytes()]}
            made, held = made + 1, []
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("node", "label", "vector", "weight"))):
                if held and (len(held) >= BLOCK or (row[1], len(row[2])) != (held[-1][1], len(held[-1][2]))):
                    yield block()
                held.append(row)
        if held:
            yield block()

    python_ready(nodes.sparkSession)
    celled = nodes.select("node", "label", "vector", "weight").mapInArrow(cells, "node long, label string, vector array<double>, weight long, cells array<int>")
    order = ["label", F.size("vector"), "cells", "node"]
    return stored(stored(celled, "cells").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, BLOCKS), "blocks")


def join_blocks(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, cosine: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into the sequences ``a`` and ``b`` of unit vectors) of cosine ``cosine`` or more.

    ``at_a`` and ``at_b`` are their projections; with ``same`` the sequences are
    one and each pair is given once.
    """
    reach = 2 - 2 * cosine + 1e-9
    left, right = [], []

    def join(i: int, j: int, k: int, m: int) -> None:
        if same and k < i:
            return
        gap = np.maximum(0, np.maximum(at_a[i:j].min(axis=0) - at_b[k:m].max(axis=0), at_b[k:m].min(axis=0) - at_a[i:j].max(axis=0)))
        if gap @ gap > reach:
            return
        if j - i <= LEAF and m - k <= LEAF:
            x, y = np.nonzero(a[i:j] @ b[k:m].T >= cosine)
            if same and i == k:
                x, y = x[x < y], y[x < y]
            left.append(x + i)
            right.append(y + k)
            return
        # The longer sequence is halved; equal ones both, so that a sequence joined with itself stays aligned.
        halves_a = [(i, (i + j) // 2), ((i + j) // 2, j)] if j - i > LEAF and j - i >= m - k else [(i, j)]
        halves_b = [(k, (k + m) // 2), ((k + m) // 2, m)] if m - k > LEAF and m - k >= j - i else [(k, m)]
        for p, q in halves_a:
            for r, s in halves_b:
                join(p, q, r, s)

    if len(a) and len(b):
        join(0, len(a), 0, len(b))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` items the smallest one reachable over the links."""
    least = np.arange(n)
    while len(left):
        was = least.copy()
        np.minimum.at(least, left, least[right])
        np.minimum.at(least, right, least[left])
        least = least[least]
        if (was == least).all():
            break
    return least


def block_pairs(blocks: DataFrame, cosine: float) -> DataFrame:
    """(x, y): the pairs of blocks, each once, whose boxes are near enough for a link.

    Blocks of a label meet by an equi-join on the grid cells of the first
    directions: one side in each cell it lies in, the other also in the cells next
    to these. Far parts of a label's sequence never meet. A pair that shares several
    cells counts in the first.
    """
    reach = 2 - 2 * cosine + 1e-9
    width = max(math.sqrt(reach) * (1 + 1e-9), COARSE)
    directions = range(KEYED)

    def celled(margin: int) -> DataFrame:
        found = blocks.select("label", "size", "block", "low", "high")
        for d in directions:
            lowest, highest = (F.floor(F.coalesce(F.get(side, F.lit(d)), F.lit(0.0)) / width).cast("int") for side in ("low", "high"))
            found = found.withColumn(f"from{d}", lowest - margin).withColumn(f"cell{d}", F.explode(F.sequence(lowest - margin, highest + margin)))
        return found

    one, two = celled(0).alias("p"), celled(1).alias("q")
    equal = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in ("label", "size", *(f"cell{d}" for d in directions))]
    first = [F.col(f"p.cell{d}") == F.greatest(f"p.from{d}", f"q.from{d}") for d in directions]
    gaps = F.zip_with(F.zip_with("p.low", "q.high", lambda a, b: a - b), F.zip_with("q.low", "p.high", lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0)))
    near = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= reach
    return one.join(two, [*equal, *first, F.col("p.block") <= F.col("q.block"), near]).select(F.col("p.block").alias("x"), F.col("q.block").alias("y"))


def compare(blocks: DataFrame, cosine: float, directions: dict[int, np.ndarray]) -> DataFrame:
    """(node, other, links): linked weight per node (``other`` null), and the links of a spanning forest (``links`` null)."""
    pairs = block_pairs(blocks, cosine)
    held = blocks.select("block", "size", F.struct("nodes", "weights", "vectors").alias("b"))
    met = pairs.join(held.select(F.col("block").alias("x"), "size", F.col("b").alias("bx")), "x").join(held.select(F.col("block").alias("y"), F.col("b").alias("by")), "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, size, bx, by in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "size", "bx", "by"))):
                same, sides = x == y, []
                for b in (bx, by):
                    unit = _unit(np.frombuffer(b["vectors"], "<f8").reshape(-1, size))
                    sides.append((np.frombuffer(b["nodes"], "<i8"), np.frombuffer(b["weights"], "<i8"), unit, unit @ _directions(directions, size)))
                (n1, w1, u1, a1), (n2, w2, u2, a2) = sides
                left, right = join_blocks(u1, u2, a1, a2, cosine, same)
                if not len(left):
                    continue
                nodes, weights = (n1, w1) if same else (np.concatenate([n1, n2]), np.concatenate([w1, w2]))
                right = right if same else right + len(n1)
                links = np.bincount(left, weights[right], len(nodes)) + np.bincount(right, weights[left], len(nodes))
                least = forest(len(nodes), left, right)
                told, tree = np.flatnonzero(links), np.flatnonzero(least != np.arange(len(nodes)))
                yield pa.RecordBatch.from_arrays([pa.array(nodes[told]), pa.nulls(len(told), pa.int64()), pa.array(links[told].astype(np.int64))], names=["node", "other", "links"])
                yield pa.RecordBatch.from_arrays([pa.array(nodes[tree]), pa.array(nodes[least[tree]]), pa.nulls(len(tree), pa.int64())], names=["node", "other", "links"])

    return stored(met.select("x", "y", "size", "bx", "by").mapInArrow(run, "node long, other long, links long"), "links")


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    vector = vectors[vector_col].cast("array<double>")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    usable = vectors[label_col].isNotNull() & vectors[id_col].isNotNull() & F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))
    label = vectors[label_col].cast("string")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), label.alias("label"), vector.alias("vector"), F.when(usable, F.xxhash64(label, vector)).alias("node"))
    nodes = stored(_nodes(rows), "vectors")
    directions = fit_directions(nodes)
    found = compare(grid_blocks(nodes, math.sqrt(2 - 2 * cosine), directions), cosine, directions)
    linked = nodes.select("node", "weight").join(found.where("links is not null").groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    tied = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    told = linked.join(tied, "node", "left").select("node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("links"), F.coalesce("up", "node").alias("root"))
    placed = rows.select("vec_id", "node").join(told, "node", "left")
    least = placed.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("least"))
    return placed.join(least, "root", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "vec_id").cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("least"), F.lit(True)).alias("kept"),
    )


SQL = """
with recursive v as (
  select row_number() over () as r, vec_id, label, cast(embedding as double[]) as e from embeddings
  where label is not null and vec_id is not null and embedding is not null
    and list_count(embedding) = len(embedding) and len(list_filter(cast(embedding as double[]), lambda x: not isfinite(x))) = 0
    and len(list_filter(cast(embedding as double[]), lambda x: x <> 0)) > 0),
l as (select a.r as a, b.r as b from v a join v b
  on a.label = b.label and a.r <> b.r and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) as (select a, b from l union select reach.a, l.b from reach join l on reach.b = l.a),
c as (select a as r, min(v.vec_id) as least from reach join v on reach.b = v.r group by a),
n as (select a as r, count(*) as n_links from l group by a),
one as (select v.vec_id, coalesce(n_links, 0) as n_links, least(v.vec_id, coalesce(least, v.vec_id)) as component_id
  from v left join n using (r) left join c using (r)
  union all
  select vec_id, 0, vec_id from embeddings where not (label is not null and vec_id is not null and embedding is not null
    and list_count(embedding) = len(embedding) and len(list_filter(cast(embedding as double[]), lambda x: not isfinite(x))) = 0
    and len(list_filter(cast(embedding as double[]), lambda x: x <> 0)) > 0))
select vec_id, cast(n_links as bigint) as n_links, component_id, coalesce(vec_id = component_id, true) as kept from one"""
