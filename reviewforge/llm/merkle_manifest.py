"""Operator 13: a Merkle manifest of a dataset, kept as postorder append logs.

Every row is a leaf: the SHA-256 of its columns, each written as its byte count
and value. The leaves of a group (language) form a binary tree in ascending id
order, a lone last node being hashed alone; the groups' roots form one more tree.

Leaves are dealt in aligned runs of ``2 ** HEIGHT``. A builder takes one run and
appends the digests of its subtree to a log in the order in which the nodes are
complete: a leaf, then every parent that it completes. So no position is stored.
Before leaf ``m`` completes, ``2 m - popcount(m)`` nodes are written, and a node
of level ``l`` follows ``l`` places after the last leaf that it covers; that
addresses every sibling (:func:`position`). The runs' roots are the leaves of the
next tier, until a group has one run. Proofs go the other way: each tier extends
the path of a run's root by the siblings found in its log, and what a run inherits
is at most some 33 bytes a level. All tiers but the first have 1/4096 of the rows
of the one before, runs have at most 4096 rows, and nothing passes the driver but
the number of runs of the largest group.

Defined results: nulls in any column hash as ``-``; a null id comes first in its
group, a null group before the others; rows with the same id follow each other by
leaf, and equal rows get the paths of their own places; a group of one row has the
leaf as its root; an empty table gives no row. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewforge.operators.sequence import number_within

from .common import python_ready, stored

#: Levels that one builder makes.
HEIGHT = 12
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

LOG = "g string, run long, n int, log binary"
NODE = "g string, run long, inherited binary"
NONE, LEFT, RIGHT = 0, 1, 2


# -- one run ----------------------------------------------------------------------------------


def digest(*hexes: str) -> str:
    """SHA-256 of hex texts one after the other, as hex text."""
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def position(level: int, index: int, n: int) -> int:
    """Where the log of a run of ``n`` leaves holds node ``index`` of ``level``."""
    last = min((index + 1) << level, n) - 1  # the leaf that completes the node
    return 2 * last - last.bit_count() + level


def postorder(leaves: list[str], lifted: bool, height: int = HEIGHT) -> bytes:
    """The log of one run. With ``lifted`` (the group has other runs) its root rises to ``height``."""
    log, open_nodes = [], []  # open_nodes: (level, digest), levels falling

    def add(level: int, node: str) -> None:
        log.append(node)
        open_nodes.append((level, node))

    for leaf in leaves:
        add(0, leaf)
        while len(open_nodes) > 1 and open_nodes[-2][0] == open_nodes[-1][0]:
            level, right = open_nodes.pop()
            add(level + 1, digest(open_nodes.pop()[1], right))
    # What the last leaf leaves open: nodes without a partner are hashed alone.
    while len(open_nodes) > 1 or (lifted and open_nodes[0][0] < height):
        level, node = open_nodes.pop()
        pair = open_nodes and open_nodes[-1][0] == level
        add(level + 1, digest(open_nodes.pop()[1], node) if pair else digest(node))
    return bytes.fromhex("".join(log))


def siblings(log: str, index: int, n: int, levels: int) -> bytes:
    """The path of leaf ``index`` inside a run: for each level the side of its sibling and its digest, if it has one."""
    path = []
    for level in range(levels):
        other = (index >> level) ^ 1
        if other << level < n:
            at = 64 * position(level, other, n)
            path.append(("02" if other & 1 else "01") + log[at : at + 64])
        else:
            path.append("00")
    return bytes.fromhex("".join(path))


def levels_of(log_bytes: int, n: int) -> int:
    """Levels above the leaves: the root is the last node, which the last leaf completes."""
    return log_bytes // 32 - 1 - (2 * (n - 1) - (n - 1).bit_count())


def steps(path: bytes) -> Iterator[tuple[int, str]]:
    """(side, digest) of every level of a path, the leaf's first."""
    at = 0
    while at < len(path):
        side = path[at]
        width = 32 if side else 0
        yield side, path[at + 1 : at + 1 + width].hex()
        at += 1 + width


def fold(leaf: str, path: bytes) -> str:
    """The root that ``leaf`` and its path lead to."""
    for side, other in steps(path):
        leaf = digest(other, leaf) if side == LEFT else digest(leaf, other) if side == RIGHT else digest(leaf)
    return leaf


# -- leaves -----------------------------------------------------------------------------------


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def leaves(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang", shown: dict[str, Column] | None = None) -> DataFrame:
    """(id, g, leaf, shown) of every row: ``shown`` is the leaf of the row with some columns replaced, as a reader was shown it.

    ``g`` sorts like the group by code point, null first.
    """
    group = docs[group_col].cast("string")
    own = leaf([docs[c] for c in columns])
    seen = leaf([(shown or {}).get(c, docs[c]) for c in columns]) if shown else own
    return docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("g"), own.alias("leaf"), seen.alias("shown"))


# -- logs -------------------------------------------------------------------------------------


class Manifest(NamedTuple):
    """``rows``: (id, g, leaf, shown, run, place). ``groups``, ``roots``: the logs of each tier, the leaves' first."""

    rows: DataFrame
    groups: list[DataFrame]
    roots: list[DataFrame]
    height: int


def _placed(df: DataFrame, height: int) -> DataFrame:
    """``nth`` (from 1, within g) as the run and the place in it."""
    at = F.col("nth") - 1
    return df.select("*", F.shiftright(at, height).alias("run"), at.bitwiseAND((1 << height) - 1).cast("int").alias("place")).drop("nth")


def _tier(nodes: DataFrame, height: int) -> DataFrame:
    """The logs of all runs of ``nodes`` (g, run, place, node)."""

    def build(key: tuple, run: pa.Table) -> pa.Table:
        nodes = run.sort_by("place").column("node").to_pylist()
        log = postorder(nodes, key[1].as_py() > 0, height)
        return pa.table({"g": [key[0].as_py()], "run": pa.array([key[1].as_py()], pa.int64()), "n": pa.array([len(nodes)], pa.int32()), "log": pa.array([log], pa.binary())})

    return stored(nodes.select("g", "run", "place", "node").groupBy("g", "run").applyInArrow(build, LOG), "merkle-logs")


def _root(log: str = "log") -> Column:
    return F.lower(F.hex(F.substring(log, -32, 32)))


def _tiers(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Logs of the runs, of their roots and so on, until every group has one run."""
    tiers = [_tier(nodes, height)]
    while (tiers[-1].agg(F.max("run")).first()[0] or 0) > 0:
        up = tiers[-1].select("g", (F.col("run") + 1).alias("nth"), _root().alias("node"))
        tiers.append(_tier(_placed(up, height), height))
    return tiers


def build(rows: DataFrame, height: int = HEIGHT) -> Manifest:
    """The manifest of ``rows`` (id, g, leaf, shown)."""
    python_ready(rows.sparkSession)
    # Written before they are numbered: range partitioning reads its input twice, and the hashes are the work.
    placed = _placed(number_within(stored(rows, "merkle-leaves"), ["g"], ["id", "leaf", "shown"], out="nth"), height)
    placed = stored(placed, "merkle-rows")
    groups = _tiers(placed.withColumnRenamed("leaf", "node"), height)
    tops = number_within(groups[-1].select(F.lit("").alias("all"), "g", _root().alias("node")), ["all"], ["g"], out="nth")
    roots = _tiers(_placed(tops.select(F.col("all").alias("g"), "node", "nth"), height), height)
    return Manifest(placed, groups, roots, height)


# -- proofs -----------------------------------------------------------------------------------


def _down(tier: DataFrame, known: DataFrame, height: int) -> DataFrame:
    """(g, run, inherited) for the runs of the tier below: ``known`` holds what this tier's runs inherit."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, run, n, log, inherited in zip(*(c.to_pylist() for c in batch.columns)):
                levels, text = levels_of(len(log), n), log.hex()
                paths = [siblings(text, i, n, levels) + inherited for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([g] * n, pa.string()), pa.array(range(run << height, (run << height) + n), pa.int64()), pa.array(paths, pa.binary())], names=["g", "run", "inherited"])

    return tier.join(known, ["g", "run"]).select("g", "run", "n", "log", "inherited").mapInArrow(extend, NODE)


def prove(manifest: Manifest) -> DataFrame:
    """(id, leaf, shown, subroot, root, path) of every row; :func:`fold` leads from the leaf and its path to the root."""
    height = manifest.height
    top = manifest.roots[-1].select("g", "run", F.lit(b"").alias("inherited"))
    for tier in reversed(manifest.roots):
        top = _down(tier, top, height)
    # Places among the roots are the groups in order, so they are numbered once more the same way.
    subroots = manifest.groups[-1].select(F.lit("").alias("all"), "g", _root().alias("subroot"))
    order = number_within(subroots, ["all"], ["g"], out="nth").select("g", "subroot", (F.col("nth") - 1).alias("at"))
    root = manifest.roots[-1].select(_root().alias("root"))  # one row
    heads = stored(order.join(top.select(F.col("run").alias("at"), "inherited"), "at").join(F.broadcast(root)).select("g", "subroot", "root", "inherited"), "merkle-heads")
    known = heads.select("g", F.lit(0).cast("long").alias("run"), "inherited")
    for tier in reversed(manifest.groups[1:]):
        known = _down(tier, known, height)
    runs = manifest.groups[0].join(known, ["g", "run"]).join(heads.drop("inherited"), "g")

    def extend(rows: pa.Table, run: pa.Table) -> pa.Table:
        n, data, inherited = run.column("n")[0].as_py(), run.column("log")[0].as_py(), run.column("inherited")[0].as_py()
        levels, log = levels_of(len(data), n), data.hex()
        paths = [siblings(log, i, n, levels) + inherited for i in rows.column("place").to_pylist()]
        same = lambda c: pa.array([run.column(c)[0].as_py()] * len(paths), pa.string())
        return pa.table({"id": rows["id"], "leaf": rows["leaf"], "shown": rows["shown"], "subroot": same("subroot"), "root": same("root"), "path": pa.array(paths, pa.binary())})

    rows = manifest.rows.groupBy("g", "run").cogroup(runs.groupBy("g", "run"))
    return rows.applyInArrow(extend, "id long, leaf string, shown string, subroot string, root string, path binary")


def audit(docs: DataFrame, shown: dict[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """Every row's proof, and whether the row as shown leads to the root.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            proofs = [digest(*(other for _, other in steps(p))) for p in paths]
            folded = [fold(seen, p) for seen, p in zip(batch.column("shown").to_pylist(), paths)]
            verified = [a == b for a, b in zip(folded, batch.column("root").to_pylist())]
            own = [batch.column(c) for c in ("id", "leaf", "subroot", "root")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array(verified, pa.bool_())], names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    proofs = prove(build(leaves(docs, shown=shown), height))
    return proofs.mapInArrow(check, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def tampered(docs: DataFrame, every: int = 7) -> dict[str, Column]:
    """What a reader is shown in the contract's trial: one character more where ``every`` divides the id's crc32."""
    hit = F.crc32(docs["doc_id"].cast("string")) % every == 0
    return {"n_chars": F.when(hit, docs["n_chars"].cast("long") + 1).otherwise(docs["n_chars"].cast("long"))}


_BIT = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"  # CRC-32's polynomial, bits reversed (fixed value)
_CRC = f"""xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(range(strlen(cast(doc_id as varchar))),
  lambda k: cast(ascii(substr(cast(doc_id as varchar), cast(k + 1 as int), 1)) as bigint))),
  lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {_BIT})))"""


def _field_sql(c: str) -> str:
    return f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"


def _sql() -> str:
    """DuckDB SQL for :func:`audit` over ``documents``: the levels by recursion over whole groups."""
    own = " || ".join(map(_field_sql, COLUMNS))
    seen = " || ".join(_field_sql("n_chars + 1" if c == "n_chars" else c) for c in COLUMNS)
    return f"""
with recursive
d as (select doc_id, coalesce('=' || lang, '') as g, sha256({own}) as leaf,
  case when doc_id is not null and {_CRC} % 7 = 0 then sha256({seen}) else sha256({own}) end as shown from documents),
p as (select row_number() over () as r, * from (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by g) as n from d)),
v(g, l, i, h, n) as (
  select g, 0, i, leaf, n from p
  union all select g, l + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2 from v where n > 1 group by g, l, i // 2, n),
s as (select g, h, row_number() over (order by g) - 1 as i, count(*) over () as n, l as top from v where n = 1),
t(l, i, h, n) as (
  select 0, i, h, n from s
  union all select l + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2 from t where n > 1 group by l, i // 2, n),
f(r, g, l, i, h, n, proof, up) as (
  select r, g, 0, i, shown, n, '', false from p
  union all
  select f.r, f.g, case when jump then 0 else f.l + 1 end, case when jump then s.i else f.i // 2 end,
    case when jump then f.h else sha256(case when f.i % 2 = 1 then coalesce(a.h, b.h, '') || f.h else f.h || coalesce(a.h, b.h, '') end) end,
    case when jump then s.n else (f.n + 1) // 2 end, f.proof || case when jump then '' else coalesce(a.h, b.h, '') end, f.up or jump
  from (select *, n = 1 and not up as jump from f where n > 1 or not up) f join s on s.g = f.g
    left join v a on not f.up and not f.jump and a.g = f.g and a.l = f.l and a.i = xor(f.i, 1)
    left join t b on f.up and b.l = f.l and b.i = xor(f.i, 1))
select p.doc_id, p.leaf, s.h as subroot, (select h from t where n = 1) as root, sha256(f.proof) as proof_sha256, f.h as folded_root,
  f.h = (select h from t where n = 1) as verified
from p join s using (g) join f on f.r = p.r and f.up and f.n = 1"""


SQL = _sql()
