"""Operator 13 against a plain tree, over several heights of the runs."""

import hashlib
import zlib

import duckdb
import pytest

from reviewforge.llm import merkle_manifest as merkle
from tests.conftest import SF_SMALL
from tests.llm.helpers import edge_docs


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """(root, the path of every leaf as [(side of the sibling, digest or None)])"""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for path, i in zip(paths, at):
            other = i ^ 1
            path.append((other & 1, level[other] if other < len(level) else None))
        at = [i // 2 for i in at]
        level = [h(*level[k : k + 2]) for k in range(0, len(level), 2)]
    return level[0], paths


def plain_audit(rows):
    """``rows``: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        # Rows that differ only in what is shown are equal rows, so leaf order settles everything.
        ranked = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[g] = (ranked, *plain_tree([plain_leaf(r) for r in ranked]))
    root, tops = plain_tree([trees[g][1] for g in names]) if names else (None, [])
    out = []
    for g, top in zip(names, tops):
        ranked, subroot, paths = trees[g]
        for r, path in zip(ranked, paths):
            whole = path + top
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            node = plain_leaf((*r[:3], r[3] + 1, r[4]) if changed else r)
            for right, other in whole:
                node = h(node) if other is None else h(node, other) if right else h(other, node)
            out.append((r[0], plain_leaf(r), subroot, root, h(*(o for _, o in whole if o)), node, node == root))
    return sorted(out, key=str)


def answers(docs, height=merkle.HEIGHT):
    return sorted(map(tuple, merkle.audit(docs, merkle.tampered(docs), height).collect()), key=str)


@pytest.mark.parametrize("n", range(1, 70))
@pytest.mark.parametrize("height", [2, 3, 12])
def test_positions_in_the_log_are_closed_form(n, height):
    leaves = [h(str(i)) for i in range(n)][: 1 << height]
    n = len(leaves)
    log = merkle.postorder(leaves, False, height).hex()
    assert merkle.levels_of(len(log) // 2, n) == (n - 1).bit_length()
    level, nodes = 0, leaves
    while True:
        for k, node in enumerate(nodes):
            at = 64 * merkle.position(level, k, n)
            assert log[at : at + 64] == node
        if len(nodes) == 1:
            break
        nodes, level = [h(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)], level + 1
    assert log[-64:] == plain_tree(leaves)[0]


@pytest.mark.parametrize("height", [1, 3, 12])
def test_audit_equals_a_plain_tree(spark, height):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*merkle.COLUMNS).collect()]
    got = answers(docs, height)
    assert got == plain_audit(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("height", [1, 12])
def test_edges(spark, height):
    docs = edge_docs(spark)
    docs = docs.unionByName(docs.where("doc_id in (3, 5)"))  # equal rows
    rows = [tuple(r) for r in docs.select(*merkle.COLUMNS).collect()]
    assert answers(docs, height) == plain_audit(rows)
    assert answers(docs.where("false"), height) == []
    one = docs.where("doc_id = 7")
    assert answers(one, height) == plain_audit([tuple(r) for r in one.select(*merkle.COLUMNS).collect()])


def test_a_path_proves_only_its_own_leaf(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = merkle.prove(merkle.build(merkle.leaves(docs), 3)).limit(20).collect()
    for r, other in zip(rows, rows[1:]):
        assert merkle.fold(r.leaf, r.path) == r.root != merkle.fold(other.leaf, r.path)


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert sorted(con.sql(merkle.SQL).fetchall(), key=str) == answers(docs)
