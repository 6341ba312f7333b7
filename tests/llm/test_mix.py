"""Operator 11: targets, draws, blocks and copies against plain versions."""

import hashlib
import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from reviewforge.llm import source_mix as mix
from tests.conftest import SF_SMALL
from tests.llm.helpers import WORD, edge_docs


def plain_targets(sizes, epochs=1.5, repeats=2, weights=(5, 2, 1)):
    """Share by weight; who is over stops there and the rest is shared anew, until none is over."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = epochs * sum(sizes.values()), set(names), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / whole >= repeats * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / whole for s in open_}
        out |= {s: float(repeats * sizes[s]) for s in over}
        left -= sum(repeats * sizes[s] for s in over)
        open_ -= over
    return out


def plain_taken(rows):
    """``rows``: (doc_id, source, text) -> sorted (doc_id, size, source_size, target, taken)."""
    groups, out = {}, []
    for i, s, t in rows:
        name = "" if i is None else str(i)
        groups.setdefault(s, []).append((int(hashlib.md5(name.encode()).hexdigest()[:15], 16), i, len(WORD.findall(t or ""))))
    sizes = {s: sum(r[2] for r in g) for s, g in groups.items()}
    goals = plain_targets(sizes)
    for s, g in groups.items():
        g.sort(key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
        target, copies, at, done = goals[s], Counter(), 0, False
        for epoch in range(2):
            for k, (_, _, size) in enumerate(g):
                if size and at + size > target and at < target and not done:
                    gap, done = target - at, True
                    best = min((abs(r[2] - gap), r[0], r[1] is not None, r[1] or 0, r[2], j) for j, r in enumerate(g[k:], k) if r[2])
                    if best[0] < gap:
                        copies[best[-1]] += 1
                if at + size <= target:
                    copies[k] += 1
                at += size
        out += [(i, n, sizes[s], round(target, 6), copies[k] * n) for k, (_, i, n) in enumerate(g)]
    return sorted(out, key=str)


def answers(docs):
    return sorted(((*r[:3], round(r[3], 6), r[4]) for r in mix.taken(docs).collect()), key=str)


@pytest.mark.parametrize("sizes", [{"a": 100}, {"a": 1, "b": 1, "c": 1}, {"a": 10, "b": 1000, "c": 1000, None: 7}, {"a": 0, "b": 5}, {"a": 0}, {f"s{i}": 3 ** (i % 9) for i in range(40)}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([("" if s is None else f"={s}", n) for s, n in sizes.items()], "g string, source_size long")
    got = {r.g: r.target for r in mix.targets(rows).collect()}
    for s, t in plain_targets(sizes).items():
        assert got["" if s is None else f"={s}"] == pytest.approx(t)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


@pytest.mark.parametrize("good, total, drawn", [(3, 10, 4), (0, 5, 2), (5, 5, 3), (40, 100, 97), (1, 50, 25), (300, 700, 350)])
def test_draws_invert_the_exact_distribution(spark, good, total, drawn):
    n = 2000
    us = spark.range(n).select(((F.col("id") + 0.5) / n).alias("u"))
    got = Counter(r[0] for r in us.select(mix.hypergeometric(F.col("u"), F.lit(good), F.lit(total), F.lit(drawn))).collect())
    ways = math.comb(total, drawn)
    for k in range(min(good, drawn) + 1):
        p = math.comb(good, k) * math.comb(total - good, drawn - k) / ways if drawn - k <= total - good else 0
        assert abs(got[k] - n * p) <= 1.01, k
    assert sum(got.values()) == n


def test_the_tree_holds_quotas_and_sizes(spark):
    quotas = {1: 300, 2: 1, 3: 0, 4: 57, 5: 1200}
    rows = mix.shard_quotas(spark.createDataFrame(list(quotas.items()), "nth int, quota long"), shard_blocks=7).collect()
    by_shard, by_source = Counter(), {}
    for r in rows:
        by_shard[r.shard] += r.blocks
        by_source.setdefault(r.nth, []).append((r.first, r.blocks))
    shards = -(-sum(quotas.values()) // 7)
    assert sorted(by_shard) == list(range(shards)) and max(by_shard.values()) - min(by_shard.values()) <= 1
    for nth, runs in by_source.items():  # disjoint runs that cover the quota
        at = 0
        for first, blocks in sorted(runs):
            assert first == at
            at += blocks
        assert at == quotas[nth]
    # A source's blocks in the first half of the shards vary like a draw without replacement.
    half = sum(r.blocks for r in rows if r.nth == 1 and r.shard < shards // 2)
    assert abs(half - 150) < 60


def test_taken_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    want = plain_taken(rows)
    assert answers(docs) == want
    assert answers(docs.repartition(5)) == want  # however the rows are dealt
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    assert sorted(((*r[:3], round(r[3], 6), r[4]) for r in con.sql(mix.SQL).fetchall()), key=str) == want


def test_edges(spark):
    docs = edge_docs(spark)
    docs = docs.unionByName(docs.where("doc_id in (3, 5)"))
    assert answers(docs) == plain_taken([tuple(r) for r in docs.select("doc_id", "source", "text").collect()])
    assert answers(docs.where("false")) == []
    assert all(r[2:] == (0, 0.0, 0) for r in answers(docs.where("doc_id in (0, 1, 2)")))


def test_shards_hold_whole_rows_in_a_repeatable_order(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")

    def run(d):
        out, rows = mix.mix(mix.sized(d, keep=("doc_id", "text")), block_words=200, shard_blocks=8)
        return sorted((r.shard, r.place, r.epoch, r.doc_id, r.own.text) for r in out.collect()), rows.agg(F.sum("size")).first()[0]

    got, words = run(docs)
    assert run(docs.repartition(3))[0] == got
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r[3]] == r[4] for r in got)
    for shard in {r[0] for r in got}:
        assert [r[1] for r in got if r[0] == shard] == list(range(1, sum(r[0] == shard for r in got) + 1))
    assert max(Counter((r[3], r[2]) for r in got).values()) == 1  # a copy per round at most
    assert sum(len(WORD.findall(r[4])) for r in got) == pytest.approx(1.5 * words, rel=0.02)
