"""Operators 2, 3 and 5 against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewforge.llm import embedding_join, minhash_join, suffix_dedup
from reviewforge.llm.common import components
from reviewforge.llm.suffix_groups import suffix_array
from tests.llm.helpers import edge_docs, near_duplicate_components, without_repeats


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(200, 260)] + [(5, 5), (300, 299), (299, 300), (301, 300)]
    got = {}
    for r in components(spark.createDataFrame(edges, "a long, b long")).collect():
        got.setdefault(r.up, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted([list(range(100, 181)), [7, *range(200, 260)], [299, 300, 301]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies():
    r = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(12):
        base = [r.choice(words) for _ in range(r.randint(3, 120))]
        for _ in range(r.randint(1, 14)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append(" ".join(copy))
    r.shuffle(rows)
    return list(enumerate(rows))


def test_minhash_join_finds_every_component(spark, monkeypatch):
    docs = near_copies()
    want, sizes = near_duplicate_components(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for block, held, pairs in ((2048, 2_000_000, 1_000_000), (3, 20, 1_000_000), (2048, 2_000_000, 2)):
        monkeypatch.setattr(minhash_join, "BLOCK", block)
        monkeypatch.setattr(minhash_join, "HELD", held)
        monkeypatch.setattr(minhash_join, "PAIRS", pairs)
        got = {r.doc_id: r for r in minhash_join.near_duplicates(df).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert {i: r.n_shingles for i, r in got.items()} == sizes
        assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_rows_of_pairs_are_bounded(spark, monkeypatch):
    # one bucket of different components: the same pairs, in one row or in rows cut at PAIRS
    r = np.random.default_rng(3)
    base = r.integers(0, 2**16, minhash_join.VALUES, dtype=np.uint64).astype("<u2")
    key = int(minhash_join.keys(base[None, : minhash_join.INDEXED])[0, 0])
    nodes = spark.createDataFrame([(n, base.tobytes(), 9) for n in range(40)], "node long, sig binary, n_shingles int")
    labelled = spark.createDataFrame([(key, 40, n, n) for n in range(40)], "key long, size int, node long, part long")
    found = {}
    for most in (10**6, 100):
        monkeypatch.setattr(minhash_join, "PAIRS", most)
        found[most] = [(x.a, x.b) for x in minhash_join._block_pairs(labelled, nodes, 85).collect()]
    assert len(found[10**6]) == 1 and max(len(a) for a, _ in found[100]) < 100 + 40
    pairs = {most: sorted(p for a, b in rows for p in zip(a, b)) for most, rows in found.items()}
    assert len(pairs[100]) == 40 * 39 // 2 and pairs[100] == pairs[10**6]


def test_minhash_join_at_the_similarity_of_the_pipeline(spark):
    docs = near_copies()
    want, _ = near_duplicate_components(docs, 80)
    assert want != near_duplicate_components(docs)[0]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash_join.near_duplicates(df, 80).collect()} == want


def test_signature_limit_of_each_similarity():
    assert [minhash_join.limit(p) for p in (80, 85, 100)] == [106, 84, 0]


@pytest.mark.parametrize("percent, shared, seeds", [(85, 17, (628, 8213)), (80, 16, (7822, 14131))])
def test_minhash_join_links_pairs_beyond_the_signature_limit(spark, percent, shared, seeds):
    docs = []
    for seed in seeds:
        r = random.Random(seed)
        words = [f"w{r.randrange(10**6)}" for _ in range(24)]
        pair = [" ".join(words[: shared + 4]), " ".join(words)]
        x, y = (minhash_join.signature(minhash_join.shingles(t)) for t in pair)
        assert (x != y).sum() > minhash_join.limit(percent) and (minhash_join.keys(x[None]) == minhash_join.keys(y[None])).any()
        docs += [(len(docs) + k, t) for k, t in enumerate(pair)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(df, percent).collect()}
    assert got == near_duplicate_components(docs, percent)[0] == {0: 0, 1: 0, 2: 2, 3: 2}


def test_pairs_confirmed_like_one_by_one():
    r = np.random.default_rng(8)
    for held in (10, 2_000_000):
        for _ in range(20):
            sets = {int(n): np.unique(r.integers(0, 14, r.integers(5, 14)).astype("<u8")) for n in r.integers(-(2**62), 2**62, 12)}
            pairs = [(a, b) for k, a in enumerate(sets) for b in list(sets)[k + 1 :] if r.random() < 0.7]
            want = {p for p in pairs if minhash_join.similar(sets[p[0]], sets[p[1]], 80)}
            with pytest.MonkeyPatch.context() as m:
                m.setattr(minhash_join, "HELD", held)
                a, b = minhash_join.confirm(*(np.array(side) for side in zip(*pairs)), sets, 80)
            got = set(zip(a.tolist(), b.tolist()))
            assert got <= want and parts_of(got, sets) == parts_of(want, sets)


def parts_of(links, nodes):
    part = {n: n for n in nodes}
    for a, b in links:
        part = {n: part[a] if p == part[b] else p for n, p in part.items()}
    return {frozenset(n for n in nodes if part[n] == p) for p in part.values()}


def test_pigeonhole_keys_find_all_signatures_within_the_limit():
    r = np.random.default_rng(1)
    for _ in range(300):
        a = r.integers(0, 2**16, minhash_join.VALUES).astype("<u2")
        b = a.copy()
        at = r.choice(minhash_join.INDEXED, r.integers(0, minhash_join.INDEX_LIMIT + 1), replace=False)
        b[at] += 1
        x, y = minhash_join.keys(np.stack([a, b]))
        assert (x == y).any()


def test_minhash_join_of_edge_documents(spark):
    docs = edge_docs(spark)
    got = sorted(map(tuple, minhash_join.near_duplicates(docs).collect()), key=str)
    by_id = {}
    for i, n, c, k in got:
        by_id.setdefault(i, set()).add((n, c, k))
    assert by_id[0] == {(0, 0, True)} and by_id[1] == {(0, 1, True)} and by_id[2] == {(0, 2, True)}
    assert by_id[5] == {(1, 4, False)} and by_id[6] == {(1, 4, False)} and by_id[4] == {(1, 4, True)}
    assert by_id[3] == {(1, 3, True)} and by_id[None] == {(1, None, True)}
    assert minhash_join.near_duplicates(docs.limit(0)).count() == 0


def test_representatives_keep_one_row_of_each_component(spark):
    words = [f"w{k}" for k in range(60)]
    a, near, other = " ".join(words), " ".join([*words, "more"]), " ".join(reversed(words))
    rows = [(1, a), (1, near), (1, other), (2, a), (3, near), (3, "quite another text of six words"), (4, None), (4, ""), (5, "  "), (None, a), (None, "no id"), (6, other), (6, other)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, own int")
    got = [(r.doc_id, r.text) for r in minhash_join.representatives(docs, 80).collect()]
    # Of id 1, one of the two texts that are near each other stays, and the unrelated one.
    assert len([t for i, t in got if i == 1 and t in (a, near)]) == 1 and (1, other) in got
    assert sorted((g for g in got if g[0] != 1), key=str) == sorted([(3, rows[5][1]), (4, None), (4, ""), (5, "  "), (None, a), (None, "no id")], key=str)


def plain_links(rows, cosine):
    linked = {i: set() for i in range(len(rows))}
    for i, (a, x, k) in enumerate(rows):
        for j, (b, y, m) in enumerate(rows):
            if i != j and None not in (a, b, k, m) and k == m and x and y and len(x) == len(y) and None not in x and None not in y:
                u, v = np.array(x, float), np.array(y, float)
                if np.isfinite(u).all() and np.isfinite(v).all() and u.any() and v.any() and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= cosine:
                    linked[i].add(j)
    out = []
    for i, (a, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in linked[todo.pop()] if j not in seen and not seen.add(j)]
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((a, len(linked[i]), least, least is None or a == least))
    return sorted(out, key=str)


def test_embedding_join_equals_all_pairs(spark, monkeypatch):
    r = np.random.default_rng(2)
    centres = r.normal(size=(6, 8))
    rows = [(k, (centres[k % 6] + r.normal(size=8) * r.choice([0.05, 0.2, 0.5])).tolist(), int(k % 6 < 3)) for k in range(240)]
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(5)] + [(1000, rows[0][1], rows[0][2]), (9, rows[9][1], None), (None, rows[0][1], rows[0][2])]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 8, 1), (2003, [float("nan")] + [1.0] * 7, 1), (2004, [float("inf")] + [1.0] * 7, 1), (2005, [None] + [1.0] * 7, 1), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1), (2008, [1e-200] * 8, 1), (2009, [1e200] * 8, 1)]
    df = spark.createDataFrame([(i, x, k, 1, "x") for i, x, k in rows], "vec_id long, embedding array<double>, label int, links int, node string")
    want = plain_links([row if row[1] != [1e200] * 8 and row[1] != [1e-200] * 8 else (row[0], [1.0] * 8, row[2]) for row in rows], 0.93)
    for block, leaf in ((512, 128), (16, 4)):
        monkeypatch.setattr(embedding_join, "BLOCK", block)
        monkeypatch.setattr(embedding_join, "LEAF", leaf)
        assert sorted(map(tuple, embedding_join.near_duplicates(df).collect()), key=str) == want
    assert embedding_join.near_duplicates(df.limit(0)).count() == 0


def test_grid_skips_only_distant_blocks():
    r = np.random.default_rng(7)
    u = embedding_join._unit(r.normal(size=(300, 3)))
    at = u[:, :2]
    for same in (True, False):
        a, b = embedding_join.join_blocks(u, u if same else u[:100], at, at if same else at[:100], 0.93, same)
        every = u @ (u if same else u[:100]).T >= 0.93
        want = {(i, j) for i, j in zip(*np.nonzero(every)) if not same or i < j}
        assert {(min(p), max(p)) if same else p for p in zip(a.tolist(), b.tolist())} == want


@pytest.mark.parametrize("cosine, directions", [(0.93, 4), (0.8, 2), (0.999, 3), (0.93, 1)])
def test_blocks_meet_by_cells_once_if_near(spark, cosine, directions):
    r = np.random.default_rng(8)
    low = np.clip(r.normal(scale=0.6, size=(120, directions)), -1, 1)
    high = np.minimum(1, low + r.exponential(0.15, size=low.shape) * (r.random(low.shape) < 0.8))
    kind = r.integers(0, 2, 120).tolist()
    rows = [(str(kind[i]), 8 + i % 2, i, low[i].tolist(), high[i].tolist()) for i in range(120)]
    blocks = spark.createDataFrame(rows, "label string, size int, block long, low array<double>, high array<double>")
    gap = np.maximum(0, np.maximum(low[:, None] - high[None], low[None] - high[:, None]))
    near = (gap**2).sum(axis=2) <= 2 - 2 * cosine + 1e-9
    want = [(i, j) for i in range(120) for j in range(i, 120) if near[i, j] and rows[i][:2] == rows[j][:2]]
    pairs = embedding_join.block_pairs(blocks, cosine)
    assert sorted(map(tuple, pairs.collect())) == want and len(want) > 120
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "cell0" in plan


def test_suffix_array_by_groups():
    r = random.Random(3)
    for _ in range(1500):
        a = r.choice([1, 2, 3, 8])
        t = [r.randint(1, a) for _ in range(r.randint(0, 40))] + [0]
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def passages():
    r = random.Random(5)
    base = ["".join(r.choice("abcdé ") for _ in range(r.randint(300, 900))) for _ in range(8)]

    def one():
        t = "".join(r.choice("xyzé\n") for _ in range(r.randint(0, 200)))
        for _ in range(r.randint(0, 3)):
            b = r.choice(base)
            t += b[r.randint(0, 200) : r.randint(len(b) - 200, len(b))] + "".join(r.choice("xyz") for _ in range(r.randint(0, 40)))
        return t

    return [one() for _ in range(80)] + ["a" * 1500, "ab" * 500, "", "a" * 400, "a" * 399, None, base[0], base[0]]


@pytest.mark.parametrize("group", [8192, 3])
def test_repeats_removed_like_counting_every_window(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    texts = passages()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sorted(suffix_dedup.remove_repeats(df).collect())
    assert [tuple(r)[1:] for r in rows] == without_repeats(texts)


@pytest.mark.parametrize("size", [(200, 64), (64, 20)])
def test_repeats_of_other_lengths(spark, size):
    texts = passages()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sorted(suffix_dedup.remove_repeats(df, size=suffix_dedup.Window(*size)).collect())
    assert [tuple(r)[1:] for r in rows] == without_repeats(texts, size[0])


def test_repeats_of_edge_documents(spark):
    docs = edge_docs(spark)
    rows = docs.collect()
    want = sorted(((r.doc_id, *w) for r, w in zip(rows, without_repeats([r.text for r in rows]))), key=str)
    assert sorted(map(tuple, suffix_dedup.remove_repeats(docs).collect()), key=str) == want
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
    kept = suffix_dedup.remove_repeats(docs.where(F.length("text") < 400), keep=("lang", "own"), with_text=True)
    assert kept.columns[1:3] == ["lang", "own"] and {r.kept_text for r in kept.collect()} == {r.text or "" for r in rows if r.text is not None and len(r.text) < 400}
