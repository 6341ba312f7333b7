"""Reads by cursor on random chains with loops, gaps, repeated landings and useless page numbers, against a plain reader."""

import json
import random

import pytest

from reviewforge.operators import cursors as CU

N_APPS = 400


def chains(seed, groups=1):
    rnd = random.Random(seed)
    rows = []
    for run in range(groups):
        for a in range(N_APPS):
            n = rnd.randint(1, 14)
            names = ["*", *(f"c{k}" for k in range(1, n))]
            for k, cursor in enumerate(names):
                if rnd.random() < 0.03:
                    continue  # not landed
                nxt = rnd.choices([f"c{k + 1}", cursor, "", None, rnd.choice(names)], [90, 3, 2, 2, 4])[0]
                env = {"success": rnd.choices([1, 1.0, True, 2, "1"], [80, 5, 5, 2, 1])[0], "reviews": [{"recommendationid": f"{a}-{k}"}] * rnd.choices([1, 0], [96, 4])[0]}
                if nxt is not None:
                    env["cursor"] = nxt
                rows.append((f"r{run}", f"a{a}", rnd.randint(1, 5), cursor, f"2024-01-01T00:00:{rnd.randint(30, 59)}", json.dumps(env)))
                if rnd.random() < 0.1:  # an earlier landing with other contents
                    rows.append((f"r{run}", f"a{a}", 1, cursor, "2024-01-01T00:00:00", json.dumps({"success": 1, "cursor": "c1", "reviews": [{}]})))
    rnd.shuffle(rows)
    return rows


def plain_read(landed, start, first, max_pages):
    """The request loop over one chain: (cursor, page) of the pages that it reads; a cursor asked for before ends it."""
    page, cursor, out, seen = first, start, [], set()
    while cursor in landed and cursor not in seen:
        seen.add(cursor)
        env = json.loads(landed[cursor])
        if env["success"] != 1 or not env["reviews"]:
            break
        out.append((cursor, page))
        nxt = env.get("cursor")
        if not nxt or nxt == cursor:
            break
        cursor, page = nxt, page + 1
        if max_pages is not None and page > max_pages:
            break
    return out


@pytest.mark.parametrize("seed, max_pages, resumed, runs", [(1, None, False, 1), (2, 4, False, 1), (3, 6, True, 1), (4, None, False, 2), (5, 1, False, 1)])
def test_random_chains(spark, seed, max_pages, resumed, runs):
    rows = chains(seed, runs)
    pages = spark.createDataFrame(rows, "run_id string, app_id string, page int, cursor string, fetched_at string, body string")
    groups = ("run_id", "app_id") if runs > 1 else ("app_id",)
    landed = {}
    for run, app, _, cursor, at, body in sorted(rows, key=lambda r: r[4]):
        landed.setdefault((run, app), {})[cursor] = body
    resume, starts = None, {}
    if resumed:
        rnd = random.Random(seed)
        starts = {k: (rnd.choice(["*", "c1", "c3"]), rnd.randint(1, 9)) for k in landed}
        resume = spark.createDataFrame([(k[1], c, p) for k, (c, p) in starts.items()], "app_id string, cursor string, resume_page int")
    got = {}
    for r in CU.admit_linked(pages, max_pages, resume, groups).select("run_id", "app_id", "cursor", "page").collect():
        got.setdefault((r.run_id, r.app_id), []).append((r.cursor, r.page))
    for k, chain in landed.items():
        start, first = starts.get(k, ("*", 1))
        assert sorted(got.get(k, []), key=lambda x: x[1]) == plain_read(chain, start, first, max_pages), k


def test_one_long_chain_and_none(spark):
    n = 1000
    pages = spark.range(n).selectExpr(
        "'a' as app_id", "1 as page", "case when id = 0 then '*' else concat('c', id) end as cursor", "'2024' as fetched_at",
        """concat('{"success":1,"reviews":[{}],"cursor":"c', id + 1, '"}') as body""",
    )
    got = sorted(r.page for r in CU.admit_linked(pages).select("page").collect())
    assert got == list(range(1, n + 1))
    assert CU.admit_linked(pages.filter("false")).count() == 0
    assert CU.admit_linked(pages.filter("cursor <> '*'")).count() == 0
