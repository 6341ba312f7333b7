"""Page-stop rules on random page chains: one Spark job vs a plain sequential read per app."""

import json
import random

import pytest
from pyspark.sql import functions as F

from reviewforge.operators import pages as P
from tests.test_pages import _sequential_read

N_APPS = 1500


def _random_chains(seed: int):
    rnd = random.Random(seed)
    rows = []
    for a in range(N_APPS):
        n = rnd.randint(1, 12)
        for page in range(1, n + 1):
            cursor = "*" if page == 1 else f"c{page - 1}"
            env = {}
            r = rnd.random()
            if r < 0.05:
                env["success"] = rnd.choice([2, 0, None, "1"])
            elif r < 0.07:
                pass  # no success key at all
            else:
                env["success"] = rnd.choice([1, 1, 1, 1.0, True])
            k = rnd.random()
            if k < 0.06:
                env["reviews"] = []
            elif k < 0.08:
                env["reviews"] = None
            elif k > 0.10:
                env["reviews"] = [{"recommendationid": f"{a}-{page}-{i}"} for i in range(rnd.randint(1, 3))]
            c = rnd.random()
            if c < 0.05:
                env["cursor"] = cursor  # repeats the request cursor
            elif c < 0.08:
                env["cursor"] = ""
            elif c > 0.10:
                env["cursor"] = f"c{page}"
            if rnd.random() < 0.04:
                continue  # page not landed: a gap ends the read
            rows.append((f"a{a}", page, cursor, json.dumps(env)))
    return rows


@pytest.mark.parametrize("seed,max_pages,resume_at", [(1, None, None), (2, 4, None), (3, 6, 3)])
def test_random_chains(spark, seed, max_pages, resume_at):
    rows = _random_chains(seed)
    pages = spark.createDataFrame(rows, "app_id string, page int, cursor string, body string").withColumn(
        "fetched_at", F.lit("2024-01-01T00:00:00")
    )
    resume = None
    if resume_at:
        resume = spark.createDataFrame([(f"a{a}", resume_at) for a in range(N_APPS)], "app_id string, resume_page int")
    got = {}
    for r in P.admit_pages(pages, max_pages, resume).select("app_id", "page").collect():
        got.setdefault(r.app_id, []).append(r.page)
    by_app = {}
    for app, page, cursor, body in rows:
        by_app.setdefault(app, []).append((page, cursor, body))
    mism = []
    for app, chain in by_app.items():
        want = _sequential_read(chain, max_pages, start=resume_at or 1)
        if sorted(got.get(app, [])) != want:
            mism.append((app, sorted(got.get(app, [])), want))
    assert not mism, mism[:5]
