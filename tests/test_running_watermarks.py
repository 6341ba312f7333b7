"""Watermarks in the stream's state: any cut into micro-batches, and a restart, give the batch operator's rows."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from reviewforge.operators import ingest as ING
from reviewforge.sources import ledger as ST
from reviewforge.streaming.watermarks import app_watermarks, latest_watermarks, stream_watermarks

RUNS = ("20240101T000000", "20240102T000000")


def _reviews(r):
    """(run, app, page, pos, cursor, updated) with empty and missing cursors; one app holds a third."""
    out = []
    for run in RUNS:
        for app in ["hot"] * 6 + [f"a{i}" for i in range(5)] + ["none"]:
            for page in range(1, r.randrange(2, 5)):
                cursor = None if app == "none" else r.choice(["*", "", None, f"{run[6:8]}c{page}"])
                for pos in range(r.randrange(1, 3)):
                    out.append((run, app, page, pos, cursor, r.randrange(1_600_000_000, 1_700_000_000)))
    # a page has one cursor
    first = {}
    return [(*x[:4], first.setdefault(x[:3], x[4]), x[5]) for x in out]


def _land(root, rows, name):
    for run, app, page, _, cursor, updated in rows:
        folder = os.path.join(root, f"app_id={app}", f"load_id={run}")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"part-{name}.txt"), "a") as f:
            f.write(json.dumps({"recommendationid": "1", "page": page, "cursor": cursor, "timestamp_updated": updated}) + "\n")


def _batch_operator(spark, rows):
    """The last run's cursor if it has one, else the run's before; the latest update of both."""
    want = {}
    for run in RUNS:
        data = [
            (app, page, pos, cursor, json.dumps({"recommendationid": "1", "timestamp_updated": updated}))
            for ran, app, page, pos, cursor, updated in rows if ran == run
        ]
        reviews = spark.createDataFrame(data, "app_id string, page int, pos int, cursor string, review string")
        marks = ING.load_watermarks(reviews, reviews.select("app_id").distinct(), run, dt.datetime(2024, 1, 1))
        for x in marks.collect():
            cursor, at = want.get(x["appid"], (None, None))
            want[x["appid"]] = (x["cursor"] or cursor, max(filter(None, (at, x["max_updated_at"])), default=None))
    return want


@pytest.mark.parametrize("seed", [1, 2])
def test_random_cuts_and_a_restart(spark, scratch, seed):
    r = random.Random(seed)
    rows = _reviews(r)
    shuffled = r.sample(rows, len(rows))
    cut = r.randrange(1, len(rows))
    landing, marks, state = (os.path.join(scratch, x) for x in ("landing", "marks", "state"))
    for name, part in (("1", shuffled[:cut]), ("2", shuffled[cut:])):
        _land(landing, part, name)
        # the second start takes up the first one's state
        assert stream_watermarks(spark, landing, marks, state, max_files_per_trigger=9).awaitTermination(180)
    stored = ST.read_watermarks(spark, marks)
    got = {x["appid"]: (x["cursor"], x["max_updated_at"]) for x in latest_watermarks(stored).collect()}
    assert got == _batch_operator(spark, rows)
    assert stored.select("load_id").distinct().count() > 2
    before = stored.count()
    assert stream_watermarks(spark, landing, marks, state).awaitTermination(180)  # nothing new
    assert ST.read_watermarks(spark, marks).count() == before


def test_odd_payloads(spark):
    rows = [("no json", "a", "r"), (None, "a", "r"), ('{"cursor": "c"}', "a", "r"), ("{}", None, "r"), ('{"page": 2, "cursor": 5}', "b", "r")]
    got = app_watermarks(spark.createDataFrame(rows, "payload string, app_id string, load_id string")).collect()
    assert {x["appid"]: (x["cursor"], x["max_updated_at"]) for x in got} == {"a": (None, None), "b": ("5", None)}
    assert app_watermarks(spark.createDataFrame([], "payload string, app_id string, load_id string")).collect() == []
