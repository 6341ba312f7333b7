"""Gold refreshed for touched apps against gold built in full."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from reviewforge.operators import enrich
from reviewforge.operators.metrics import adaptive_metrics
from reviewforge.params import DecayParams
from reviewforge.plans import refresh as R
from reviewforge.sources import buckets as B
from reviewforge.sources import ledger as ST

PARAMS = DecayParams().with_as_of("2024-06-30")
BUCKETS = 8


def _silver(spark, reviews, load, day):
    """reviews: (app, id, created day of 2024, vote)."""
    at = dt.datetime(2024, 7, day)
    rows = [
        (app, str(rid), at, at, load, f"{rid}-{load}", "*",
         '{"timestamp_created": %d, "voted_up": %s}' % (1704067200 + 86400 * on, str(vote).lower()))
        for app, rid, on, vote in reviews
    ]
    return enrich.enrich(spark.createDataFrame(rows, ST.LEDGER_SCHEMA))


def _rows(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in df.collect())


def _merge(spark, base, batch, version):
    return B.merge_buckets(batch, base, version, buckets=BUCKETS, bucket_by=R.APP_BUCKETS)


def test_refresh_equals_a_full_build(spark, scratch):
    r = random.Random(4)
    silver, gold = os.path.join(scratch, "silver"), os.path.join(scratch, "gold")
    # app "hot" holds a third
    first = [(r.choice(["hot"] * 10 + [f"a{i}" for i in range(20)]), i, r.randrange(180), r.random() < 0.6) for i in range(600)]
    _merge(spark, silver, _silver(spark, first, "1", 1), "v1")
    done = R.refresh_gold(spark, silver, gold, "g1", PARAMS)
    assert done.full
    batches = [
        [("a3", 9001, 10, True), ("new", 9002, 20, False)],
        [("hot", 9003, 5, False)] + [(a, i, d, not v) for a, i, d, v in first if a == "a7"],
        [(a, i, d, v) for a, i, d, v in first if a == "a5"],  # newer versions of the same content
    ]
    for n, batch in enumerate(batches, 2):
        touched = _merge(spark, silver, _silver(spark, batch, str(n), n), f"v{n}")
        done = R.refresh_gold(spark, silver, gold, f"g{n}", PARAMS)
        assert not done.full and done.read == touched and len(touched) < BUCKETS
        assert _rows(done.gold) == _rows(adaptive_metrics(B.read_buckets(spark, silver), PARAMS))
        assert _rows(ST.read_current(spark, gold)) == _rows(done.gold)
        files = [f for f in B.read_buckets(spark, silver, only=set(done.read)).inputFiles()]
        assert {int(f.split("bucket=")[1].split("/")[0]) for f in files} <= touched
    # nothing new: no bucket is read
    again = R.refresh_gold(spark, silver, gold, "g9", PARAMS)
    assert again.read == frozenset() and _rows(again.gold) == _rows(done.gold)
    # two merges between two refreshes; then other parameters
    _merge(spark, silver, _silver(spark, [("a1", 9100, 1, True)], "8", 8), "v8")
    _merge(spark, silver, _silver(spark, [("a2", 9101, 2, True)], "9", 9), "v9")
    done = R.refresh_gold(spark, silver, gold, "g10", PARAMS)
    assert _rows(done.gold) == _rows(adaptive_metrics(B.read_buckets(spark, silver), PARAMS))
    later = PARAMS.with_as_of("2024-12-31")
    done = R.refresh_gold(spark, silver, gold, "g11", later)
    assert done.full and _rows(done.gold) == _rows(adaptive_metrics(B.read_buckets(spark, silver), later))


def test_touched_apps(spark):
    old = _silver(spark, [("a", 1, 1, True), ("b", 2, 1, True), ("c", 3, 1, True), ("d", 4, 1, True)], "1", 1)
    new = _silver(spark, [("a", 1, 1, True), ("b", 2, 1, False), ("e", 5, 1, True), ("d", 4, 1, True), ("d", 4, 1, True)], "1", 1)
    assert {x[0] for x in R.touched_apps(old, new).collect()} == {"b", "c", "d", "e"}
    deleted = old.withColumn("is_deleted", F.col("app_id") == "a")
    assert [x[0] for x in R.touched_apps(old, deleted).collect()] == ["a"]
    moved = old.withColumn("review_updated_at", F.when(F.col("app_id") != "c", F.col("review_updated_at")))
    assert [x[0] for x in R.touched_apps(old, moved).collect()] == ["c"]  # a time that became null
    assert R.touched_apps(old, old).isEmpty() and R.touched_apps(old.limit(0), old.limit(0)).isEmpty()
    unnamed = old.withColumn("app_id", F.lit(None).cast("string"))
    assert R.touched_apps(old.limit(0), unnamed).isEmpty()


def test_what_a_refresh_refuses(spark, scratch):
    silver, gold = os.path.join(scratch, "s"), os.path.join(scratch, "g")
    with pytest.raises(ValueError):
        R.refresh_gold(spark, silver, gold, "g1", DecayParams())
    with pytest.raises(FileNotFoundError):
        R.refresh_gold(spark, silver, gold, "g1", PARAMS)
    with pytest.raises(ValueError):
        B.merge_buckets(_silver(spark, [("a", 1, 1, True)], "1", 1), silver, "v1", bucket_by=("review",))
