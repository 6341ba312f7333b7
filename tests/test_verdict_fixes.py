"""Lossless merge, payload members, salted joins, session checks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from reviewforge.operators import indicators, ingest, pages
from reviewforge.plans import joins
from reviewforge.session import checkpoint_dir

SCHEMA = (
    "app_id string, recommendationid string, review_created_at timestamp_ntz, review_updated_at timestamp_ntz, "
    "record_changed_at timestamp_ntz, bronze_ingested_at timestamp_ntz, bronze_load_id string, bronze_hash_payload string"
)


def _row(app, rid, changed, load, h="h"):
    t = dt.datetime(2020, 1, 1) + dt.timedelta(days=changed)
    return (app, rid, t, t, t, dt.datetime(2021, 1, int(load[1:])), load, h)


def test_upsert_keeps_late_updates_of_old_apps_and_ignores_replays(spark):
    old = spark.createDataFrame([_row("new", "1", 900, "L1"), _row("old", "2", 10, "L1"), _row("old", "3", 10, "L1")], SCHEMA)
    # an update far older than the newest review of another app, a version older than the stored one, a new key twice
    batch = spark.createDataFrame([_row("old", "2", 20, "L2"), _row("old", "3", 5, "L2"), _row("x", "9", 1, "L2"), _row("x", "9", 2, "L2", "i")], SCHEMA)
    once = indicators.incremental_upsert(old, batch)
    got = {(r.app_id, r.recommendationid): (r.bronze_load_id, r.record_changed_at) for r in once.collect()}
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    assert got == {("new", "1"): ("L1", day(900)), ("old", "2"): ("L2", day(20)), ("old", "3"): ("L1", day(10)), ("x", "9"): ("L2", day(2))}
    twice = indicators.incremental_upsert(once, batch)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_completeness_counts_pages_that_never_landed(spark):
    day = dt.date(2024, 2, 1)
    landed = [("a", dt.datetime(2024, 2, 1, 6), json.dumps({"page": n})) for n in (1, 1, 2)]
    ledger = spark.createDataFrame(landed, "appid string, ingested_at timestamp_ntz, payload string")
    expected = spark.createDataFrame([("a", day, 4), ("b", day, 2), ("c", day, 0)], "appid string, day date, pages_expected long")
    got = sorted(map(tuple, indicators.completeness(ledger, expected=expected).collect()))
    assert got == [("a", day, 2, 4, 0.5), ("b", day, 0, 2, 0.0), ("c", day, 0, 0, None)]


def test_reviews_that_carry_lineage_members_and_non_objects(spark):
    reviews = ['{"recommendationid":"1","app_id":"wrong","cursor":null,"n":1}', "42", '{"recommendationid":"2"}', "{}"]
    body = json.dumps({"success": 1, "cursor": "c1"})[:-1] + ',"reviews":[' + ",".join(reviews) + "]}"
    page = spark.createDataFrame([("7", 1, "*", "t", body)], "app_id string, page int, cursor string, fetched_at string, body string")
    run = ingest.ingest(page, page.select("app_id"), dt.datetime(2024, 2, 1), ingest.RunOptions(validate=False))
    landed = [json.loads(r.payload) for r in run.reviews.orderBy("pos").collect()]
    lineage = {"app_id": "7", "page": 1, "cursor": "*", "fetched_at": "t"}
    assert landed == [{"recommendationid": "1", "n": 1, **lineage}, {"recommendationid": "2", **lineage}, lineage]
    assert [r.review for r in run.quarantine.collect()] == ["42"]
    assert run.ledger.where("hash_payload is null").count() == 0


def test_join_beyond_the_broadcast_limit_spreads_a_hot_key(spark):
    big = spark.range(20_000).select(F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), F.col("id").alias("v"))
    small = big.groupBy("k").agg(F.max("v").alias("m"))
    joined = joins.join_per_key(big, small, "k", byte_limit=0)
    want = joins.join_per_key(big, small, "k")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect()))
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = joins.join_per_key(big, small, "k", byte_limit=0).where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(held) > 4 and max(r["count"] for r in held) < 8_000 / 2


def test_a_cluster_needs_a_shared_checkpoint_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
