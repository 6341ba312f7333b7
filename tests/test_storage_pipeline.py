"""Sinks, versioned rebuilds, schema evolution, the gated pipeline and the stream tail."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from reviewforge.operators import indicators as K
from reviewforge.operators import quality as Q
from reviewforge.operators.ingest import RunOptions
from reviewforge.operators import semantic as SEM
from reviewforge.params import DecayParams
from reviewforge.plans.pipeline import Paths, build_models, register_views, run_ingest
from reviewforge.sources import fixtures
from reviewforge.sources import ledger as ST
from reviewforge.streaming.tail import tail_landing
from tests.conftest import SF_SMALL


def test_ledger_create_append_read(spark, scratch):
    path = os.path.join(scratch, "ledger")
    ST.ensure_table(spark, path, ST.LEDGER_SCHEMA, "load_id")
    assert ST.read_ledger(spark, path).count() == 0
    rows = fixtures.review_ledger(spark, SF_SMALL)
    ST.append_ledger(rows, path)
    ST.ensure_table(spark, path, ST.LEDGER_SCHEMA, "load_id")  # no-op when present
    back = ST.read_ledger(spark, path)
    assert back.columns == [f.name for f in ST.LEDGER_SCHEMA.fields]
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0
    assert back.filter(F.col("load_id") == "L2").count() == rows.filter(F.col("load_id") == "L2").count()


def test_versioned_rebuild(spark, scratch):
    base = os.path.join(scratch, "t")
    ST.write_version(spark.range(3), base, "1")
    ST.write_version(ST.read_current(spark, base).filter("id > 0"), base, "2")  # rebuild reads what it replaces
    assert ST.current_version(spark, base) == "2" and ST.read_current(spark, base).count() == 2


def test_schema_evolution_files(spark, scratch):
    path = os.path.join(scratch, "evo")
    spark.range(2).withColumn("a", F.lit("x")).write.parquet(path + "/part=1")
    spark.range(2).withColumn("b", F.lit(1)).write.parquet(path + "/part=2")
    merged = ST.read_merged(spark, path)
    assert set(merged.columns) == {"id", "a", "b", "part"} and merged.count() == 4


def test_pipeline_end_to_end(spark, scratch):
    paths = Paths(scratch)
    pg = fixtures.page_envelopes(spark, SF_SMALL)
    req = fixtures.requested_apps(pg)
    run1 = run_ingest(spark, pg, req, paths, dt.datetime(2024, 2, 1, 6), RunOptions(max_pages=2))
    n1 = ST.read_ledger(spark, paths.ledger).count()
    assert n1 == run1.ledger.count() > 0
    run_ingest(spark, pg, req, paths, dt.datetime(2024, 2, 2, 6), RunOptions(max_pages=4), resume=True)
    n2 = ST.read_ledger(spark, paths.ledger).count()
    # re-running the second run (same load id) after a failure replaces it, not duplicates it
    wm_before = ST.read_watermarks(spark, paths.watermarks).filter(F.col("load_id") == "20240202T060000")
    resume_rows = wm_before.count()
    run_ingest(spark, pg, req, paths, dt.datetime(2024, 2, 2, 6), RunOptions(max_pages=4), resume=False)
    assert ST.read_watermarks(spark, paths.watermarks).filter(F.col("load_id") == "20240202T060000").count() == resume_rows
    run_ingest(spark, pg, req, paths, dt.datetime(2024, 2, 2, 6), RunOptions(max_pages=4), resume=True)
    led = ST.read_ledger(spark, paths.ledger)
    assert led.count() == n2
    assert led.select("load_id").distinct().count() == 2
    # the resumed run re-reads the last page of run 1 (same reviews, new fetch metadata)
    assert led.groupBy("appid", "recommendationid").count().filter("count > 1").count() > 0
    wm = ST.read_watermarks(spark, paths.watermarks)
    assert wm.count() == 2 * req.count()
    fresh = {r.appid: r.lag_minutes for r in K.freshness(wm, "2024-02-02 07:00:00", "recorded_at").collect()}
    assert len(fresh) == req.count() and all(v == 60.0 for v in fresh.values())
    landed = ST.read_landing(spark, paths.landing)
    assert landed.count() == led.count() and set(landed.columns) == {"payload", "app_id", "load_id"}
    out = build_models(spark, paths, DecayParams().with_as_of("2024-02-01"), version="t1")
    gold = out["gold"]
    assert gold.count() == led.select("appid").distinct().count()
    assert Q.run_checks({"fct_steam_review_metrics_adaptive": gold}).filter("failures > 0").count() == 0
    assert ST.current_version(spark, paths.gold) == "t1"
    m = SEM.query_metrics(gold, ["avg_rating", "total_reviews"], ["metric_time__month"]).collect()
    assert len(m) == 1 and m[0].total_reviews > 0
    register_views(spark, paths)
    n = spark.sql("select count(*) from fct_steam_review_metrics_adaptive where avg_rating between 0 and 1").first()[0]
    assert n == gold.count()
    assert spark.sql("select count(*) from steam_reviews_raw_compacted").first()[0] == out["compacted"].count()


def test_page_envelope_files_roundtrip(spark, scratch):
    pg = fixtures.page_envelopes(spark, SF_SMALL)
    path = os.path.join(scratch, "pages")
    ST.write_page_envelopes(pg, path)
    back = ST.read_page_envelopes(spark, path)
    assert back.columns == pg.columns
    assert back.exceptAll(pg).count() == 0 and pg.exceptAll(back).count() == 0


def test_stream_tail_is_replay_safe(spark, scratch):
    paths = Paths(scratch)
    pg = fixtures.page_envelopes(spark, SF_SMALL)
    run_ingest(spark, pg, fixtures.requested_apps(pg), paths, dt.datetime(2024, 2, 1, 6))
    out = os.path.join(scratch, "stream_ledger")
    ckpt = os.path.join(scratch, "stream_ckpt")
    wm_path = os.path.join(scratch, "stream_wm")
    q = tail_landing(spark, paths.landing, out, ckpt, watermarks_path=wm_path)
    q.awaitTermination(180)
    got = ST.read_ledger(spark, out)
    expected = ST.read_ledger(spark, paths.ledger)
    assert got.count() == expected.count()
    wm = ST.read_watermarks(spark, wm_path)
    assert wm.select("appid").distinct().count() == got.select("appid").distinct().count()
    assert wm.filter(F.col("cursor").isNull()).count() == 0
    assert got.select("hash_payload").exceptAll(expected.select("hash_payload")).count() == 0
    q2 = tail_landing(spark, paths.landing, out, ckpt)  # nothing new: no duplicates
    q2.awaitTermination(180)
    assert ST.read_ledger(spark, out).count() == expected.count()


def test_semantic_errors(spark):
    g = spark.createDataFrame([("a", dt.datetime(2024, 1, 5), 0.5, 10)],
                              "app_id string, snapshot_date timestamp_ntz, avg_rating double, total_reviews long")
    with pytest.raises(KeyError):
        SEM.query_metrics(g, ["nope"])
    with pytest.raises(KeyError):
        SEM.query_metrics(g, ["avg_rating"], ["region"])
    with pytest.raises(ValueError):
        SEM.query_metrics(g, ["avg_rating"], ["app_id__month"])
    r = SEM.query_metrics(g, ["avg_rating"], ["snapshot_date__year"], where=F.col("app_id") == "a").first()
    assert r.snapshot_date__year == dt.datetime(2024, 1, 1)
