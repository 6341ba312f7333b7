"""Late materialization, bucketed merges and checks that run inside the write."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from reviewforge.operators import compaction as C
from reviewforge.operators import enrich, quality
from reviewforge.plans import pipeline
from reviewforge.sources import buckets as B
from reviewforge.sources import fixtures
from reviewforge.sources import ledger as ST
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ledger"))
    ST.ensure_table(spark, path, ST.LEDGER_SCHEMA, "load_id")
    # Defects: copies, other apps, repeats within a load, missing hashes and keys.
    ST.append_ledger(fixtures.ledger_with_defects(fixtures.review_ledger(spark, SF_SMALL)), path)
    return ST.ledger_files(spark, path)


@pytest.mark.parametrize("limit", [C.BROADCAST_BYTE_LIMIT, 200_000, 0])
def test_late_materialization_equals_the_window(spark, stored, limit):
    want = C.compact_latest(stored)
    got = C.compact_stored(stored, byte_limit=limit)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_payload_is_shuffled_for_the_window(spark, stored):
    # Payloads are read by the last scan only; with few superseded rows nothing is shuffled there.
    got = C.compact_stored(stored)
    assert "LeftAnti" in _plan(got) and "hashpartitioning" not in _plan(got)
    assert "SortMergeJoin" not in _plan(C.compact_stored(stored, byte_limit=0))
    assert C.compact_stored(stored.filter("false")).count() == 0


def _silver(spark, ids, load, day, vote=True):
    rows = [("7", str(i), dt.datetime(2024, 1, day), dt.datetime(2024, 1, day), load, f"h{i}-{load}", "*", '{"timestamp_created": 5, "voted_up": %s}' % str(vote).lower()) for i in ids]
    return enrich.enrich(spark.createDataFrame(rows, ST.LEDGER_SCHEMA))


def test_a_merge_writes_only_touched_buckets(spark, scratch):
    base = os.path.join(scratch, "silver")
    assert len(B.merge_buckets(_silver(spark, range(400), "a", 1), base, "v1", buckets=16)) == 16
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{base}/data/v=v1/*/*.parquet")}
    batch = _silver(spark, [3, 4], "b", 2, vote=False).unionByName(_silver(spark, [1000], "b", 2))
    touched = B.merge_buckets(batch, base, "v2", buckets=16)
    assert 1 <= len(touched) <= 3
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{base}/data/v=v1/*/*.parquet")} == files  # nothing rewritten
    new = {int(os.path.basename(os.path.dirname(f)).split("=")[1]) for f in glob.glob(f"{base}/data/v=v2/*/*.parquet")}
    assert new == touched
    held = B.manifest(spark, base)
    assert {b for b, v in held.items() if v == "v2"} == touched and len(held) == 16
    rows = {r.recommendationid: r.voted_up for r in B.read_buckets(spark, base).collect()}
    assert len(rows) == 401 and [i for i, v in rows.items() if not v] and {i for i, v in rows.items() if not v} == {"3", "4"}
    # An older version and an empty batch.
    assert B.read_buckets(spark, base, version="v1").count() == 400
    assert B.merge_buckets(batch.limit(0), base, "v3", buckets=16) == set() and B.read_buckets(spark, base).count() == 401
    with pytest.raises(ValueError):
        B.merge_buckets(batch, base, "v3", buckets=16)
    # A late version that is older than the stored one changes nothing; a replay neither.
    B.merge_buckets(_silver(spark, [3], "0", 1), base, "v4", buckets=16)
    B.merge_buckets(batch, base, "v5", buckets=16)
    assert {r.recommendationid: r.voted_up for r in B.read_buckets(spark, base).collect()} == rows


def test_a_writer_lost_before_the_pointer_changes_nothing(spark, scratch, monkeypatch):
    base = os.path.join(scratch, "silver")
    B.merge_buckets(_silver(spark, range(20), "a", 1), base, "v1", buckets=4)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(B, "publish_version", lost)
        with pytest.raises(OSError):
            B.merge_buckets(_silver(spark, range(30), "b", 2), base, "v2", buckets=4)
    assert B.read_buckets(spark, base).count() == 20
    B.merge_buckets(_silver(spark, range(30), "b", 2), base, "v2", buckets=4)  # the same run again
    assert B.read_buckets(spark, base).count() == 30


def test_checks_are_counted_by_the_write(spark, scratch):
    gold = spark.createDataFrame([("a", 0.5, 0.5), (None, 1.5, None), ("b", None, -1.0)], "app_id string, avg_rating double, edp_current double")
    model = "fct_steam_review_metrics_adaptive"
    seen = quality.Observed(model, gold)
    seen.rows.write.parquet(os.path.join(scratch, "gold"))
    want = {(r.column_name, r.test_name): r.failures for r in quality.run_checks({model: gold}).collect() if r.test_name != "unique"}
    assert {(r["column_name"], r["test_name"]): r["failures"] for r in seen.failures()} == want
    base = os.path.join(scratch, "published")
    with pytest.raises(quality.DataQualityError):
        pipeline._publish_checked(spark, gold, base, "v1", model)
    assert ST.current_version(spark, base) is None
    fine = gold.filter("app_id = 'a'")
    pipeline._publish_checked(spark, fine, base, "v2", model)
    assert ST.current_version(spark, base) == "v2"
    with pytest.raises(quality.DataQualityError):
        pipeline._publish_checked(spark, fine.unionByName(fine), base, "v3", model)
    assert ST.current_version(spark, base) == "v2"
