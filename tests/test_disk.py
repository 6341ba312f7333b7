"""What stays on disk while a query runs: no shuffle files of finished writes, no second deal of rows that lie in buckets."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from reviewforge import session as S
from reviewforge.operators import compaction as C
from reviewforge.operators import enrich
from reviewforge.sources import buckets as B
from reviewforge.sources import fixtures
from tests.conftest import SF_SMALL


def _equal(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before, before = spark.conf.get(key, None), _shuffle_files(spark)
    table = S.written(spark.range(100_000).repartition(4, "id"), "numbers")
    assert _shuffle_files(spark) <= before and spark.conf.get(key, None) == set_before
    assert table.count() == 100_000


def _loads(spark):
    raw = fixtures.review_ledger(spark, SF_SMALL).dropDuplicates(["appid", "recommendationid", "load_id"])
    raw = S.written(raw, "ledger")
    return raw, [enrich.enrich(raw.filter(F.col("load_id") == load)) for load in ("L1", "L2")]


@pytest.mark.parametrize("file_rows", [0, 10**9])
def test_rows_in_buckets_are_not_dealt_again(spark, scratch, monkeypatch, file_rows):
    raw, (first, second) = _loads(spark)
    base, plans, write = os.path.join(scratch, "silver"), [], B._write_buckets

    def watched(rows, path):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        plans.append((bool(re.search("(?<!Broadcast)Exchange", plan)), path[len(base):]))
        write(rows, path)

    monkeypatch.setattr(B, "_write_buckets", watched)
    monkeypatch.setattr(B, "FILE_ROWS", file_rows)
    B.merge_buckets(first, base, "v1", buckets=4)
    assert plans == [(True, "/data/v=v1")]  # the batch is the version
    B.merge_buckets(second, base, "v2", buckets=4)
    assert plans[1:] == [(True, "/batch/v=v2"), (file_rows > 0, "/data/v=v2")]
    assert sum(os.path.getsize(f) for f in glob.glob(f"{base}/batch/*/**/*.parquet", recursive=True)) < 20_000  # emptied
    _equal(B.read_buckets(spark, base), enrich.enrich(C.compact_latest(raw)))
    _equal(B.read_buckets(spark, base, version="v1"), first)
    for r in B.read_buckets(spark, base).select(B.bucket_of(("app_id", "recommendationid"), 4), "_metadata.file_path").distinct().collect():
        assert f"bucket={r[0]}/" in r[1]


def test_a_first_batch_may_repeat_keys(spark, scratch):
    raw = S.written(fixtures.ledger_with_defects(fixtures.review_ledger(spark, SF_SMALL)), "ledger")
    base = os.path.join(scratch, "silver")
    B.merge_buckets(enrich.enrich(raw), base, "v1", buckets=4)
    _equal(B.read_buckets(spark, base), enrich.enrich(C.compact_latest(raw)))


def test_a_refresh_follows_batches_that_are_dealt_once(spark, scratch, monkeypatch):
    from reviewforge.operators.metrics import adaptive_metrics
    from reviewforge.plans import queries as Q
    from reviewforge.plans import refresh as R

    raw, loads = _loads(spark)
    silver, gold, targets, write = os.path.join(scratch, "silver"), os.path.join(scratch, "gold"), [], B._write_buckets
    monkeypatch.setattr(B, "_write_buckets", lambda rows, path: (targets.append(path[len(silver):]), write(rows, path)))
    before = _shuffle_files(spark)
    for version, batch in zip(("v1", "v2"), loads):
        B.merge_buckets(batch, silver, version, bucket_by=R.APP_BUCKETS)
        done = R.refresh_gold(spark, silver, gold, version, Q.BASE_PARAMS)
    assert targets == ["/data/v=v1", "/batch/v=v2", "/data/v=v2"]
    # what is left are shuffles of counts and sizes
    assert sum(os.path.getsize(f) for f in _shuffle_files(spark) - before) < 100_000
    whole = adaptive_metrics(enrich.enrich(C.compact_latest(raw)), Q.BASE_PARAMS)
    _equal(Q.round_doubles(done.gold), Q.round_doubles(whole.select(*done.gold.columns)))


def _watch_tables(monkeypatch):
    """(name, rows) of the tables that compaction writes."""
    tables, write = [], C.written

    def watched(df, name):
        tables.append((name, write(df, name)))
        return tables[-1][1]

    monkeypatch.setattr(C, "written", watched)
    return tables


@pytest.mark.parametrize("limit", [C.BROADCAST_BYTE_LIMIT, 900, 16, 0])
def test_only_versions_of_repeated_keys_are_written(spark, monkeypatch, limit):
    raw = fixtures.ledger_with_defects(fixtures.review_ledger(spark, SF_SMALL))
    want, rows = C.version_history(raw), raw.count()
    tables = _watch_tables(monkeypatch)
    _equal(C.compact_derived(raw, C.VERSION_KEY, limit), want)
    stored = [t.count() for name, t in tables if name == "ledger"][0]
    several = raw.groupBy(*C.VERSION_KEY).count().filter("count > 1").agg(F.sum("count")).first()[0]
    assert several <= stored and (stored < rows / 2 if limit == C.BROADCAST_BYTE_LIMIT else stored <= rows)


def test_defects_come_from_one_pass(spark):
    plan = fixtures.ledger_with_defects(fixtures.review_ledger(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 2  # one scan a load


def test_rows_with_one_version_are_not_written(spark, monkeypatch):
    raw = fixtures.review_ledger(spark, SF_SMALL)
    first = raw.filter(F.col("load_id") == "L1")
    want, latest = C.compact_latest(first), C.compact_latest(raw)
    tables = _watch_tables(monkeypatch)
    _equal(C.compact_derived(first), want)
    assert sum(t.count() for name, t in tables if name == "ledger") < 20  # one key occurs twice in this table
    tables.clear()
    _equal(C.compact_derived(raw), latest)
    assert sum(t.count() for name, t in tables if name == "ledger") < 0.6 * raw.count()  # 44 % have another version


def test_the_upsert_of_two_loads_stores_no_ledger(spark, monkeypatch):
    from reviewforge.plans import queries as Q

    tables = _watch_tables(monkeypatch)
    got = Q.QUERIES["incremental_upsert"](spark, SF_SMALL)
    assert sum(t.count() for name, t in tables if name == "ledger") < 20
    _equal(got, Q.round_doubles(enrich.enrich(C.compact_latest(fixtures.review_ledger(spark, SF_SMALL)))))


def test_checks_leave_no_shuffles_of_rows(spark):
    from reviewforge.plans import queries as Q

    before = _shuffle_files(spark)
    failures = {(r.model, r.column_name): r.failures for r in Q.QUERIES["dq_not_null"](spark, SF_SMALL).collect()}
    assert len(failures) == 9 and failures["steam_reviews_raw", "recommendationid"] > 0
    assert sum(os.path.getsize(f) for f in _shuffle_files(spark) - before) < 100_000
