"""What the review engine shuffles and stores: no payloads where few columns are wanted, and the same rows."""

import datetime as dt
import json
import re

from pyspark.sql import functions as F

from reviewforge.operators import compaction as C
from reviewforge.operators import enrich, metrics
from reviewforge.plans import queries as Q
from reviewforge.sources import fixtures
from reviewforge.sources import ledger as ST
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _equal(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_gold_columns_are_compacted_without_payloads(spark):
    raw = fixtures.ledger_with_defects(fixtures.review_ledger(spark, SF_SMALL))
    got = C.compact_columns(enrich.enrich_votes(raw), metrics.GOLD_INPUT_COLUMNS)
    _equal(got, enrich.enrich(C.compact_latest(raw)).select(*metrics.GOLD_INPUT_COLUMNS))
    plan = C.compact_columns(enrich.enrich_votes(raw), metrics.GOLD_INPUT_COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and not re.search("(?<!hash_)payload", plan.split("RepartitionByExpression")[0])


def test_narrow_silver_holds_gold_columns_only(spark):
    silver = Q.narrow_silver(Q.ledger(spark, SF_SMALL))
    assert silver.columns == metrics.GOLD_INPUT_COLUMNS
    assert silver.inputFiles()  # a table, not a checkpoint of rows


def test_ties_are_settled_by_the_hash_text(spark):
    at = dt.datetime(2024, 1, 1)
    hashes = ["0a", "0A", "ff", "zz", "", None, "0", "f", "é", "00" * 32, "ff" * 32, "9" * 64, "a" * 63]
    pairs = [(a, b) for a in hashes for b in hashes]
    rows = [(str(n), "r", at, at, "L", h, "*", json.dumps({"voted_up": True, "timestamp_created": i}))
            for n, pair in enumerate(pairs) for i, h in enumerate(pair) if i == 0 or pair[0] != pair[1]]
    raw = spark.createDataFrame(rows, ST.LEDGER_SCHEMA)
    _equal(C.compact_columns(raw, C.LEDGER_COLUMNS), C.compact_latest(raw))


def test_counts_in_odd_texts(spark):
    from reviewforge.functions.casts import text_to_double, text_to_int

    texts = ["12", "007", "1234567890", "999999999", "2147483648", " 5", "5 ", "+5", "-5", "3.7", "2.5", "1e3", "1f", "1d ", "1e3D", ".5f", "Infinity", "NaN", "x", "", None, "1\n", "٣"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    old = r"^\s*[+-]?[0-9]*\.?[0-9]+([eE][+-]?[0-9]+)?[dDfF]\s*$"
    double = F.when(F.col("t").rlike(old), F.lit(None).cast("double")).otherwise(F.col("t").try_cast("double"))
    for r in df.select(text_to_double("t").alias("a"), double.alias("b"), text_to_int("t").alias("c"), F.round(double).try_cast("int").alias("d")).collect():
        assert str(r.a) == str(r.b) and r.c == r.d


def _stored(spark, rows, path):
    ST.append_ledger(rows, path)
    return ST.ledger_files(spark, path)


def test_a_ledger_is_appended_without_a_shuffle(spark, scratch, monkeypatch):
    plans = []
    monkeypatch.setattr(ST, "_write_runs", lambda df, *a, **k: plans.append(_plan(df)))
    ST.append_ledger(fixtures.review_ledger(spark, SF_SMALL), scratch)
    assert "Exchange" not in plans[0]


def test_ledger_files_are_small_and_settings_restored(spark, scratch):
    import glob

    before = {k: spark.conf.get(k, None) for k in (ST._OPEN_FILES, ST._PLANNED)}
    raw = fixtures.review_ledger(spark, SF_SMALL)
    stored = _stored(spark, raw, scratch)
    assert {k: spark.conf.get(k, None) for k in before} == before
    files = glob.glob(f"{scratch}/*/*.parquet")
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    _equal(ST.read_ledger(spark, scratch), raw.select(*C.LEDGER_COLUMNS))
    assert stored.select("load_id").distinct().count() == 2


def test_bitmaps_stand_in_for_locators(spark, scratch):
    raw = fixtures.ledger_with_defects(fixtures.review_ledger(spark, SF_SMALL))
    stored = _stored(spark, raw, scratch)
    locators = C._superseded(stored, ("appid", "recommendationid"), C.BROADCAST_BYTE_LIMIT)
    size = C.measured_bytes(C._bitmaps(locators))
    assert size < C.measured_bytes(locators)  # 33 KB a file
    got = C.compact_stored(stored, byte_limit=size)
    assert "BroadcastHashJoin" in _plan(got) and "_bits" in _plan(got) and "Exchange hash" not in _plan(got)
    _equal(got, C.compact_latest(raw))
    by_hash = ("appid", "recommendationid", "hash_payload")
    _equal(C.compact_stored(stored, by_hash, byte_limit=size), C.version_history(raw))
    _equal(C.compact_stored(stored, by_hash), C.version_history(raw))


def test_stored_ties_are_settled_by_the_hash(spark, scratch):
    at = dt.datetime(2024, 1, 1)
    hashes = ["0a", "0A", "zz", "", None, "00" * 32, "ff" * 32]
    rows = [(f"{i}-{j}", "r", at, at, "L", h, "*", "{}") for i, a in enumerate(hashes) for j, b in enumerate(hashes) for h in {a, b}]
    raw = spark.createDataFrame(rows, ST.LEDGER_SCHEMA).unionByName(
        spark.createDataFrame([(None, None, at, at, "L", h, "*", "{}") for h in ("a", "b")], ST.LEDGER_SCHEMA))
    for limit in (C.BROADCAST_BYTE_LIMIT, 0):
        _equal(C.compact_stored(_stored(spark, raw, scratch), byte_limit=limit), C.compact_latest(raw))


def test_a_merge_of_stored_tables_equals_the_join(spark, scratch):
    import os

    from reviewforge.operators import indicators as K

    silver = enrich.enrich(fixtures.ledger_with_defects(fixtures.review_ledger(spark, SF_SMALL)))
    keyed = silver.filter("app_id is not null and recommendationid is not null")
    old = keyed.filter("bronze_load_id = 'L1'").dropDuplicates(["app_id", "recommendationid"])
    nulls = silver.filter("recommendationid is null")
    old = old.unionByName(nulls).unionByName(nulls)
    new = silver.filter("bronze_load_id <> 'L1'").unionByName(old.limit(50))  # some replayed
    old.write.parquet(os.path.join(scratch, "old"))
    new.write.parquet(os.path.join(scratch, "new"))
    old, new = (spark.read.parquet(os.path.join(scratch, x)) for x in ("old", "new"))
    got = K.incremental_upsert(old, new)
    assert "FullOuter" not in _plan(got)
    local = [spark.createDataFrame(x.collect(), x.schema) for x in (old, new)]
    want = K.incremental_upsert(*local)
    assert "FullOuter" in _plan(want)
    _equal(got, want)

