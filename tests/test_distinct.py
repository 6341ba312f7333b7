"""Distinct counts from stored sketches: exact at every size, and only the loads concerned are read."""

import os
import random

import pytest
from pyspark.sql import functions as F

from reviewforge.operators import indicators
from reviewforge.sources import distinct as DI
from reviewforge.sources import ledger as ST

TINY = DI.SketchSize(buckets=3, lg_k=4)
WIDE = DI.SketchSize(buckets=4, lg_k=8)


def ledger_of(spark, rows):
    """Ledger rows of (load, app, id)."""
    fields = {f.name: f.dataType for f in ST.LEDGER_SCHEMA.fields}
    df = spark.createDataFrame(rows, "load_id string, appid string, recommendationid string")
    return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in fields.items()])


def random_rows(seed, conflicts):
    r = random.Random(seed)
    rows = []
    for load, n in (("a", 12), ("b", 900), ("c", 40), ("d", 1)):
        for _ in range(n):
            i = r.randrange(400)
            app = r.choice([None, "", "1", "12", "123"]) if r.random() < conflicts else str(i % 7)
            rows.append((load, app, None if r.random() < 0.05 else "" if i == 3 else str(i)))
    return rows


def by_hand(rows):
    loads = {}
    for load, app, i in rows:
        loads.setdefault(load, []).append((app, i))
    rates = {(load, len(k), len(set(k))) for load, k in loads.items()}
    apps = {}
    for _, app, i in rows:
        if i is not None:
            apps.setdefault(i, set()).add(app)
    return rates, sum(len(a) > 1 for a in apps.values())


@pytest.mark.parametrize("seed, conflicts, size", [(1, 0.0, TINY), (2, 0.02, TINY), (3, 0.3, TINY), (4, 0.0, WIDE), (5, 0.01, WIDE), (6, 0.3, WIDE)])
def test_equal_to_the_exact_counts(spark, scratch, seed, conflicts, size):
    rows = random_rows(seed, conflicts)
    ledger = ledger_of(spark, rows)
    for load in "abcd":  # a load at a time, and one again
        DI.record_loads(ledger.where(F.col("load_id") == load), scratch, size)
    DI.record_loads(ledger.where("load_id = 'c'"), scratch, size)
    sketches = DI.read_sketches(spark, scratch)
    rates, failures = by_hand(rows)
    got = DI.dup_rate(sketches, ledger, size)
    assert {(r.load_id, r.rows, r.distinct_keys) for r in got.collect()} == rates
    assert got.exceptAll(indicators.dup_rate(ledger)).count() == 0
    unsure = DI.unsure_loads(sketches, size)
    assert ("b" in unsure and "d" not in unsure) if size is TINY else not unsure
    assert [r.failures for r in DI.repeated_ids(sketches, ledger, size).collect()] == [failures]


def with_unreadable(spark, path, ledger, readable):
    """The ledger stored with a file that is no Parquet in the folders of all other loads."""
    ST.append_ledger(ledger.where(F.col("load_id").isin(readable)), path)
    for r in ledger.where(~F.col("load_id").isin(readable)).select("load_id").distinct().collect():
        os.makedirs(f"{path}/load_id={r.load_id}")
        with open(f"{path}/load_id={r.load_id}/part-0.parquet", "w") as f:
            f.write("not to be read")
    return ST.read_ledger(spark, path)


def test_only_loads_beyond_the_bound_are_read(spark, tmp_path):
    ledger = ledger_of(spark, random_rows(7, 0.1))
    DI.record_loads(ledger, str(tmp_path / "s"), TINY)
    sketches = DI.read_sketches(spark, str(tmp_path / "s"))
    stored = with_unreadable(spark, str(tmp_path / "l"), ledger, ["b"])
    got = DI.dup_rate(sketches, stored, TINY)
    assert got.exceptAll(indicators.dup_rate(ledger)).count() == 0 and got.count() == 4
    with pytest.raises(Exception):
        indicators.dup_rate(stored).collect()


def test_only_suspect_loads_are_read(spark, tmp_path):
    # one id under two apps, in two loads; the rows of the third lie in other buckets
    buckets = spark.createDataFrame([(str(i),) for i in range(60)], "recommendationid string").select("recommendationid", DI._bucket(WIDE).alias("b")).collect()
    inside = [r.recommendationid for r in buckets if r.b == 1]
    outside = [r.recommendationid for r in buckets if r.b != 1]
    rows = [("a", "1", inside[0]), ("b", "2", inside[0]), ("b", "2", outside[0]), *[("c", "5", i) for i in outside[1:]]]
    ledger = ledger_of(spark, rows)
    DI.record_loads(ledger, str(tmp_path / "s"), WIDE)
    sketches = DI.read_sketches(spark, str(tmp_path / "s"))
    assert DI.suspects(sketches, WIDE) == ([1], ["a", "b"])
    stored = with_unreadable(spark, str(tmp_path / "l"), ledger, ["a", "b"])
    assert DI.repeated_ids(sketches, stored, WIDE).collect()[0].failures == 1


def test_no_load_and_loads_without_ids(spark, tmp_path):
    ledger = ledger_of(spark, [("a", None, None), ("a", "1", None), ("a", "1", None)])
    none = ledger.limit(0)
    for name, rows, rates in (("n", none, []), ("a", ledger, [("a", 3, 2)])):
        path = str(tmp_path / name)
        DI.record_loads(ledger, path)
        sketches = DI.read_sketches(spark, path).where(F.lit(bool(rates)))
        assert [(r.load_id, r.rows, r.distinct_keys) for r in DI.dup_rate(sketches, rows).collect()] == rates
        assert DI.repeated_ids(sketches, rows).collect()[0].failures == 0
