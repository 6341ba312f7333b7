"""Cast rules against hand-worked cases and against DuckDB's try_cast."""

import datetime as dt
import random

import duckdb
from pyspark.sql import functions as F

from reviewforge.functions import casts as C


def _one(spark, texts, fn):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(fn(F.col("t"))).collect()]


def test_text_to_int_hand_cases(spark):
    got = _one(spark, ["3.7", "2.5", "-3.2", "1e3", "99999999999", "abc", None, "7"], C.text_to_int)
    assert got == [4, 3, -3, 1000, None, None, None, 7]


def test_text_to_double_rejects_type_suffix(spark):
    assert _one(spark, ["1f", "1d", "2.5", "x", "1e2"], C.text_to_double) == [None, None, 2.5, None, 100.0]


def test_text_to_bool(spark):
    got = _one(spark, ["yes", "0", "on", " true ", "t", "false", "1"], C.text_to_bool)
    assert got == [True, False, None, None, True, False, True]


def test_epoch_and_days(spark):
    df = spark.createDataFrame([(0.0,), (86400.5,), (1e30,), (None,)], "e double")
    got = [r[0] for r in df.select(C.epoch_to_timestamp("e")).collect()]
    assert got[0] == dt.datetime(1970, 1, 1)
    assert got[1] == dt.datetime(1970, 1, 2, 0, 0, 0, 500000)
    assert got[2] is None and got[3] is None
    row = spark.sql(
        "select timestamp_ntz'2024-01-01 00:00:00' a, timestamp_ntz'2024-01-02 12:00:00' b"
    ).select(C.days_between("a", "b").alias("d"), C.day_start("b").alias("s")).first()
    assert row.d == 1.5 and row.s == dt.datetime(2024, 1, 2)


def _random_numeric_texts(n=300, seed=7):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        k = rnd.randrange(6)
        if k == 0:
            out.append(str(rnd.randint(-10**6, 10**6)))
        elif k == 1:
            out.append(f"{rnd.uniform(-1000, 1000):.{rnd.randrange(1, 4)}f}")
        elif k == 2:
            out.append(f"{rnd.randint(1, 9)}e{rnd.randint(0, 12)}")
        elif k == 3:
            out.append(str(rnd.randint(2**31 - 5, 2**31 + 5)))
        elif k == 4:
            out.append(rnd.choice(["", "abc", "1.2.3", "--1", "+5", " 42", "1f", "0.5"]))
        else:
            out.append(f"{rnd.randint(0, 5)}.5")
    return out


def test_text_to_int_matches_duckdb(spark):
    texts = _random_numeric_texts()
    ours = _one(spark, texts, C.text_to_int)
    con = duckdb.connect()
    theirs = [con.execute("select try_cast(? as integer)", [t]).fetchone()[0] for t in texts]
    mism = [(t, a, b) for t, a, b in zip(texts, ours, theirs) if a != b]
    assert not mism, mism[:10]


def test_text_to_double_matches_duckdb(spark):
    texts = _random_numeric_texts(seed=11)
    ours = _one(spark, texts, C.text_to_double)
    con = duckdb.connect()
    theirs = [con.execute("select try_cast(? as double)", [t]).fetchone()[0] for t in texts]
    mism = [(t, a, b) for t, a, b in zip(texts, ours, theirs) if a != b]
    assert not mism, mism[:10]
