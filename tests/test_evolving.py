"""Appends that add columns and widen types."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewforge.sources import evolving as EV


def _type(ddl):
    return T.StructType.fromDDL(f"c {ddl}")["c"].dataType


def test_lattice(spark):
    cases = [
        ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("double", "string", "string"), ("int", "string", "string"),
        ("tinyint", "smallint", "smallint"), ("float", "int", "double"), ("float", "double", "double"), ("void", "int", "int"),
        ("boolean", "int", "string"), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "int", "string"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,10)", "double"), ("decimal(5,1)", "int", "double"),
        ("array<int>", "array<int>", "array<int>"), ("array<int>", "string", "string"), ("struct<a:int>", "struct<b:int>", "string"),
    ]
    for a, b, want in cases:
        assert EV.wider(_type(a), _type(b)) == _type(want) == EV.wider(_type(b), _type(a)), (a, b)


def test_rows_survive_widening(spark, scratch):
    base = os.path.join(scratch, "t")
    EV.append_batch(spark.sql("select 1 as id, 7 as n, true as flag, named_struct('x', 1) as s, null as late"), base, "a")
    EV.append_batch(spark.sql("select 2L as ID, 5000000000 as n, 3 as flag, array(1, 2) as s, 9 as new"), base, "b")
    EV.append_batch(spark.sql("select 3 as id, 0.5D as n, date'2024-01-02' as late, 'x y' as `odd name.1`"), base, "c")
    EV.append_batch(spark.sql("select 4 as id, 1 as n").limit(0), base, "d")
    got = EV.read_evolved(spark, base)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [
        ("id", "bigint"), ("n", "double"), ("flag", "string"), ("s", "string"), ("late", "date"), ("new", "int"), ("odd name.1", "string"),
    ]
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, 7.0, "true", '{"x":1}', None, None, None),
        (2, 5e9, "3", "[1,2]", None, 9, None),
        (3, 0.5, None, None, dt.date(2024, 1, 2), None, "x y"),
    ]


def test_a_load_appended_again_replaces_itself_and_keeps_files(spark, scratch, monkeypatch):
    base = os.path.join(scratch, "t")
    with pytest.raises(FileNotFoundError):
        EV.read_evolved(spark, base)
    EV.append_batch(spark.range(3), base, "a")
    EV.append_batch(spark.range(5).select(F.col("id").cast("string")), base, "b")
    files = set(glob.glob(f"{base}/data/*/*.parquet"))
    assert EV.read_evolved(spark, base).count() == 8
    EV.append_batch(spark.range(4), base, "b")  # the same load again, now with its right type
    got = EV.read_evolved(spark, base)
    assert got.count() == 7 and got.schema["id"].dataType == T.LongType()
    assert files <= set(glob.glob(f"{base}/data/*/*.parquet"))

    with monkeypatch.context() as m:  # a writer lost between its files and its row
        m.setattr(EV, "_dt", None)
        with pytest.raises(AttributeError):
            EV.append_batch(spark.range(9), base, "c")
    assert len(glob.glob(f"{base}/data/c-*/*.parquet")) > 0
    assert EV.read_evolved(spark, base).count() == 7


def test_filters_reach_the_files_of_columns_that_were_not_widened(spark, scratch):
    base = os.path.join(scratch, "t")
    EV.append_batch(spark.sql("select 1 as k, 1 as n"), base, "a")
    EV.append_batch(spark.sql("select 1 as k, 2L as n"), base, "b")
    plan = EV.read_evolved(spark, base).filter("k = 1").select("n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(k,1)") == 2
