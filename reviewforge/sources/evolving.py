"""A table whose batches may add columns and widen the types of columns.

Layout under the table's folder::

    data/<load id>-<run>/   the files of one append, all of one schema
    _appends/               a row per append: when, load id, folder, schema

An append writes a folder of its own and then its row; it reads nothing and
rewrites nothing. The newest row of a load counts, so a run repeated after a
failure replaces its rows, and a writer lost before the row leaves no trace in
what is read. A reader resolves one schema over the appends and reads the
folders of each distinct schema together, with their own types and a cast per
widened column, so pruning and pushdown work per folder.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_APPENDS = "at string, load_id string, folder string, schema string"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)  # in order of width
_DAYS = (T.DateType, T.TimestampNTZType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both.

    byte < short < int < bigint < double < text, float < double, and
    date < timestamp without zone < text. Decimals grow to hold both, to double
    beyond 38 digits. All other pairs of different types meet in text: plain
    values as Spark casts them, nested ones as JSON. A bigint beyond 2^53 is
    rounded when its column becomes double.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for order in (_WHOLE, _DAYS):
        if isinstance(a, order) and isinstance(b, order):
            return max(a, b, key=lambda t: order.index(type(t)))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def widened(schemas: list[T.StructType]) -> T.StructType:
    """One schema over several: columns as first met (names compared without case), each of its widest type."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            seen = found.setdefault(f.name.lower(), T.StructField(f.name, f.dataType))
            seen.dataType = wider(seen.dataType, f.dataType)
    return T.StructType(list(found.values()))


def _cast(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(value)
    return value.cast(want)


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of a schema that is as wide; columns it lacks are null."""
    have = {f.name.lower(): f for f in df.schema.fields}

    def column(f: T.StructField) -> Column:
        own = have.get(f.name.lower())
        value = F.lit(None).cast(f.dataType) if own is None else _cast(df[f"`{own.name}`"], own.dataType, f.dataType)
        return value.alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def append_batch(batch: DataFrame, base: str, load_id: str) -> None:
    """Append ``batch`` as the rows of ``load_id``, in place of any that load wrote before."""
    spark = batch.sparkSession
    untyped = {f.name: F.col(f"`{f.name}`").cast("string") for f in batch.schema.fields if isinstance(f.dataType, T.NullType)}
    stored = batch.withColumns(untyped)  # a file has no type for a column of nulls
    folder = f"data/{load_id}-{uuid.uuid4().hex}"
    stored.hint("rebalance").write.parquet(f"{base.rstrip('/')}/{folder}")
    at = _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="microseconds")
    row = spark.createDataFrame([(at, load_id, folder, batch.schema.json())], _APPENDS)
    row.coalesce(1).write.mode("append").json(f"{base.rstrip('/')}/_appends")


def appends(spark: SparkSession, base: str) -> list[tuple[str, str, T.StructType]]:
    """(load id, folder, schema) of the loads in the order of their last append; the driver holds a row per load."""
    try:
        rows = spark.read.schema(_APPENDS).json(f"{base.rstrip('/')}/_appends")
        newest = rows.groupBy("load_id").agg(F.max(F.struct("at", "folder", "schema")).alias("a"))
        found = newest.select("load_id", "a.*").orderBy("at", "load_id").collect()
    except AnalysisException:
        return []
    return [(r["load_id"], r["folder"], T.StructType.fromJson(json.loads(r["schema"]))) for r in found]


def read_evolved(spark: SparkSession, base: str) -> DataFrame:
    """All rows under the widened schema. Values are the appended ones, cast; a column that a load lacks is null in its rows."""
    loads = appends(spark, base)
    if not loads:
        raise FileNotFoundError(f"nothing appended under {base}")
    schema = widened([s for _, _, s in loads])
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    for _, folder, own in loads:
        alike.setdefault(own.json(), (own, []))[1].append(f"{base.rstrip('/')}/{folder}")
    parts = [as_schema(spark.read.schema(_stored(own)).parquet(*folders), schema) for own, folders in alike.values()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType) for f in schema.fields]
    )
