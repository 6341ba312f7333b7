"""Join helpers that decide broadcast vs shuffle from a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

# Largest side table we ship to every executor. Per-app tables are a few
# dozen bytes per row; past this bound the join shuffles both sides by key and
# salt.
BROADCAST_BYTE_LIMIT = 64 * 1024 * 1024
SALTS = 32

_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def _size_columns(df: DataFrame) -> tuple[int, list]:
    """Fixed bytes per row, and expressions summing the variable-width bytes."""
    fixed, variable = 8, []  # 8: per-row overhead
    for f in df.schema.fields:
        width = next((w for t, w in _FIXED_WIDTH.items() if isinstance(f.dataType, t)), None)
        if width is not None:
            fixed += width
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            fixed += 8
            variable.append(F.coalesce(F.sum(F.octet_length(F.col(f.name))), F.lit(0)))
        else:  # nested values: count their JSON text
            fixed += 8
            variable.append(F.coalesce(F.sum(F.length(F.to_json(F.col(f.name)))), F.lit(0)))
    return fixed, variable


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` in bytes, measured by one aggregation (rows x fixed
    widths plus the actual length of every string)."""
    fixed, variable = _size_columns(df)
    row = df.agg(F.count(F.lit(1)).alias("n"), *[v.alias(f"v{i}") for i, v in enumerate(variable)]).first()
    return int(row["n"]) * fixed + sum(int(row[f"v{i}"]) for i in range(len(variable)))


def join_per_key(
    big: DataFrame,
    small: DataFrame,
    on: list[str] | str,
    how: str = "inner",
    byte_limit: int = BROADCAST_BYTE_LIMIT,
    salts: int = SALTS,
) -> DataFrame:
    """Join a large table with a derived per-key table.

    ``small`` is written once to the shared folder (it is needed for the size
    check and the join alike) and its size measured; it is broadcast only when
    the measurement proves it small. Beyond that both sides are shuffled by the
    key and a salt: the rows of a key are dealt over ``salts`` partitions by a
    hash of the whole row, and each per-key row is repeated for every salt.
    What follows by key then combines within those partitions first, so a key
    with a third of all rows is never in one task.
    """
    keys = [on] if isinstance(on, str) else list(on)
    small = written(small, "per-key")
    if measured_bytes(small) <= byte_limit:
        return big.join(F.broadcast(small), on, how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*[_hashable(f) for f in big.schema.fields]), F.lit(salts)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def _hashable(field: T.StructField):
    """A column that xxhash64 takes (it takes no maps and variants)."""
    if isinstance(field.dataType, (T.MapType, T.VariantType)):
        return F.lit(0)
    return F.col(field.name)
