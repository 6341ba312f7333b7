"""Column expressions for text-to-type coercion of JSON field text.

Review payloads arrive as JSON and every field is first read as text (the
``->>`` view of a field). The model layer then coerces the text with
"try" casts that yield NULL instead of failing. Spark's own casts differ from
the SQL dialect the metrics were defined in for a few inputs, so each helper
below spells out the intended rule with built-in expressions only (no UDFs,
everything stays inside whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The epoch origin for naive UTC timestamps and the largest epoch
# second that still maps to a valid timestamp (9999-12-31 23:59:59).
EPOCH_NTZ = "1970-01-01 00:00:00"
MAX_EPOCH_SECONDS = 253402300799.0

_SUFFIXED_NUMBER = r"^\s*[+-]?[0-9]*\.?[0-9]+([eE][+-]?[0-9]+)?[dDfF]\s*$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_to_double(col: Column | str) -> Column:
    """Text -> double, NULL when not a number.

    Spark also accepts a trailing ``d``/``f`` type suffix (``'1f'``); that is
    not a number in the target semantics, so such text maps to NULL.
    """
    c = _c(col)
    # the long pattern is tried only on the few texts that have such a letter at all
    suffixed = c.rlike("[dDfF]") & c.rlike(_SUFFIXED_NUMBER)
    return F.when(suffixed, F.lit(None).cast("double")).otherwise(c.try_cast("double"))


def text_to_int(col: Column | str) -> Column:
    """Text -> 32-bit integer, rounding numeric text half away from zero.

    ``'3.7' -> 4``, ``'2.5' -> 3``, ``'-3.2' -> -3``, ``'1e3' -> 1000``;
    out-of-range or non-numeric text -> NULL. Plain digits skip the rounding.
    """
    c = _c(col)
    return F.when(c.rlike("^[0-9]{1,9}$"), c.try_cast("int")).otherwise(F.round(text_to_double(c)).try_cast("int"))


def text_to_bool(col: Column | str) -> Column:
    """Text -> boolean (true/t/yes/y/1, false/f/no/n/0), NULL otherwise.

    Padded text such as ``' true '`` is not accepted.
    """
    c = _c(col)
    return F.when(c != F.trim(c), F.lit(None).cast("boolean")).otherwise(c.try_cast("boolean"))


def text_to_timestamp(col: Column | str) -> Column:
    """ISO text -> naive timestamp; an explicit offset is dropped, bad text -> NULL."""
    return _c(col).try_cast("timestamp_ntz")


def epoch_to_timestamp(col: Column | str) -> Column:
    """Epoch seconds (double, fractions kept to the microsecond) -> naive UTC timestamp.

    Computed as an offset from the epoch origin, so the result does not depend
    on the session time zone. Values outside the timestamp range -> NULL.
    """
    c = _c(col).cast("double")
    micros = (c * F.lit(1_000_000.0)).cast("long")
    return F.when(
        c.isNotNull() & (F.abs(c) <= F.lit(MAX_EPOCH_SECONDS)),
        F.timestamp_add("MICROSECOND", micros, F.lit(EPOCH_NTZ).cast("timestamp_ntz")),
    )


def timestamp_to_epoch_seconds(col: Column | str) -> Column:
    """Naive timestamp -> whole epoch seconds (bigint), time-zone independent."""
    return F.timestamp_diff("SECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), _c(col))


def days_between(start: Column | str, end: Column | str) -> Column:
    """(end - start) in fractional days, microsecond exact, as double."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)).cast("double") / F.lit(86_400_000_000.0)


def day_start(col: Column | str) -> Column:
    """Midnight of the timestamp's day, staying a naive timestamp."""
    return _c(col).cast("date").cast("timestamp_ntz")


def json_bool_text(cond: Column) -> Column:
    """Boolean -> JSON literal text ``true``/``false``."""
    return F.when(cond, F.lit("true")).otherwise(F.lit("false"))

