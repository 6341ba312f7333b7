"""The review data contract as column expressions over Variant types.

Each review is parsed once to a Variant; every rule is a predicate on the
Variant type of one field, so validation is one projection, vectorized
and JVM-side, with no per-row validator library. A review's result is the
list of broken rules (empty = valid) in the rule order below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The review contract (Draft-07 JSON Schema of a review).
# Top level: required keys, and the type of each declared key.
REQUIRED_KEYS = (
    "recommendationid",
    "language",
    "review",
    "timestamp_created",
    "timestamp_updated",
    "voted_up",
    "votes_up",
    "votes_funny",
    "weighted_vote_score",
    "steam_purchase",
    "received_for_free",
    "written_during_early_access",
    "author",
)
PROPERTY_TYPES = (
    ("recommendationid", "string"),
    ("language", "string"),
    ("review", "string"),
    ("timestamp_created", "integer>=0"),
    ("timestamp_updated", "integer>=0"),
    ("voted_up", "boolean"),
    ("votes_up", "integer>=0"),
    ("votes_funny", "integer>=0"),
    ("weighted_vote_score", "string|number"),
    ("comment_count", "integer>=0"),
    ("steam_purchase", "boolean"),
    ("received_for_free", "boolean"),
    ("written_during_early_access", "boolean"),
    ("playtime_at_review", "integer>=0"),
    ("author", "object"),
    ("app_id", "string"),
    ("page", "integer>=1"),
    ("cursor", "string"),
    ("fetched_at", "string"),
)
# The author object: required keys and declared key types.
AUTHOR_REQUIRED_KEYS = ("steamid", "num_games_owned", "num_reviews", "playtime_forever")
AUTHOR_PROPERTY_TYPES = (
    ("steamid", "string"),
    ("num_games_owned", "integer>=0"),
    ("num_reviews", "integer>=0"),
    ("playtime_forever", "integer>=0"),
    ("playtime_last_two_weeks", "integer>=0"),
    ("playtime_at_review", "integer>=0"),
    ("last_played", "integer>=0"),
)
CONTRACT_KEYS = tuple(k for k, _ in PROPERTY_TYPES)

_NUMERIC = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"
_ALL_FIELDS = [("", k, kind) for k, kind in PROPERTY_TYPES] + [("author.", k, kind) for k, kind in AUTHOR_PROPERTY_TYPES]


def _col_name(prefix: str, key: str, what: str) -> str:
    return f"_{what}_{prefix.rstrip('.')}_{key}" if prefix else f"_{what}_{key}"


def _type_ok(t: Column, x: Column | None, kind: str) -> Column:
    if kind == "string":
        return t == F.lit("STRING")
    if kind == "boolean":
        return t == F.lit("BOOLEAN")
    if kind == "object":
        return t.startswith("OBJECT")
    numeric = t.rlike(_NUMERIC)
    if kind == "string|number":
        return (t == F.lit("STRING")) | numeric
    # integers: any numeric JSON value with an integral value (1.0 counts)
    return numeric & (x == F.floor(x))


def _minimum(kind: str) -> int | None:
    if kind.startswith("integer>="):
        return int(kind.split(">=")[1])
    return None


def _rules(prefix: str, required, types) -> list[Column]:
    out = []
    for key in required:
        t = F.col(_col_name(prefix, key, "t"))
        out.append(F.when(t.isNull(), F.lit(f"required:{prefix}{key}")))
    for key, kind in types:
        t = F.col(_col_name(prefix, key, "t"))
        lo = _minimum(kind)
        x = F.col(_col_name(prefix, key, "x")) if kind.startswith("integer") else None
        ok = _type_ok(t, x, kind)
        out.append(F.when(t.isNotNull() & ~ok, F.lit(f"type:{prefix}{key}")))
        if lo is not None:
            out.append(F.when(t.isNotNull() & ok & (x < F.lit(float(lo))), F.lit(f"minimum:{prefix}{key}")))
    return out


def add_violations(df: DataFrame, review: str = "review", out: str = "violations") -> DataFrame:
    """Add ``out``: the broken rules of the JSON text in ``review``, comma
    separated in rule order ('' = valid).

    Three narrow projections: parse once to a Variant, read the Variant type
    (NULL absent, VOID for JSON null) and numeric value of each declared
    field once, then evaluate the rules on those columns.
    """
    v = F.col("_v")
    parsed = df.withColumn("_v", F.try_parse_json(F.col(review)))
    typed_cols = [F.schema_of_variant(v).alias("_t_top")]
    for prefix, key, kind in _ALL_FIELDS:
        path = f"$.{prefix}{key}"
        typed_cols.append(F.schema_of_variant(F.variant_get(v, path, "variant")).alias(_col_name(prefix, key, "t")))
        if kind.startswith("integer"):
            typed_cols.append(F.try_variant_get(v, path, "double").alias(_col_name(prefix, key, "x")))
    typed = parsed.select("*", *typed_cols).drop("_v")
    is_obj = F.coalesce(F.col("_t_top").startswith("OBJECT"), F.lit(False))
    author_obj = F.coalesce(F.col("_t_author").startswith("OBJECT"), F.lit(False))
    rules = F.concat_ws(
        ",",
        *_rules("", REQUIRED_KEYS, PROPERTY_TYPES),
        F.when(author_obj, F.nullif(F.concat_ws(",", *_rules("author.", AUTHOR_REQUIRED_KEYS, AUTHOR_PROPERTY_TYPES)), F.lit(""))),
    )
    helper = [c for c in typed.columns if c.startswith("_t_") or c.startswith("_x_")]
    return typed.withColumn(out, F.when(is_obj, rules).otherwise(F.lit("type:$"))).drop(*helper)
