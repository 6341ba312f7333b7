"""Schema drift: which paths payloads hold, of which types, and what changed from load to load.

A payload is parsed once and its shape taken as text (``schema_of_variant``).
Rows are first counted by load and shape, which Spark combines map-side: a load
of a billion alike reviews leaves a row per map task. Only the distinct shapes
are taken apart into paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

ROOT = "$"
_ITEM = "[*]"
# What the type names of a shape stand for.
_JSON_TYPES = {
    "BIGINT": "integer", "NUMBER": "number", "STRING": "string", "BOOLEAN": "boolean",
    "VOID": "null", "VARIANT": "mixed",
}
# Pieces of a shape: a member's name, an opened object or array, a closed one, a plain type.
_PIECE = r"(?:`(?:[^`]|``)*`|[A-Za-z0-9_]+): |OBJECT<|ARRAY<|>|[A-Z]+"


def _shape(payload: Column) -> Column:
    shape = F.schema_of_variant(F.try_parse_json(payload))
    # sizes of decimals would make shapes of equal types differ
    return F.regexp_replace(shape, r"\b(?:DECIMAL\([0-9]+,[0-9]+\)|DOUBLE|FLOAT)(?=[,>]|$)", "NUMBER")


def _paths_of(shape: Column) -> Column:
    """array<struct<path, type>> of a shape: one walk over its pieces with the stack of open paths."""
    start = F.struct(
        F.array().cast("array<string>").alias("open"),
        F.lit(ROOT).alias("at"),
        F.array().cast("array<struct<path:string,type:string>>").alias("found"),
    )

    def step(state: Column, piece: Column) -> Column:
        is_name, is_object, is_array, is_end = piece.endswith(": "), piece == "OBJECT<", piece == "ARRAY<", piece == ">"
        name = F.regexp_replace(piece, ": $", "")
        inside = F.concat(state["at"], F.lit(_ITEM))
        at = F.when(is_name, F.concat(F.element_at(state["open"], -1), F.lit("."), name)).when(is_array, inside).otherwise(state["at"])
        opened = (
            F.when(is_object, F.array_append(state["open"], state["at"]))
            .when(is_array, F.array_append(state["open"], inside))
            .when(is_end, F.slice(state["open"], F.lit(1), F.size(state["open"]) - 1))
            .otherwise(state["open"])
        )
        plain = F.coalesce(F.create_map(*[F.lit(x) for kv in _JSON_TYPES.items() for x in kv])[piece], F.lower(piece))
        kind = F.when(is_object, F.lit("object")).when(is_array, F.lit("array")).otherwise(plain)
        entry = F.struct(state["at"].alias("path"), kind.alias("type"))
        found = F.when(is_name | is_end, state["found"]).otherwise(F.array_append(state["found"], entry))
        return F.struct(opened.alias("open"), at.alias("at"), found.alias("found"))

    return F.aggregate(F.regexp_extract_all(shape, F.lit(f"({_PIECE})")), start, step, lambda s: s["found"])


def payload_paths(ledger: DataFrame) -> DataFrame:
    """(load_id, path, type, rows): per load, path and JSON type the rows that hold it, at any depth.

    Types are object, array, string, integer, number, boolean, null; ``mixed``
    are items of one array that are of several kinds. ``[*]`` stands for the
    items of an array, and names of other than letters, digits and ``_`` are in
    backticks. A payload that is no JSON counts at ``$`` as ``invalid``, a null
    payload is not counted, and an empty array has items of type null.
    """
    shapes = (
        ledger.filter(F.col("payload").isNotNull())
        .groupBy("load_id", _shape(F.col("payload")).alias("shape"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    invalid = F.array(F.struct(F.lit(ROOT).alias("path"), F.lit("invalid").alias("type")))
    parts = F.when(F.col("shape").isNull(), invalid).otherwise(_paths_of(F.col("shape")))
    found = shapes.select("load_id", "rows", F.explode(parts).alias("p"))
    return found.groupBy("load_id", F.col("p.path").alias("path"), F.col("p.type").alias("type")).agg(
        F.sum("rows").cast("long").alias("rows")
    )


def schema_drift(ledger: DataFrame) -> DataFrame:
    """(load_id, path, change, types_before, types_now, rows): how each load's payloads differ from the load before.

    ``change`` is ``new`` (no row of the load before holds the path), ``gone``
    (no row of this one does) or ``retyped`` (the set of its types differs).
    Types are sorted and joined by ``|``; ``rows`` counts this load's rows with
    the path. Loads follow each other by their first ``ingested_at``, then by
    id; the first has nothing to differ from. The window has a row per load.
    The paths of all loads are written once: payloads are parsed once.
    """
    per_type = payload_paths(ledger)
    paths = per_type.groupBy("load_id", "path").agg(
        F.array_join(F.array_sort(F.collect_set("type")), "|").alias("types"),  # at most nine types
        F.sum("rows").alias("rows"),
    )
    paths = written(paths, "paths")
    loads = ledger.groupBy("load_id").agg(F.min("ingested_at").alias("first"))
    order = Window.orderBy(F.col("first").asc_nulls_first(), "load_id")
    loads = loads.select("load_id", F.lead("load_id").over(order).alias("after"), F.lag("load_id").over(order).alias("before"))
    held = paths.join(loads, "load_id")
    now = held.filter(F.col("before").isNotNull()).select("load_id", "path", F.col("types").alias("types_now"), "rows")
    was = held.filter(F.col("after").isNotNull()).select(F.col("after").alias("load_id"), "path", F.col("types").alias("types_before"))
    change = (
        F.when(F.col("types_before").isNull(), "new")
        .when(F.col("types_now").isNull(), "gone")
        .when(F.col("types_before") != F.col("types_now"), "retyped")
    )
    return (
        now.join(was, ["load_id", "path"], "full_outer")
        .select("load_id", "path", change.alias("change"), "types_before", "types_now", F.coalesce("rows", F.lit(0)).alias("rows"))
        .filter(F.col("change").isNotNull())
    )
