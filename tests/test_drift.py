"""Paths and types of payloads against a plain walk over parsed JSON."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from reviewforge.operators.drift import payload_paths, schema_drift

KINDS = {bool: "boolean", int: "integer", float: "number", str: "string", type(None): "null"}


def _value(r, depth):
    kind = r.randrange(7 if depth else 5)
    if kind < 5:
        return [True, 7, 2.5, "x>, OBJECT<a: b", None][kind]
    if kind == 5:  # items of one kind: Spark merges others to "mixed"
        return [r.choice([1, "a"])] * r.randrange(1, 4)
    return {r.choice(["a", "b1", "OBJECT", "c d", "e.f", "g`h", "é", "null"]): _value(r, depth - 1) for _ in range(r.randrange(4))}


def _name(key):
    plain = key.isascii() and key.replace("_", "a").isalnum()
    return key if plain else "`" + key.replace("`", "``") + "`"


def _walk(value, path, out):
    if isinstance(value, dict):
        out.add((path, "object"))
        for k, v in value.items():
            _walk(v, f"{path}.{_name(k)}", out)
    elif isinstance(value, list):
        out.add((path, "array"))
        for v in value:
            _walk(v, path + "[*]", out)
    else:
        out.add((path, KINDS[type(value)]))


def _ledger(spark, rows):
    return spark.createDataFrame(rows, "load_id string, ingested_at string, payload string").withColumn(
        "ingested_at", F.col("ingested_at").cast("timestamp_ntz")
    )


def test_paths_equal_a_plain_walk(spark):
    r = random.Random(3)
    rows, want = [], Counter()
    for i in range(500):
        load, value = f"L{i % 3}", {"top": _value(r, 5), "n": i}
        found = set()
        _walk(value, "$", found)
        want.update((load, *f) for f in found)
        rows.append((load, "2024-01-01", json.dumps(value)))
    got = {(x["load_id"], x["path"], x["type"]): x["rows"] for x in payload_paths(_ledger(spark, rows)).collect()}
    assert got == dict(want)


def test_changes_from_load_to_load(spark):
    rows = [
        ("b", "2024-01-01", '{"a": 1, "x": {"y": {"z": 1}}, "m": 1}'),
        ("b", "2024-01-01", '{"a": 2.5, "m": "1"}'),
        ("a", "2024-01-02", '{"a": 1, "x": {"y": {"z": "1", "w": []}}, "m": 1}'),
        ("a", "2024-01-02", '{"m": "1", "a": 1.5}'),
        ("c", "2024-01-03", "no json"),
        ("c", "2024-01-03", None),
    ]
    got = {(x["load_id"], x["path"]): tuple(x)[2:] for x in schema_drift(_ledger(spark, rows)).collect()}
    first = {k: v for k, v in got.items() if k[0] == "a"}
    assert first == {
        ("a", "$.x.y.z"): ("retyped", "integer", "string", 1),
        ("a", "$.x.y.w"): ("new", None, "array", 1),
        ("a", "$.x.y.w[*]"): ("new", None, "null", 1),
    }
    last = {k[1]: v[0] for k, v in got.items() if k[0] == "c"}
    assert last.pop("$") == "retyped" and set(last.values()) == {"gone"} and "$.x.y.z" in last
    assert not any(k[0] == "b" for k in got)


def test_nothing_to_compare(spark):
    assert schema_drift(_ledger(spark, [])).collect() == []
    assert schema_drift(_ledger(spark, [("a", None, "{}"), ("a", None, None)])).collect() == []
    assert payload_paths(_ledger(spark, [("a", None, None)])).collect() == []
