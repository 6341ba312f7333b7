"""Declared data-quality checks and the gate between layers.

All not-null and range checks of one table run as a single aggregation
pass (``count_if`` per check, combined map-side); each uniqueness check is
one aggregation on its key. Results are a small DataFrame
``(model, column_name, test_name, failures)``; ``gate`` raises before the
next layer is written when any check fails.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str  # "not_null" | "unique" | "accepted_range"
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True


# The 13 declared checks of the four layers.
CHECKS = (
    Check("steam_reviews_raw", "recommendationid", "not_null"),
    Check("steam_reviews_raw", "appid", "not_null"),
    Check("steam_reviews_raw_compacted", "recommendationid", "not_null"),
    Check("steam_reviews_raw_compacted", "hash_payload", "not_null"),
    Check("steam_reviews_enriched", "recommendationid", "not_null"),
    Check("steam_reviews_enriched", "recommendationid", "unique"),
    Check("steam_reviews_enriched", "app_id", "not_null"),
    Check("steam_reviews_enriched", "review_created_at", "not_null"),
    Check("fct_steam_review_metrics_adaptive", "app_id", "not_null"),
    Check("fct_steam_review_metrics_adaptive", "app_id", "unique"),
    Check("fct_steam_review_metrics_adaptive", "avg_rating", "not_null"),
    Check("fct_steam_review_metrics_adaptive", "avg_rating", "accepted_range", 0.0, 1.0),
    Check("fct_steam_review_metrics_adaptive", "edp_current", "accepted_range", 0.0, 1.0),
)

RESULT_SCHEMA = "model string, column_name string, test_name string, failures bigint"


class DataQualityError(RuntimeError):
    def __init__(self, failed: list[dict]):
        super().__init__(f"{len(failed)} data-quality check(s) failed: {failed}")
        self.failed = failed


def _out_of_range(c: Check):
    col = F.col(c.column)
    if c.inclusive:
        ok = (col >= F.lit(c.min_value)) & (col <= F.lit(c.max_value))
    else:
        ok = (col > F.lit(c.min_value)) & (col < F.lit(c.max_value))
    return F.coalesce(~ok, F.lit(False))  # NULL passes


def _failures(c: Check):
    """How many rows fail a check that looks at one row at a time."""
    return F.count_if(F.col(c.column).isNull() if c.test == "not_null" else _out_of_range(c))


class Observed:
    """The null and range checks of a model, counted while its rows are written.

    ``rows`` is the DataFrame to write in place of the given one; after the
    write, ``failures()`` holds the counts, with no second scan. Only the
    ``unique`` checks still need one, of the key columns.
    """

    def __init__(self, model: str, df: DataFrame, checks=CHECKS):
        self.checks = [c for c in checks if c.model == model and c.test in ("not_null", "accepted_range")]
        self.observation = Observation(f"checks of {model}")
        counts = [_failures(c).alias(f"c{i}") for i, c in enumerate(self.checks)]
        self.rows = df.observe(self.observation, *counts) if counts else df

    def failures(self) -> list[dict]:
        counted = self.observation.get if self.checks else {}
        return [
            {"model": c.model, "column_name": c.column, "test_name": c.test, "failures": counted[f"c{i}"]}
            for i, c in enumerate(self.checks)
        ]


def raise_failed(rows: list[dict]) -> None:
    failed = [r for r in rows if r["failures"]]
    if failed:
        raise DataQualityError(failed)


def run_checks(tables: dict[str, DataFrame], checks=CHECKS) -> DataFrame:
    """Evaluate the checks of every model present in ``tables``."""
    parts: list[DataFrame] = []
    for model, df in tables.items():
        mine = [c for c in checks if c.model == model]
        scalar = [c for c in mine if c.test in ("not_null", "accepted_range")]
        if scalar:
            row = df.agg(*[_failures(c).alias(f"c{i}") for i, c in enumerate(scalar)])
            stacked = F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(c.model).alias("model"),
                            F.lit(c.column).alias("column_name"),
                            F.lit(c.test).alias("test_name"),
                            F.col(f"c{i}").cast("long").alias("failures"),
                        )
                        for i, c in enumerate(scalar)
                    ]
                )
            )
            parts.append(row.select(stacked.alias("r")).select("r.*"))
        for c in (c for c in mine if c.test == "unique"):
            dup = (
                df.filter(F.col(c.column).isNotNull())
                .groupBy(c.column)
                .count()
                .filter(F.col("count") > 1)
                .agg(F.count(F.lit(1)).cast("long").alias("failures"))
            )
            parts.append(
                dup.select(
                    F.lit(c.model).alias("model"),
                    F.lit(c.column).alias("column_name"),
                    F.lit(c.test).alias("test_name"),
                    "failures",
                )
            )
    if not parts:
        raise ValueError("no checks apply to the given tables")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(results: DataFrame) -> DataFrame:
    """Raise ``DataQualityError`` when any check failed; return the results.

    The result table holds one row per check (a handful), so collecting it
    is bounded by the number of declared checks, not by the data."""
    raise_failed([r.asDict() for r in results.collect()])
    return results
