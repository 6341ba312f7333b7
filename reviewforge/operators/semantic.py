"""Metric layer over the gold table: metrics by dimensions.

The declarations (one entity, two dimensions, five measures, four metrics)
are plain data; ``query_metrics`` turns a request into one
``groupBy(...).agg(...)`` over the gold table, so Catalyst prunes the
gold columns to the requested measures and dimensions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str  # "average" | "max" | "sum" | "min" | "count"
    expr: str


@dataclass(frozen=True)
class Dimension:
    name: str
    kind: str  # "categorical" | "time"
    expr: str
    grain: str = "day"


# The semantic model of the adaptive review metrics.
MODEL = "steam_review_metrics_adaptive"
ENTITY = ("app", "app_id")  # primary entity: one gold row per app
DEFAULT_TIME_DIMENSION = "snapshot_date"
DIMENSIONS = {
    "app_id": Dimension("app_id", "categorical", "app_id"),
    "snapshot_date": Dimension("snapshot_date", "time", "snapshot_date", "day"),
}
MEASURES = {
    "avg_rating": Measure("avg_rating", "average", "avg_rating"),
    "edp_current": Measure("edp_current", "average", "edp_current"),
    "decay_ewrr": Measure("decay_ewrr", "average", "decay_ewrr"),
    "cult_score": Measure("cult_score", "average", "cult_score"),
    "total_reviews": Measure("total_reviews", "max", "total_reviews"),
}
# Simple metrics: metric name -> measure name.
METRICS = {
    "avg_rating": "avg_rating",
    "edp_current": "edp_current",
    "decay_ewrr": "decay_ewrr",
    "cult_score": "cult_score",
}
GRAINS = ("day", "week", "month", "quarter", "year")

_AGGS = {
    "average": F.avg,
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
    "count": F.count,
}


def _time_bucket(expr: Column, grain: str) -> Column:
    """Start of the period containing the timestamp, as a naive timestamp."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    day = expr.cast("date")
    if grain == "day":
        return day.cast("timestamp_ntz")
    return F.trunc(day, grain).cast("timestamp_ntz")


def _dimension(ref: str) -> tuple[Column, str]:
    """``app_id``, ``snapshot_date``, ``snapshot_date__month`` or ``metric_time[__grain]``."""
    name, _, grain = ref.partition("__")
    if name == "metric_time":
        name = DEFAULT_TIME_DIMENSION
    if name not in DIMENSIONS:
        raise KeyError(f"unknown dimension {ref!r}; known: {sorted(DIMENSIONS)}")
    d = DIMENSIONS[name]
    if d.kind == "time":
        g = grain or d.grain
        if GRAINS.index(g) < GRAINS.index(d.grain):
            raise ValueError(f"{ref}: finer than the dimension's grain {d.grain}")
        return _time_bucket(F.col(d.expr), g), ref
    if grain:
        raise ValueError(f"{ref}: categorical dimensions take no grain")
    return F.col(d.expr), ref


def _measure_column(name: str, alias: str) -> Column:
    m = MEASURES[name]
    return _AGGS[m.agg](F.col(m.expr)).alias(alias)


def query_metrics(
    gold: DataFrame,
    metrics: list[str],
    group_by: list[str] | tuple[str, ...] = (),
    where: Column | str | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Metrics (or bare measures) aggregated by the requested dimensions.

    ``where`` filters gold rows before aggregation. Averages are unweighted
    across apps, as declared.
    """
    aggs = []
    for name in metrics:
        if name in METRICS:
            aggs.append(_measure_column(METRICS[name], name))
        elif name in MEASURES:
            aggs.append(_measure_column(name, name))
        else:
            raise KeyError(f"unknown metric {name!r}; known: {sorted(METRICS) + sorted(MEASURES)}")
    src = gold
    if where is not None:
        src = src.filter(where)
    dims = [_dimension(g) for g in group_by]
    if dims:
        out = src.groupBy(*[c.alias(a) for c, a in dims]).agg(*aggs)
    else:
        out = src.agg(*aggs)
    if order_by:
        out = out.orderBy(*order_by)
    return out


def check_primary_entity(gold: DataFrame) -> None:
    """The model's primary entity (one gold row per app) is what makes the
    metric averages per-app averages; raise when ``app_id`` repeats or is NULL."""
    from .quality import Check, gate, run_checks

    key = ENTITY[1]
    checks = (Check(MODEL, key, "not_null"), Check(MODEL, key, "unique"))
    gate(run_checks({MODEL: gold}, checks))
