"""Gold layer: per-app adaptive review metrics.

Two aggregation passes over four narrow silver columns:

1. per-app bounds (first/last review, last change) -> tenure -> three
   half-lives clamped by the parameters -> decay rates;
2. each review joined to its app's rates (broadcast when the per-app table
   is proven small) and summed per app: count, mean vote, decayed vote
   sums and two decayed counts.

Both passes are algebraic aggregates, so Spark combines them map-side before
the shuffle; an app holding a third of all reviews costs one partial row per
map task, not a third of the data in one task. The reference's four
one-to-one joins of per-app tables collapse into the second ``groupBy``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import day_start, days_between
from ..params import DecayParams
from ..plans.joins import join_per_key

GOLD_COLUMNS = [
    "app_id",
    "first_review_at",
    "latest_review_at",
    "latest_review_updated_at",
    "record_changed_at",
    "snapshot_date",
    "total_reviews",
    "avg_rating",
    "edp_current",
    "decay_ewrr",
    "cult_score",
    "half_life_short_days",
    "half_life_long_days",
    "half_life_pos_days",
]

LN2 = math.log(2.0)


def as_of_timestamp(params: DecayParams) -> Column:
    """Midnight of the as-of date (today when unset) as a naive timestamp."""
    if params.as_of is None:
        return F.current_date().cast("timestamp_ntz")
    return F.lit(params.as_of.isoformat()).cast("date").cast("timestamp_ntz")


def _clamp(value: Column, lo: float, hi: float) -> Column:
    return F.least(F.lit(float(hi)), F.greatest(F.lit(float(lo)), value))


def _safe_div(num: Column, den: Column) -> Column:
    return num / F.nullif(den, F.lit(0.0))


GOLD_INPUT_COLUMNS = ["app_id", "review_created_at", "review_updated_at", "record_changed_at", "voted_up", "is_deleted"]


def eligible_reviews(silver: DataFrame) -> DataFrame:
    """Reviews that count: created time known and not soft-deleted (the
    narrow silver columns the gold layer reads)."""
    return silver.filter(
        F.col("review_created_at").isNotNull() & ~F.coalesce(F.col("is_deleted"), F.lit(False))
    ).select(*GOLD_INPUT_COLUMNS)


def app_bounds(reviews: DataFrame) -> DataFrame:
    """Per app: first and latest review, latest change and latest update."""
    return reviews.groupBy("app_id").agg(
        F.min("review_created_at").alias("first_review_at"),
        F.max("review_created_at").alias("latest_review_at"),
        F.max("record_changed_at").alias("record_changed_at"),
        F.max("review_updated_at").alias("latest_review_updated_at"),
    )


def app_half_lives(bounds: DataFrame, params: DecayParams) -> DataFrame:
    """Tenure in days (at least 1) and the three clamped half-lives and rates."""
    p = params
    tenure = F.greatest(days_between(F.col("first_review_at"), as_of_timestamp(p)), F.lit(1.0))
    out = bounds.withColumn("tenure_days", tenure)
    t = F.col("tenure_days")
    out = (
        out.withColumn("h_short", _clamp(F.lit(p.h_short_frac) * t, p.h_short_min_days, p.h_short_max_days))
        .withColumn("h_long", _clamp(F.lit(p.h_long_frac) * t, p.h_long_min_days, p.h_long_max_days))
        .withColumn("h_pos", _clamp(F.lit(p.h_pos_frac) * t, p.h_pos_min_days, p.h_pos_max_days))
    )
    for h in ("short", "long", "pos"):
        out = out.withColumn(f"lambda_{h}", _safe_div(F.lit(LN2), F.col(f"h_{h}")))
    return out


def decay_weights(reviews: DataFrame, lambdas: DataFrame, params: DecayParams) -> DataFrame:
    """Each review with its vote ``y`` (1.0/0.0), capped age in days and the
    app's decay rates. Ages are not floored: a review after the as-of
    midnight has a negative age and weighs more than 1."""
    y = F.when(F.col("voted_up"), F.lit(1.0)).otherwise(F.lit(0.0))
    age = F.least(
        days_between(F.col("review_created_at"), as_of_timestamp(params)),
        F.lit(float(params.weight_age_cap_days)),
    )
    scored = reviews.select("app_id", y.alias("y"), age.alias("age_days"))
    return join_per_key(scored, lambdas, "app_id")


def _weighted_aggs() -> list[Column]:
    y, age = F.col("y"), F.col("age_days")

    def w(rate: str) -> Column:
        return F.exp(-F.col(rate) * age)

    return [
        F.sum(y * w("lambda_pos")).alias("w_pos_num"),
        F.sum(w("lambda_pos")).alias("w_pos_den"),
        F.sum(w("lambda_short")).alias("ew_short"),
        F.sum(w("lambda_long")).alias("ew_long"),
    ]


def weighted_sums(weighted: DataFrame) -> DataFrame:
    """Per app: decayed vote sum and weight sum, short and long decayed counts."""
    return weighted.groupBy("app_id").agg(*_weighted_aggs())


def adaptive_metrics(silver: DataFrame, params: DecayParams | None = None) -> DataFrame:
    """Silver -> the 14-column per-app gold table."""
    params = params or DecayParams()
    reviews = eligible_reviews(silver)
    lambdas = app_half_lives(app_bounds(reviews), params).drop("tenure_days")
    weighted = decay_weights(reviews, lambdas, params)
    carried = [
        "first_review_at", "latest_review_at", "latest_review_updated_at", "record_changed_at",
        "h_short", "h_long", "h_pos",
    ]
    agg = weighted.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.avg("y").alias("avg_rating"),
        *_weighted_aggs(),
        *[F.max(c).alias(c) for c in carried],
    )
    avg_rating = F.col("avg_rating")
    return agg.select(
        "app_id",
        "first_review_at",
        "latest_review_at",
        "latest_review_updated_at",
        "record_changed_at",
        day_start(F.col("record_changed_at")).alias("snapshot_date"),
        F.col("total_reviews").cast("long").alias("total_reviews"),
        avg_rating.alias("avg_rating"),
        _safe_div(F.col("w_pos_num"), F.col("w_pos_den")).alias("edp_current"),
        _safe_div(F.col("ew_short"), F.col("ew_long")).alias("decay_ewrr"),
        _safe_div(avg_rating, F.log10(F.lit(1.0) + F.col("total_reviews"))).alias("cult_score"),
        F.col("h_short").alias("half_life_short_days"),
        F.col("h_long").alias("half_life_long_days"),
        F.col("h_pos").alias("half_life_pos_days"),
    )

