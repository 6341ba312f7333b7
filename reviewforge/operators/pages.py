"""Ingest side: landed API page envelopes -> reviews with lineage.

The API is read page by page per app, and a page can end the app's read:
a page whose ``success`` is not 1 or that has no reviews yields nothing and
ends it; a page whose next cursor is absent or repeats its request cursor
yields its reviews and ends it; reading also stops past ``max_pages``
(absolute page number, so a resumed read gets at least one page). Over
landed pages this is one set expression per app: the first stopping page
decides, and a page that was not landed ends the read before it. The
per-app stops are aggregates (combined map-side, so a hot app costs nothing
extra) joined back to the pages; no app is sent to a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import epoch_to_timestamp
from ..plans.joins import join_per_key

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("success", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("cursor", T.StringType()),
        T.StructField("reviews", T.ArrayType(T.StringType())),
    ]
)

# The members that a run sets on every review.
LINEAGE_KEYS = ("app_id", "page", "cursor", "fetched_at")
# The accepted review filters of the API.
REVIEW_TYPES = ("all", "positive", "negative")
PURCHASE_TYPES = ("all", "steam", "non_steam")


def success_is_one(body: Column) -> Column:
    """``success`` equals 1 as a JSON value: the number 1 (also ``1.0``) or
    ``true``; the string ``"1"``, other values, null or absence do not."""
    v = F.try_parse_json(body)
    t = F.schema_of_variant(F.variant_get(v, "$.success", "variant"))
    numeric_one = t.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$") & (
        F.try_variant_get(v, "$.success", "double") == F.lit(1.0)
    )
    true = (t == F.lit("BOOLEAN")) & F.try_variant_get(v, "$.success", "boolean")
    return F.coalesce(numeric_one | true, F.lit(False))


def parse_envelopes(pages: DataFrame) -> DataFrame:
    """Add the parsed envelope fields: ``success_ok``, ``next_cursor``, ``reviews``.

    Reviews and the cursor are read as raw text (each review keeps its exact
    JSON); ``success`` is judged on its JSON type."""
    env = F.from_json(F.col("body"), ENVELOPE_SCHEMA)
    ok = success_is_one(F.col("body"))
    return pages.withColumn("_env", env).select(
        *pages.columns,
        F.coalesce(ok, F.lit(False)).alias("success_ok"),
        F.col("_env.cursor").alias("next_cursor"),
        F.col("_env.reviews").alias("reviews"),
    )


def admit_pages(
    pages: DataFrame,
    max_pages: int | None = None,
    resume: DataFrame | None = None,
) -> DataFrame:
    """Keep the pages a sequential read would have consumed.

    ``resume``: optional ``(app_id, resume_page)``; pages before it are
    skipped and the cap is ``greatest(max_pages, resume_page)``.
    """
    env = parse_envelopes(pages)
    if resume is not None:
        env = join_per_key(env, resume.select("app_id", "resume_page"), "app_id", "left")
        start = F.coalesce(F.col("resume_page"), F.lit(1))
    else:
        start = F.lit(1)
    env = env.withColumn("start_page", start.cast("int")).filter(F.col("page") >= F.col("start_page"))
    bad = ~F.col("success_ok") | F.coalesce(F.size("reviews") <= 0, F.lit(True))
    chain_end = (
        F.col("next_cursor").isNull() | (F.col("next_cursor") == F.lit("")) | (F.col("next_cursor") == F.col("cursor"))
    )
    # a page whose successor was not landed ends the read there (a gap)
    landed = env.select("app_id", "page")
    succeeded = landed.select("app_id", (F.col("page") - 1).alias("page"))
    tails = landed.join(succeeded, ["app_id", "page"], "left_anti").groupBy("app_id").agg(
        F.min("page").alias("stop_gap")
    )
    stops = env.groupBy("app_id").agg(
        F.min(F.when(bad, F.col("page"))).alias("stop_bad"),
        F.min(F.when(chain_end, F.col("page"))).alias("stop_chain"),
        F.min("page").alias("first_page"),
    ).join(tails, "app_id")
    env = join_per_key(env, stops, "app_id")
    keep = (
        (F.col("first_page") == F.col("start_page"))  # the read's first page must be landed
        & (F.col("page") <= F.col("stop_gap"))
        & (F.col("stop_bad").isNull() | (F.col("page") < F.col("stop_bad")))
        & (F.col("stop_chain").isNull() | (F.col("page") <= F.col("stop_chain")))
    )
    if max_pages is not None:
        keep = keep & (F.col("page") <= F.greatest(F.lit(int(max_pages)), F.col("start_page")))
    drop = ["stop_bad", "stop_chain", "stop_gap", "first_page"] + (["resume_page"] if resume is not None else [])
    return env.filter(keep).drop(*drop)


def _lineage_suffix() -> Column:
    """``"app_id":..,"page":..,"cursor":..,"fetched_at":..`` as JSON members."""
    js = F.to_json(
        F.struct(
            F.col("app_id").cast("string").alias("app_id"),
            F.col("page").alias("page"),
            F.col("cursor").alias("cursor"),
            F.col("fetched_at").alias("fetched_at"),
        ),
        {"ignoreNullFields": "false"},
    )
    return js.substr(F.lit(2), F.length(js))


def is_object(review: Column) -> Column:
    """Whether a review element is a JSON object."""
    return F.json_object_keys(review).isNotNull()


def _own_members(review: Column) -> Column:
    """The review's text without members that the run adds itself; only a
    review that carries one of them is parsed and written anew."""
    clash = F.arrays_overlap(F.json_object_keys(review), F.array(*map(F.lit, LINEAGE_KEYS)))
    members = F.from_json(review, T.MapType(T.StringType(), T.VariantType()))
    return F.when(clash, F.to_json(F.map_filter(members, lambda k, _: ~k.isin(*LINEAGE_KEYS)))).otherwise(review)


def explode_reviews(admitted: DataFrame) -> DataFrame:
    """One row per review of the admitted pages, with its position and the
    landed payload: the review object with ``app_id``, ``page``, ``cursor``
    (the request cursor) and ``fetched_at`` set. An element that is no object
    has no payload."""
    rows = admitted.select(
        "app_id", "page", "cursor", "fetched_at", F.posexplode("reviews").alias("pos", "review")
    )
    review = _own_members(F.col("review"))
    body = F.regexp_replace(review, r"\}\s*$", "")
    empty = review.rlike(r"^\s*\{\s*\}\s*$")
    payload = F.concat(body, F.when(empty, F.lit("")).otherwise(F.lit(",")), _lineage_suffix())
    return rows.withColumn("payload", F.when(is_object(F.col("review")), payload))


def filter_reviews(
    reviews: DataFrame,
    language: str = "all",
    review_type: str = "all",
    purchase_type: str = "all",
) -> DataFrame:
    """The API's review filters applied to landed reviews; ``all`` = no predicate."""
    if review_type not in REVIEW_TYPES:
        raise ValueError(f"review_type must be one of {REVIEW_TYPES}")
    if purchase_type not in PURCHASE_TYPES:
        raise ValueError(f"purchase_type must be one of {PURCHASE_TYPES}")
    v = F.try_parse_json(F.col("review"))
    out = reviews
    if language != "all":
        out = out.filter(F.try_variant_get(v, "$.language", "string") == F.lit(language))
    if review_type != "all":
        voted = F.try_variant_get(v, "$.voted_up", "boolean")
        out = out.filter(voted if review_type == "positive" else ~voted)
    if purchase_type != "all":
        steam = F.try_variant_get(v, "$.steam_purchase", "boolean")
        out = out.filter(steam if purchase_type == "steam" else ~steam)
    return out


def review_fields(reviews: DataFrame) -> DataFrame:
    """Add ``recommendationid`` (text) and ``updated_at`` (epoch second -> UTC
    timestamp, NULL when not an integer) read from the review."""
    v = F.try_parse_json(F.col("review"))
    return reviews.withColumn("recommendationid", F.try_variant_get(v, "$.recommendationid", "string")).withColumn(
        "updated_at", epoch_to_timestamp(F.try_variant_get(v, "$.timestamp_updated", "bigint"))
    )
