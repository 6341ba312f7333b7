"""Silver layer: flatten the JSON payload of compacted ledger rows into 31 typed columns.

The payload is parsed once per row with ``from_json`` into an all-text
struct (Catalyst prunes the schema to the fields actually used), then each
field is coerced with the try-cast rules of ``functions.casts``.
Missing flags default to false and missing counters to 0; timestamps,
``weighted_vote_score`` and ``page`` stay NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import (
    epoch_to_timestamp,
    text_to_bool,
    text_to_double,
    text_to_int,
    text_to_timestamp,
)

_S = T.StringType()

AUTHOR_TEXT_SCHEMA = T.StructType(
    [
        T.StructField(k, _S)
        for k in (
            "steamid",
            "num_games_owned",
            "num_reviews",
            "playtime_forever",
            "playtime_last_two_weeks",
            "playtime_at_review",
            "last_played",
        )
    ]
)

PAYLOAD_TEXT_SCHEMA = T.StructType(
    [
        T.StructField(k, _S)
        for k in (
            "recommendationid",
            "language",
            "review",
            "timestamp_created",
            "timestamp_updated",
            "fetched_at",
            "voted_up",
            "votes_up",
            "votes_funny",
            "weighted_vote_score",
            "comment_count",
            "steam_purchase",
            "received_for_free",
            "written_during_early_access",
            "playtime_at_review",
            "page",
            "app_id",
            "cursor",
        )
    ]
    + [T.StructField("author", AUTHOR_TEXT_SCHEMA)]
)

SILVER_COLUMNS = [
    "recommendationid",
    "app_id",
    "review_language",
    "review",
    "review_created_at",
    "review_updated_at",
    "fetched_at",
    "voted_up",
    "helpful_votes",
    "funny_votes",
    "weighted_vote_score",
    "comment_count",
    "steam_purchase",
    "received_for_free",
    "written_during_early_access",
    "playtime_at_review_minutes",
    "author_steam_id",
    "author_games_owned",
    "author_review_count",
    "author_playtime_forever_minutes",
    "author_playtime_last_two_weeks_minutes",
    "author_playtime_at_review_minutes",
    "author_last_played_epoch",
    "author_last_played_at",
    "page",
    "cursor",
    "record_changed_at",
    "bronze_ingested_at",
    "bronze_load_id",
    "bronze_hash_payload",
    "is_deleted",
]


def parse_payload_text(payload: str = "payload", fields: list[str] | None = None):
    """The payload as an all-text struct (JSON null or absent -> NULL), or ``fields`` of it."""
    schema = PAYLOAD_TEXT_SCHEMA if fields is None else T.StructType([PAYLOAD_TEXT_SCHEMA[f] for f in fields])
    return F.from_json(F.col(payload), schema)


# The payload's fields behind the change and creation times and the vote: what gold needs of a payload.
VOTE_FIELDS = ["timestamp_created", "timestamp_updated", "voted_up"]


def _flag(c):
    return F.coalesce(text_to_bool(c), F.lit(False))


def _timed(parsed: DataFrame) -> DataFrame:
    """The two epochs of a parsed payload as timestamps ``_created`` and ``_updated``, each text cast once."""
    p = F.col("_p")
    seconds = parsed.select(
        "*",
        text_to_double(p["timestamp_created"]).alias("_created_s"),
        text_to_double(p["timestamp_updated"]).alias("_updated_s"),
    )
    return seconds.select("*", epoch_to_timestamp("_created_s").alias("_created"), epoch_to_timestamp("_updated_s").alias("_updated"))


def _review_updated_at():
    return F.coalesce(F.col("_updated"), F.col("updated_at"))


def _record_changed_at():
    return F.coalesce(F.col("_updated"), F.col("updated_at"), F.col("_created"), F.col("ingested_at"))


def enrich_votes(ledger: DataFrame) -> DataFrame:
    """Ledger columns without the payload, and the silver columns that gold reads (``metrics.GOLD_INPUT_COLUMNS``).

    The rules are those of ``enrich``; only the payload's fields behind these columns are parsed.
    """
    rows = _timed(ledger.withColumn("_p", parse_payload_text(fields=VOTE_FIELDS)))
    return rows.select(
        *[c for c in ledger.columns if c != "payload"],
        F.col("appid").alias("app_id"),
        F.col("_created").alias("review_created_at"),
        _review_updated_at().alias("review_updated_at"),
        _record_changed_at().alias("record_changed_at"),
        _flag(F.col("_p.voted_up")).alias("voted_up"),
        F.lit(False).alias("is_deleted"),
    )


def enrich(compacted: DataFrame) -> DataFrame:
    """Compacted ledger -> the 31-column silver table.

    Projections one after the other: parse the payload once, cast the three
    epoch fields once, convert them once, then type and rename. (Filters on
    silver columns should run over a written or checkpointed silver: Catalyst
    pushes a filter below the projections by re-inlining the parse into the
    predicate.)
    """
    p = F.col("_p")
    a = F.col("_p.author")

    def flag(field):
        return _flag(p[field])

    def count(c):
        return F.coalesce(text_to_int(c), F.lit(0))

    parsed = compacted.withColumn("_p", parse_payload_text())
    epochs = _timed(parsed.withColumn("_last_played", text_to_double(a["last_played"])))
    created, last_played = F.col("_created"), F.col("_last_played")
    return epochs.select(
        F.col("recommendationid"),
        F.col("appid").alias("app_id"),
        p["language"].alias("review_language"),
        p["review"].alias("review"),
        created.alias("review_created_at"),
        _review_updated_at().alias("review_updated_at"),
        text_to_timestamp(p["fetched_at"]).alias("fetched_at"),
        flag("voted_up").alias("voted_up"),
        count(p["votes_up"]).alias("helpful_votes"),
        count(p["votes_funny"]).alias("funny_votes"),
        text_to_double(p["weighted_vote_score"]).alias("weighted_vote_score"),
        count(p["comment_count"]).alias("comment_count"),
        flag("steam_purchase").alias("steam_purchase"),
        flag("received_for_free").alias("received_for_free"),
        flag("written_during_early_access").alias("written_during_early_access"),
        count(p["playtime_at_review"]).alias("playtime_at_review_minutes"),
        a["steamid"].alias("author_steam_id"),
        count(a["num_games_owned"]).alias("author_games_owned"),
        count(a["num_reviews"]).alias("author_review_count"),
        count(a["playtime_forever"]).alias("author_playtime_forever_minutes"),
        count(a["playtime_last_two_weeks"]).alias("author_playtime_last_two_weeks_minutes"),
        count(a["playtime_at_review"]).alias("author_playtime_at_review_minutes"),
        last_played.alias("author_last_played_epoch"),
        epoch_to_timestamp(last_played).alias("author_last_played_at"),
        text_to_int(p["page"]).alias("page"),
        F.col("cursor"),
        _record_changed_at().alias("record_changed_at"),
        F.col("ingested_at").alias("bronze_ingested_at"),
        F.col("load_id").alias("bronze_load_id"),
        F.col("hash_payload").alias("bronze_hash_payload"),
        F.lit(False).alias("is_deleted"),
    )
