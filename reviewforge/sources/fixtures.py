"""Test inputs derived from the provided tables by Spark.

Two fixtures (see FIXTURES.md):

* **L** - a review ledger with two loads, built from ``lineitem``;
* **P** - landed API page envelopes, built from ``events``.

Every value is produced with expressions the DuckDB oracle can repeat
character for character (integers, booleans and plain ASCII text only), so
hashes of the payload text agree across engines.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import epoch_to_timestamp, json_bool_text, timestamp_to_epoch_seconds
from ..operators.sequence import number_within
from ..plans.joins import join_per_key


# Fixed values of the fixture definitions (FIXTURES.md section 3).
FIXTURE_AS_OF = "2001-12-31"  # every ship date is before it, at every scale factor
FIXTURE_AS_OF_EPOCH = (_dt.date(2001, 12, 31) - _dt.date(1970, 1, 1)).days * 86400
FIXTURE_INGESTED_ON = "2002-01-01"  # load L1; load L2 one day later
APP_MODULUS = 300
PAGE_SIZE = 5
PAGES_FETCHED_AT = "2024-02-01T00:00:00"
EMPTY_APP_ID = "-1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _kv(key: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{key}":'), value)


def _obj(*pairs: Column) -> Column:
    """JSON object text from ``_kv`` pieces; a NULL piece (absent key) is skipped."""
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def _q(c: Column) -> Column:
    """JSON string literal of text known to need no escaping (digits, ASCII words)."""
    return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))


def _txt(c: Column) -> Column:
    return c.cast("string")


def _ledger_rows(li: DataFrame, load: int) -> DataFrame:
    ln = F.col("l_linenumber")
    days_later = load - 1
    created_epoch = F.col("_created_epoch")
    updated_epoch = created_epoch + F.lit(86400 * days_later)
    updated = epoch_to_timestamp(updated_epoch)
    ingested = F.date_add(F.lit(FIXTURE_INGESTED_ON).cast("date"), days_later)
    ingested_txt = F.concat(F.date_format(ingested, "yyyy-MM-dd"), F.lit("T00:00:00"))
    voted = F.col("l_returnflag") != F.lit("R")
    if load == 2:
        voted = ~voted
    cursor = F.lit("*") if load == 1 else F.lit("c1")
    appid = _txt(F.col("l_partkey") % APP_MODULUS)
    recid = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    author = F.when(ln == 4, F.lit("5")).otherwise(
        _obj(
            F.when(ln == 6, _kv("deck_playtime_at_review", F.lit("0"))),
            _kv("last_played", _txt(created_epoch - F.lit(86400))),
            _kv("num_games_owned", _txt(F.col("l_suppkey") % 50)),
            _kv("num_reviews", _txt(F.col("l_quantity"))),
            _kv("playtime_forever", _txt(F.col("l_partkey"))),
            _kv("playtime_last_two_weeks", _txt(ln * 10)),
            _kv("steamid", _q(F.col("l_suppkey"))),
        )
    )
    language = (
        F.when(F.col("l_returnflag") == "A", "english")
        .when(F.col("l_returnflag") == "N", "german")
        .otherwise("french")
    )
    wvs_digits = F.concat(F.lit("0."), _txt(ln))
    payload = _obj(
        _kv("app_id", _q(appid)),
        _kv("author", author),
        F.when(ln != 2, _kv("comment_count", _txt(F.col("l_orderkey") % 5))),
        _kv("cursor", _q(cursor)),
        _kv("fetched_at", _q(ingested_txt)),
        _kv("language", _q(language)),
        _kv("page", _txt(ln)),
        _kv("playtime_at_review", _txt(F.col("l_partkey") % 1000)),
        F.when(ln == 6, _kv("primarily_steam_deck", F.lit("false"))),
        _kv("received_for_free", json_bool_text(F.col("l_orderkey") % 7 == 0)),
        _kv("recommendationid", _q(recid)),
        _kv("review", _q(F.concat(F.lit("line "), F.col("l_returnflag"), F.col("l_linestatus")))),
        _kv("steam_purchase", json_bool_text(F.col("l_linestatus") == "F")),
        _kv("timestamp_created", _txt(created_epoch)),
        F.when(ln != 5, _kv("timestamp_updated", _txt(updated_epoch))),
        _kv("voted_up", json_bool_text(voted)),
        _kv("votes_funny", _txt(F.col("l_suppkey") % 3)),
        _kv("votes_up", F.when(ln == 7, F.lit('"bad"')).otherwise(_txt(ln))),
        _kv(
            "weighted_vote_score",
            F.when(F.col("l_orderkey") % 2 == 0, _q(wvs_digits)).otherwise(wvs_digits),
        ),
        _kv("written_during_early_access", json_bool_text(F.col("l_partkey") % 4 == 0)),
    )
    rows = li if load == 1 else li.filter(ln % 3 == 0)
    # payload is built in one projection and hashed in the next, so it is
    # computed once per row
    built = rows.select(
        appid.alias("appid"),
        recid.alias("recommendationid"),
        updated.alias("updated_at"),
        ingested.cast("timestamp_ntz").alias("ingested_at"),
        F.lit(f"L{load}").alias("load_id"),
        cursor.alias("cursor"),
        payload.alias("payload"),
    )
    return built.select(
        "appid", "recommendationid", "updated_at", "ingested_at", "load_id",
        F.sha2(F.col("payload"), 256).alias("hash_payload"), "cursor", "payload",
    )


def review_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture L: ledger rows ``(appid, recommendationid, updated_at, ingested_at,
    load_id, hash_payload, cursor, payload)`` from every ``lineitem`` row.

    Load L1 holds every row; load L2 a second version (one day later, vote
    flipped) of rows with ``l_linenumber % 3 = 0``. Review time of app ``k``
    (``l_partkey % 300``): the ship date's age at ``FIXTURE_AS_OF`` scaled by
    ``(k + 1) / 300``, so app tenures run from about a week to seven years and
    every half-life clamp regime occurs. Integer arithmetic throughout.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    age_seconds = F.datediff(F.lit(FIXTURE_AS_OF).cast("date"), F.col("l_shipdate")).cast("long") * F.lit(86400)
    scaled = F.floor(age_seconds * (F.col("l_partkey") % APP_MODULUS + 1) / APP_MODULUS)
    li = li.withColumn("_created_epoch", (F.lit(FIXTURE_AS_OF_EPOCH) - scaled).cast("long"))
    return _ledger_rows(li, 1).unionByName(_ledger_rows(li, 2))


# --------------------------------------------------------------------------
# Fixture P: page envelopes
# --------------------------------------------------------------------------

# An app per user; k is the app's number. One app in five stops,
# at its last page but one (page 2 at least), by case k % 20: 1 success=2,
# 2 empty page, 3 next cursor absent, 4 next cursor repeated. Contract defects
# hit rows with event_id % 11 == 0, kind (event_id // 11) % 6: 0 missing
# voted_up, 1 votes_up -1, 2 steam_purchase "yes", 3 review 42, 4 language
# null, 5 author 5. Event 1 has no recommendationid.
STOP_MODULUS = 20
DEFECT_MODULUS = 11
NULL_KEY_EVENT = 1


def _review_payload(with_defects: bool) -> Column:
    eid = F.col("event_id")
    defect = F.when((eid % DEFECT_MODULUS == 0) & F.lit(with_defects), F.floor(eid / DEFECT_MODULUS) % 6)
    created = timestamp_to_epoch_seconds(F.col("ts"))
    lang = F.when(eid % 3 == 0, "english").when(eid % 3 == 1, "german").otherwise("french")
    author = _obj(
        _kv("steamid", _q(F.col("user_id"))),
        _kv("num_games_owned", _txt(F.col("user_id") % 30)),
        _kv("num_reviews", F.lit("1")),
        _kv("playtime_forever", F.lit("100")),
    )
    return _obj(
        F.when(eid != NULL_KEY_EVENT, _kv("recommendationid", _q(eid))),
        _kv("language", F.when(defect == 4, F.lit("null")).otherwise(_q(lang))),
        _kv("review", F.when(defect == 3, F.lit("42")).otherwise(_q(F.col("event_type")))),
        _kv("timestamp_created", _txt(created)),
        _kv("timestamp_updated", _txt(created + F.lit(60))),
        F.when(defect.isNull() | (defect != 0), _kv("voted_up", json_bool_text(F.col("event_type") != "error"))),
        _kv("votes_up", F.when(defect == 1, F.lit("-1")).otherwise(_txt(eid % 7))),
        _kv("votes_funny", F.lit("0")),
        _kv("weighted_vote_score", F.lit('"0.5"')),
        _kv("comment_count", _txt(eid % 4)),
        _kv("steam_purchase", F.when(defect == 2, F.lit('"yes"')).otherwise(json_bool_text(eid % 2 == 0))),
        _kv("received_for_free", F.lit("false")),
        _kv("written_during_early_access", F.lit("false")),
        _kv("playtime_at_review", _txt(F.col("user_id") % 100)),
        _kv("author", F.when(defect == 5, F.lit("5")).otherwise(author)),
    )


def page_envelopes(spark: SparkSession, sf_dir: str, with_defects: bool = False) -> DataFrame:
    """Fixture P: ``(app_id, page, cursor, fetched_at, body)``, one row per landed page.

    Reviews of an app are ordered by ``(ts, event_id)`` and cut into pages of
    five; the numbering is spread over partitions (no per-app task) and the
    envelope of a page gathers at most five reviews.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    ev = ev.withColumn("app_id", _txt(F.col("user_id")))
    last = ev.groupBy("app_id").agg(F.ceil(F.count(F.lit(1)) / PAGE_SIZE).cast("int").alias("last_page"))
    ev = number_within(ev, ["app_id"], ["ts", "event_id"], out="rn")
    ev = ev.withColumn("page", (F.floor((F.col("rn") - 1) / PAGE_SIZE) + 1).cast("int"))
    ev = ev.withColumn("review", _review_payload(with_defects))
    pages = ev.groupBy("app_id", "page").agg(
        F.array_sort(F.collect_list(F.struct("rn", "review"))).alias("items")
    )
    pages = join_per_key(pages, last, "app_id")
    page = F.col("page")
    at_stop = page == F.greatest(F.lit(2), F.col("last_page") - 1)
    case = F.when(at_stop, F.col("app_id").cast("int") % STOP_MODULUS).otherwise(F.lit(0))
    request_cursor = F.when(page == 1, F.lit("*")).otherwise(F.concat(F.lit("c"), _txt(page - 1)))
    next_cursor = F.when(case == 4, request_cursor).otherwise(
        F.concat(F.lit("c"), _txt(page))
    )
    success = F.when(case == 1, F.lit("2")).otherwise(F.lit("1"))
    reviews = F.when(case == 2, F.lit("")).otherwise(
        F.array_join(F.transform("items", lambda x: x["review"]), ",")
    )
    body = _obj(
        _kv("success", success),
        F.when(case != 3, _kv("cursor", _q(next_cursor))),
        _kv("reviews", F.concat(F.lit("["), reviews, F.lit("]"))),
    )
    return pages.select(
        "app_id",
        "page",
        request_cursor.alias("cursor"),
        F.lit(PAGES_FETCHED_AT).alias("fetched_at"),
        body.alias("body"),
    )


def expected_pages(pages: DataFrame) -> DataFrame:
    """(appid, day, pages_expected): every page of fixture P, on the day of its run."""
    day = F.col("fetched_at").cast("timestamp_ntz").cast("date").alias("day")
    return pages.groupBy(F.col("app_id").alias("appid"), day).agg(F.count(F.lit(1)).alias("pages_expected"))


def landed_pages(pages: DataFrame) -> DataFrame:
    """Fixture P without the pages that were never fetched: all of one app in 13, one page in nine of the others."""
    app = F.col("app_id").cast("int")
    return pages.filter((app % 13 != 5) & ((app + F.col("page")) % 9 != 0))


def requested_apps(pages: DataFrame) -> DataFrame:
    """Apps a run asks for: every app with landed pages plus one without any."""
    spark = pages.sparkSession
    extra = spark.range(1).select(F.lit(EMPTY_APP_ID).alias("app_id"))
    return pages.select("app_id").distinct().unionByName(extra).distinct()


def ledger_with_defects(ledger: DataFrame) -> DataFrame:
    """Fixture L and copies of about 7 in 16 of its L1 rows, each with one defect.

    The first hex digit of the payload hash names it: 0 no review id, 1 no app,
    2 the id under the next app, 3 the same row again, 4 the same content in a
    later load, 5 no hash, 6 an empty payload. All but 3 are in load L3. A row and
    its copy come from one pass, so payload and hash are derived once.
    """
    digit = F.substring("hash_payload", 1, 1)
    again = digit == "3"
    next_app = ((F.col("appid").cast("int") + 1) % APP_MODULUS).cast("string")
    copy = F.struct(
        F.when(digit == "2", next_app).when(digit != "1", F.col("appid")).alias("appid"),
        F.when(digit != "0", F.col("recommendationid")).alias("recommendationid"),
        F.col("updated_at"),
        F.when(again, F.col("ingested_at")).otherwise(F.col("ingested_at") + F.expr("interval 2 days")).alias("ingested_at"),
        F.when(again, F.col("load_id")).otherwise(F.lit("L3")).alias("load_id"),
        F.when(digit != "5", F.col("hash_payload")).alias("hash_payload"),
        F.col("cursor"),
        F.when(digit == "6", F.lit("{}")).otherwise(F.col("payload")).alias("payload"),
    )
    row = F.struct(*[F.col(c) for c in ("appid", "recommendationid", "updated_at", "ingested_at", "load_id", "hash_payload", "cursor", "payload")])
    rows = F.when((F.col("load_id") == "L1") & (digit <= "6"), F.array(row, copy)).otherwise(F.array(row))
    return ledger.select(F.explode(rows).alias("_row")).select("_row.*")


def gold_with_defects(gold: DataFrame) -> DataFrame:
    """(app_id, avg_rating, edp_current) as a faulty build might leave them: apps
    twice or without a name, values missing or out of range."""
    app = F.col("app_id").cast("int")
    return gold.unionByName(gold.filter(app % 11 == 0)).select(
        F.when(app % 13 != 0, F.col("app_id")).alias("app_id"),
        F.when(app % 7 == 0, F.col("avg_rating") + 1.5).when(app % 5 != 0, F.col("avg_rating")).alias("avg_rating"),
        F.when(app % 3 == 0, F.lit(-0.5)).otherwise(F.col("edp_current")).alias("edp_current"),
    )


def ledger_with_drift(ledger: DataFrame) -> DataFrame:
    """Fixture L as if the API had changed before load L2: ``votes_funny`` as text,
    ``fetched_at`` under another name, and an object in an object of the author."""
    p = F.col("payload")
    p = F.regexp_replace(p, r'"votes_funny":([0-9]+)', r'"votes_funny":"$1"')
    p = F.replace(p, F.lit('"fetched_at"'), F.lit('"fetched"'))
    p = F.replace(p, F.lit('"num_reviews":'), F.lit('"device":{"deck":{"oled":true},"hours":[1.5]},"num_reviews":'))
    return ledger.withColumn("payload", F.when(F.col("load_id") == "L2", p).otherwise(F.col("payload")))
