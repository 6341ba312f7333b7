"""Registered queries: one Spark job per operator group, each with its DuckDB oracle.

Every query starts from the provided tables (``lineitem`` for the review
ledger fixture, ``events`` for the page fixture), so its work grows with them.
Float outputs are rounded to 6 decimals on both sides (sum order differs).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import compaction, enrich, metrics
from ..params import DecayParams
from ..session import apply_session_defaults, checkpoint_dir, written
from ..sources import fixtures
from . import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# As-of dates of the registered metric runs (FIXTURES.md section 3).
AS_OF_BASE = fixtures.FIXTURE_AS_OF  # all reviews before it
AS_OF_TUNED = "2002-06-30"  # half a year later: more ages reach the cap
AS_OF_BACKFILL = "2001-06-30"  # half a year earlier: later reviews have negative ages

BASE_PARAMS = DecayParams().with_as_of(AS_OF_BASE)
# Other fractions and clamps, overridden by name as the definitions allow.
TUNED_PARAMS = DecayParams(
    weight_age_cap_days=730.0, h_short_frac=0.04, h_long_frac=0.15, h_long_max_days=200.0, h_pos_min_days=14.0
).with_as_of(AS_OF_TUNED)
BACKFILL_PARAMS = DecayParams().with_as_of(AS_OF_BACKFILL)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _prep(spark: SparkSession) -> None:
    apply_session_defaults(spark)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return fixtures.review_ledger(spark, sf_dir)


def defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture L with defects, for the queries that look for them."""
    return fixtures.ledger_with_defects(ledger(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(compaction.compact_derived(ledger(spark, sf_dir), whole=True))


def narrow_silver(raw: DataFrame) -> DataFrame:
    """The silver columns gold reads, written once, so the two
    aggregation passes over a lazily derived silver do not each recompute
    the compaction window (and filters run over columns, not re-parsed
    payloads). Rows are typed before they are compacted: a version's columns
    depend on its own row alone, and so no payload is shuffled."""
    return written(compaction.compact_columns(enrich.enrich_votes(raw), metrics.GOLD_INPUT_COLUMNS), "silver")


def gold(spark: SparkSession, sf_dir: str, params: DecayParams) -> DataFrame:
    return metrics.adaptive_metrics(narrow_silver(ledger(spark, sf_dir)), params)


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


_CHAIN = [O.ledger_cte(), O.compacted_cte(), O.enriched_cte()]


# ------------------------------------------------------------ ledger models


@register("ledger_scan", _with(O.ledger_cte()) + f"select {O.LEDGER_COLS} from ledger")
def q_ledger_scan(spark, sf_dir):
    return compaction.ledger_scan(ledger(spark, sf_dir))


@register("compact_latest", _with(O.ledger_cte(), O.compacted_cte()) + "select * from compacted")
def q_compact_latest(spark, sf_dir):
    return compaction.compact_derived(ledger(spark, sf_dir))


@register(
    "version_history",
    _with(O.ledger_cte(), O.defects_cte(), O.compacted_cte("defects", "versions", "appid, recommendationid, hash_payload"))
    + "select * from versions",
)
def q_version_history(spark, sf_dir):
    return compaction.compact_derived(defects(spark, sf_dir), compaction.VERSION_KEY)


@register("enriched_reviews", _with(*_CHAIN) + "select * from silver")
def q_enriched_reviews(spark, sf_dir):
    return round_doubles(silver(spark, sf_dir))


# --------------------------------------------------------------- gold parts


@register(
    "app_bounds",
    _with(*_CHAIN, O.gold_ctes(BASE_PARAMS)) + "select app_id, born as first_review_at, newest as latest_review_at, moved as record_changed_at, "
    "touched as latest_review_updated_at from gold_life",
)
def q_app_bounds(spark, sf_dir):
    return metrics.app_bounds(metrics.eligible_reviews(narrow_silver(ledger(spark, sf_dir))))


@register(
    "app_half_lives",
    _with(*_CHAIN, O.gold_ctes(BASE_PARAMS))
    + "select app_id, round(days, 6) as tenure_days, round(short_half, 6) as h_short, "
    "round(long_half, 6) as h_long, round(pos_half, 6) as h_pos, round(ln(2) / short_half, 6) as lambda_short, "
    "round(ln(2) / long_half, 6) as lambda_long, round(ln(2) / pos_half, 6) as lambda_pos from gold_life",
)
def q_app_half_lives(spark, sf_dir):
    bounds = metrics.app_bounds(metrics.eligible_reviews(narrow_silver(ledger(spark, sf_dir))))
    hl = metrics.app_half_lives(bounds, BASE_PARAMS)
    return round_doubles(
        hl.select("app_id", "tenure_days", "h_short", "h_long", "h_pos", "lambda_short", "lambda_long", "lambda_pos")
    )


@register(
    "decay_weights",
    _with(*_CHAIN, O.gold_ctes(BASE_PARAMS))
    + "select app_id, vote as y, round(age, 6) as age_days, round(ln(2) / short_half, 6) as lambda_short, "
    "round(ln(2) / long_half, 6) as lambda_long, round(ln(2) / pos_half, 6) as lambda_pos "
    "from gold_votes join gold_life using (app_id)",
)
def q_decay_weights(spark, sf_dir):
    reviews = metrics.eligible_reviews(narrow_silver(ledger(spark, sf_dir)))
    lambdas = metrics.app_half_lives(metrics.app_bounds(reviews), BASE_PARAMS)
    w = metrics.decay_weights(reviews, lambdas, BASE_PARAMS)
    return round_doubles(w.select("app_id", "y", "age_days", "lambda_short", "lambda_long", "lambda_pos"))


@register(
    "weighted_sums",
    _with(*_CHAIN, O.gold_ctes(BASE_PARAMS))
    + "select app_id, round(pos_ups, 6) as w_pos_num, round(pos_all, 6) as w_pos_den, "
    "round(recent, 6) as ew_short, round(lasting, 6) as ew_long from gold_halved",
)
def q_weighted_sums(spark, sf_dir):
    reviews = metrics.eligible_reviews(narrow_silver(ledger(spark, sf_dir)))
    lambdas = metrics.app_half_lives(metrics.app_bounds(reviews), BASE_PARAMS)
    return round_doubles(metrics.weighted_sums(metrics.decay_weights(reviews, lambdas, BASE_PARAMS)))


def _gold_sql(params: DecayParams) -> str:
    chain = [O.ledger_cte(), O.compacted_cte(), O.enriched_cte()]
    return _with(*chain, O.gold_ctes(params)) + f"select {O.GOLD_SELECT_ROUNDED} from gold"


@register("adaptive_metrics", _gold_sql(BASE_PARAMS))
def q_adaptive_metrics(spark, sf_dir):
    return round_doubles(gold(spark, sf_dir, BASE_PARAMS))


@register("adaptive_metrics_tuned", _gold_sql(TUNED_PARAMS))
def q_adaptive_metrics_tuned(spark, sf_dir):
    return round_doubles(gold(spark, sf_dir, TUNED_PARAMS))


@register("adaptive_metrics_backfill", _gold_sql(BACKFILL_PARAMS))
def q_adaptive_metrics_backfill(spark, sf_dir):
    return round_doubles(gold(spark, sf_dir, BACKFILL_PARAMS))


# ------------------------------------------------------------- ingest side

import datetime as _dt  # noqa: E402

from ..operators import ingest as ING  # noqa: E402
from ..operators import pages as PG  # noqa: E402

# The run start of the registered ingest runs and their caps.
RUN_TS = _dt.datetime(2024, 2, 1, 6, 0, 0)
RUN_LOAD_ID = ING.load_id_for(RUN_TS)
FIRST_RUN_MAX_PAGES = 3
SECOND_RUN_MAX_PAGES = 7
FILTER_LANGUAGE = "english"


def pages(spark: SparkSession, sf_dir: str, with_defects: bool = False) -> DataFrame:
    """Fixture P, materialized once like the landed-pages table it stands for
    (ingest reads it several times: stops, resume, explode)."""
    _prep(spark)
    return written(fixtures.page_envelopes(spark, sf_dir, with_defects), "pages")


def _yielded(spark, sf_dir, with_defects=False, max_pages=None, resume=None):
    pg = pages(spark, sf_dir, with_defects)
    return pg, PG.explode_reviews(PG.admit_pages(pg, max_pages, resume))


_PAGES = [O.pages_cte(False)]
_PAGES_DEFECTS = [O.pages_cte(True)]


@register(
    "page_explode",
    _with(*_PAGES, O.admitted_ctes(), O.exploded_cte())
    + "select app_id, page, pos, cursor, fetched_at, payload from yielded",
)
def q_page_explode(spark, sf_dir):
    _, y = _yielded(spark, sf_dir)
    return y.select("app_id", "page", "pos", "cursor", "fetched_at", "payload")


@register(
    "page_cap_resume",
    _with(
        *_PAGES,
        O.admitted_ctes(name="run1", max_pages=FIRST_RUN_MAX_PAGES),
        O.exploded_cte(src="run1", name="run1_y"),
        """run1_wm as (select app_id, arg_max(cursor, page * 1000000 + pos) filter (where cursor is not null and cursor <> '') as cursor
    from run1_y group by app_id),
resume as (select p.app_id, min(p.page) as resume_page from pages p join run1_wm w on p.app_id = w.app_id and p.cursor = w.cursor group by p.app_id)""",
        O.admitted_ctes(name="run2", max_pages=SECOND_RUN_MAX_PAGES, resume="resume"),
    )
    + "select app_id, page, cursor, cast(n_reviews as bigint) as n_reviews from run2",
)
def q_page_cap_resume(spark, sf_dir):
    pg = pages(spark, sf_dir)
    requested = fixtures.requested_apps(pg)
    run1 = ING.ingest(pg, requested, RUN_TS, ING.RunOptions(max_pages=FIRST_RUN_MAX_PAGES, validate=False))
    resume = ING.resume_points(run1.watermarks, pg)
    run2 = PG.admit_pages(pg, SECOND_RUN_MAX_PAGES, resume)
    return run2.select("app_id", "page", "cursor", F.size("reviews").cast("long").alias("n_reviews"))


@register(
    "source_filters",
    _with(*_PAGES, O.admitted_ctes(), O.exploded_cte())
    + f"select app_id, page, pos, review ->> 'recommendationid' as recommendationid from yielded "
    f"where review ->> 'language' = '{FILTER_LANGUAGE}' and review ->> 'voted_up' = 'true' "
    "and review ->> 'steam_purchase' = 'true'",
)
def q_source_filters(spark, sf_dir):
    _, y = _yielded(spark, sf_dir)
    f = PG.filter_reviews(y, FILTER_LANGUAGE, "positive", "steam")
    return PG.review_fields(f).select("app_id", "page", "pos", "recommendationid")


@register(
    "contract_check",
    _with(*_PAGES_DEFECTS, O.admitted_ctes(), O.exploded_cte())
    + f"select app_id, page, pos, {O.violations_sql()} as violations, "
    f"{O.violations_sql()} = '' as valid from yielded",
)
def q_contract_check(spark, sf_dir):
    _, y = _yielded(spark, sf_dir, with_defects=True)
    c = ING.with_violations(y)
    return c.select("app_id", "page", "pos", "violations", (F.col("violations") == F.lit("")).alias("valid"))


@register(
    "ledger_rows",
    _with(*_PAGES, O.admitted_ctes(), O.exploded_cte())
    + f"""select app_id as appid, recommendationid, updated_at,
    TIMESTAMP '{RUN_TS.isoformat(sep=' ')}' as ingested_at, '{RUN_LOAD_ID}' as load_id, cursor, payload,
    {O.payload_hash_sql()} as hash_payload
from (select *, {O.review_fields_sql()} from yielded) where app_id is not null and recommendationid is not null""",
)
def q_ledger_rows(spark, sf_dir):
    pg = pages(spark, sf_dir)
    run = ING.ingest(pg, fixtures.requested_apps(pg), RUN_TS, ING.RunOptions(validate=False))
    return run.ledger


@register(
    "payload_hash",
    _with(*_PAGES, O.admitted_ctes(), O.exploded_cte())
    + f"""select app_id as appid, recommendationid, {O.payload_hash_sql()} as hash_payload
from (select *, {O.review_fields_sql()} from yielded) where app_id is not null and recommendationid is not null""",
)
def q_payload_hash(spark, sf_dir):
    pg = pages(spark, sf_dir)
    run = ING.ingest(pg, fixtures.requested_apps(pg), RUN_TS, ING.RunOptions(validate=False))
    return run.ledger.select("appid", "recommendationid", "hash_payload")


@register(
    "load_watermarks",
    _with(*_PAGES, O.admitted_ctes(), O.exploded_cte(), O.requested_apps_cte())
    + f"""select r.app_id as appid, '{RUN_LOAD_ID}' as load_id, w.cursor, w.max_updated_at,
    TIMESTAMP '{RUN_TS.isoformat(sep=' ')}' as recorded_at, coalesce(w.review_count, 0)::bigint as review_count
from requested r left join (
    select app_id, arg_max(cursor, page * 1000000 + pos) filter (where cursor is not null and cursor <> '') as cursor,
        max(updated_at) as max_updated_at, count(*) as review_count
    from (select *, {O.review_fields_sql()} from yielded where {O.violations_sql()} = '') group by app_id
) w using (app_id)""",
)
def q_load_watermarks(spark, sf_dir):
    pg = pages(spark, sf_dir)
    run = ING.ingest(pg, fixtures.requested_apps(pg), RUN_TS)
    return run.watermarks


# ------------------------------------------------------------ metric layer

from ..operators import quality as DQ  # noqa: E402
from ..operators import semantic as SEM  # noqa: E402

_METRICS = ["avg_rating", "edp_current", "decay_ewrr", "cult_score", "total_reviews"]
_GOLD_BASE = [O.ledger_cte(), O.compacted_cte(), O.enriched_cte(), O.gold_ctes(BASE_PARAMS)]
_METRIC_SELECT = ("round(avg(avg_rating), 6) as avg_rating, round(avg(edp_current), 6) as edp_current, "
                  "round(avg(decay_ewrr), 6) as decay_ewrr, round(avg(cult_score), 6) as cult_score, "
                  "max(total_reviews) as total_reviews")


def _metric_query(group_by):
    def fn(spark, sf_dir):
        g = gold(spark, sf_dir, BASE_PARAMS)
        return round_doubles(SEM.query_metrics(g, _METRICS, group_by))

    return fn


register("metric_by_app", _with(*_GOLD_BASE) + f"select app_id, {_METRIC_SELECT} from gold group by app_id")(
    _metric_query(["app_id"])
)
register(
    "metric_by_day", _with(*_GOLD_BASE) + f"select snapshot_date, {_METRIC_SELECT} from gold group by snapshot_date"
)(_metric_query(["snapshot_date"]))
register(
    "metric_by_month",
    _with(*_GOLD_BASE)
    + f"select cast(date_trunc('month', snapshot_date) as timestamp) as snapshot_date__month, {_METRIC_SELECT} "
    "from gold group by 1",
)(_metric_query(["snapshot_date__month"]))
register("metric_total", _with(*_GOLD_BASE) + f"select {_METRIC_SELECT} from gold")(_metric_query([]))


# ------------------------------------------------------------ quality checks


def _dq(test: str):
    def fn(spark, sf_dir):
        # the ledger feeds three layers here: materialize it once, as the
        # stored ledger table would be, if a check of this kind looks at them
        checks = [c for c in DQ.CHECKS if c.test == test]
        tables = {"fct_steam_review_metrics_adaptive": fixtures.gold_with_defects(gold(spark, sf_dir, BASE_PARAMS))}
        if any(c.model not in tables for c in checks):
            raw = written(defects(spark, sf_dir), "ledger")
            comp = compaction.compact_stored(raw)
            tables |= {"steam_reviews_raw": raw, "steam_reviews_raw_compacted": comp, "steam_reviews_enriched": enrich.enrich(comp)}
        models = dict.fromkeys(c.model for c in checks)
        return DQ.run_checks({m: tables[m] for m in models}, checks)

    return fn


_MODEL_CTE = {
    "steam_reviews_raw": "defects",
    "steam_reviews_raw_compacted": "compacted_defects",
    "steam_reviews_enriched": "silver_defects",
    "fct_steam_review_metrics_adaptive": "gold_defects",
}
_DEFECTS = [
    O.defects_cte(),
    O.compacted_cte("defects", "compacted_defects"),
    O.enriched_cte("compacted_defects", "silver_defects"),
    O.gold_defects_cte(),
]


def _dq_sql(test: str) -> str:
    parts = []
    for c in DQ.CHECKS:
        if c.test != test:
            continue
        t = _MODEL_CTE[c.model]
        if test == "not_null":
            cnt = f"(select count(*) from {t} where {c.column} is null)"
        elif test == "unique":
            cnt = (f"(select count(*) from (select {c.column} from {t} where {c.column} is not null "
                   f"group by {c.column} having count(*) > 1))")
        else:
            cnt = (f"(select count(*) from {t} where not ({c.column} >= {c.min_value} "
                   f"and {c.column} <= {c.max_value}))")
        parts.append(f"select '{c.model}' as model, '{c.column}' as column_name, '{c.test}' as test_name, "
                     f"cast({cnt} as bigint) as failures")
    return _with(*_GOLD_BASE, *_DEFECTS) + "\nunion all\n".join(parts)


for _t in ("not_null", "unique", "accepted_range"):
    _key = {"not_null": "dq_not_null", "unique": "dq_unique", "accepted_range": "dq_range"}[_t]
    register(_key, _dq_sql(_t))(_dq(_t))


# -------------------------------------------------------------- indicators

from ..operators import drift as DR  # noqa: E402
from ..operators import indicators as K  # noqa: E402
from ..sources import ledger as ST  # noqa: E402

FRESHNESS_AS_OF = "2002-01-03 09:00:00"


@register(
    "freshness",
    _with(O.ledger_cte())
    + f"""select appid, max(ingested_at) as last_landed_at,
    round((epoch_us(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch_us(max(ingested_at))) / 86400000000.0 * 1440.0, 6) as lag_minutes
from ledger group by appid""",
)
def q_freshness(spark, sf_dir):
    return round_doubles(K.freshness(ledger(spark, sf_dir), FRESHNESS_AS_OF))


@register(
    "completeness",
    _with(*_PAGES, O.admitted_ctes(), O.exploded_cte())
    + f"""select e.appid, e.day, coalesce(g.n, 0)::bigint as pages_ingested, e.n::bigint as pages_expected,
    round(coalesce(g.n, 0) / e.n, 6) as completeness
from (select app_id as appid, cast(try_cast(fetched_at as timestamp) as date) as day, count(distinct page) as n
      from pages group by 1, 2) e
left join (select app_id as appid, cast(TIMESTAMP '{RUN_TS.isoformat(sep=' ')}' as date) as day, count(distinct page) as n
      from (select *, {O.review_fields_sql()} from yielded) where recommendationid is not null group by 1, 2) g
  using (appid, day)""",
)
def q_completeness(spark, sf_dir):
    pg = pages(spark, sf_dir)
    run = ING.ingest(pg, fixtures.requested_apps(pg), RUN_TS, ING.RunOptions(validate=False))
    return round_doubles(K.completeness(run.ledger, pg))


@register(
    "completeness_expected",
    _with(
        *_PAGES,
        "landed as (select * from pages where cast(app_id as int) % 13 <> 5 and (cast(app_id as int) + page) % 9 <> 0)",
        O.admitted_ctes("landed"),
        O.exploded_cte(),
    )
    + f"""select e.appid, e.day, coalesce(g.n, 0)::bigint as pages_ingested, e.n::bigint as pages_expected,
    round(coalesce(g.n, 0) / e.n, 6) as completeness
from (select app_id as appid, cast(cast(fetched_at as timestamp) as date) as day, count(*) as n
      from pages group by 1, 2) e
left join (select app_id as appid, cast(TIMESTAMP '{RUN_TS.isoformat(sep=' ')}' as date) as day, count(distinct page) as n
      from (select *, {O.review_fields_sql()} from yielded) where recommendationid is not null group by 1, 2) g
  using (appid, day)""",
)
def q_completeness_expected(spark, sf_dir):
    every = pages(spark, sf_dir)
    pg = fixtures.landed_pages(every)
    run = ING.ingest(pg, fixtures.requested_apps(every), RUN_TS, ING.RunOptions(validate=False))
    return round_doubles(K.completeness(run.ledger, expected=fixtures.expected_pages(every)))


@register(
    "late_rate",
    _with(O.ledger_cte(), O.enriched_cte(src="ledger"))
    + """select bronze_load_id, count(*) as reviews,
    round(avg(case when (epoch_us(bronze_ingested_at) - epoch_us(review_created_at)) / 86400000000.0 > 7.0
              then 1.0 else 0.0 end), 6) as late_rate
from silver where review_created_at is not null group by bronze_load_id""",
)
def q_late_rate(spark, sf_dir):
    return round_doubles(K.late_rate(enrich.enrich(ledger(spark, sf_dir))))


@register(
    "dup_rate",
    _with(O.ledger_cte(), O.defects_cte())
    + """select load_id, sum(n)::bigint as rows, count(*)::bigint as distinct_keys,
    round(1.0 - count(*) / sum(n), 6) as dup_rate
from (select load_id, appid, recommendationid, count(*) as n from defects group by 1, 2, 3) group by load_id""",
)
def q_dup_rate(spark, sf_dir):
    return round_doubles(K.dup_rate(defects(spark, sf_dir)))


def _drift_sql() -> str:
    from ..functions.contract import AUTHOR_PROPERTY_TYPES, CONTRACT_KEYS

    top = ", ".join(f"'{k}'" for k in CONTRACT_KEYS)
    auth = ", ".join(f"'{k}'" for k, _ in AUTHOR_PROPERTY_TYPES)
    return _with(O.ledger_cte()) + f"""select load_id, scope, drift_key, count(*)::bigint as rows from (
    select load_id, '$' as scope, unnest(json_keys(payload)) as drift_key from ledger
    union all
    select load_id, '$.author' as scope, unnest(json_keys(payload, '$.author')) as drift_key from ledger
        where json_type(payload, '$.author') = 'OBJECT'
) where (scope = '$' and drift_key not in ({top})) or (scope = '$.author' and drift_key not in ({auth}))
group by 1, 2, 3"""


@register("drift_keys", _drift_sql())
def q_drift_keys(spark, sf_dir):
    return K.drift_keys(ledger(spark, sf_dir))


@register("payload_paths", _with(O.ledger_cte(), O.drift_cte(), O.paths_cte()) + "select * from paths")
def q_payload_paths(spark, sf_dir):
    return DR.payload_paths(fixtures.ledger_with_drift(ledger(spark, sf_dir)))


@register(
    "schema_drift",
    _with(O.ledger_cte(), O.drift_cte(), O.paths_cte())
    + """select 'L2' as load_id, path, case when types_before is null then 'new' when types_now is null then 'gone' else 'retyped' end as change,
    types_before, types_now, coalesce(rows, 0)::bigint as rows
from (select path, string_agg(type, '|' order by type) as types_before from paths where load_id = 'L1' group by path)
full join (select path, string_agg(type, '|' order by type) as types_now, sum(rows) as rows from paths where load_id = 'L2' group by path)
    using (path) where types_before is distinct from types_now""",
)
def q_schema_drift(spark, sf_dir):
    return DR.schema_drift(fixtures.ledger_with_drift(ledger(spark, sf_dir)))


# The oracle knows nothing of the merge: it compacts both loads together.
@register(
    "incremental_upsert",
    _with(O.ledger_cte(), O.compacted_cte(), O.enriched_cte()) + "select * from silver",
)
def q_incremental_upsert(spark, sf_dir):
    raw = ledger(spark, sf_dir)
    # the stored table and the staged batch are written, as they would be in production
    existing = written(enrich.enrich(compaction.compact_derived(raw.filter(F.col("load_id") == "L1"))), "silver")
    batch = written(enrich.enrich(raw.filter(F.col("load_id") == "L2")), "batch")
    return round_doubles(K.incremental_upsert(existing, batch))


# ----------------------------------------------------------------- storage

SCHEMA_V2_TAG = "v2"


@register(
    "schema_evolution_append",
    _with(O.ledger_cte())
    + f"""select * from (select appid, recommendationid, updated_at, ingested_at, load_id, hash_payload, cursor, payload
    from ledger where load_id = 'L1')
union all by name
select appid, recommendationid, updated_at, ingested_at, load_id, hash_payload, payload, '{SCHEMA_V2_TAG}' as source_version
from ledger where load_id = 'L2'""",
)
def q_schema_evolution_append(spark, sf_dir):
    raw = ledger(spark, sf_dir)
    old = raw.filter(F.col("load_id") == "L1")
    new = raw.filter(F.col("load_id") == "L2").drop("cursor").withColumn("source_version", F.lit(SCHEMA_V2_TAG))
    return ST.append_new_columns(old, new)


@register(
    "widened_append",
    _with(O.ledger_cte(), O.enriched_cte(src="ledger"))
    + """select app_id, recommendationid, cast(helpful_votes as bigint) as helpful_votes, cast(comment_count as double) as comment_count,
    cast(page as varchar) as page, voted_up, cast(null as varchar) as review_language from silver where bronze_load_id = 'L1'
union all by name
select app_id, recommendationid, cast(helpful_votes as bigint) * 4000000000 as helpful_votes, comment_count + 0.5 as comment_count,
    'p' || page as page, review_language from silver where bronze_load_id = 'L2'""",
)
def q_widened_append(spark, sf_dir):
    """Two loads of silver columns appended; in the second a count is a bigint, another a double, the page a text, one column is new and one gone."""
    from ..sources import evolving as EV

    s = enrich.enrich(ledger(spark, sf_dir)).select(
        "app_id", "recommendationid", "helpful_votes", "comment_count", "page", "voted_up", "review_language", "bronze_load_id"
    )
    s = written(s, "silver")
    first = s.filter(F.col("bronze_load_id") == "L1").drop("bronze_load_id", "review_language")
    second = s.filter(F.col("bronze_load_id") == "L2").select(
        "app_id",
        "recommendationid",
        (F.col("helpful_votes").cast("bigint") * 4000000000).alias("helpful_votes"),
        (F.col("comment_count") + F.lit(0.5)).alias("comment_count"),
        F.concat(F.lit("p"), F.col("page")).alias("page"),
        "review_language",
    )
    base = _fresh_paths(spark).silver
    EV.append_batch(first, base, "L1")
    EV.append_batch(second, base, "L2")
    return EV.read_evolved(spark, base)


@register(
    "landing_roundtrip",
    _with(*_PAGES, O.admitted_ctes(), O.exploded_cte())
    + f"select payload, app_id, '{RUN_LOAD_ID}' as load_id from yielded",
)
def q_landing_roundtrip(spark, sf_dir):
    """Write one run's landing files to the shared checkpoint folder and read them back."""
    import uuid

    pg = pages(spark, sf_dir)
    run = ING.ingest(pg, fixtures.requested_apps(pg), RUN_TS, ING.RunOptions(validate=False))
    path = f"{checkpoint_dir(spark).rstrip('/')}/landing-{uuid.uuid4().hex}"
    ST.write_landing(run.reviews, path, RUN_LOAD_ID)
    return ST.read_landing(spark, path)


def _fresh_paths(spark: SparkSession):
    """A new set of layer folders in the shared checkpoint folder."""
    import uuid

    from .pipeline import Paths

    return Paths(f"{checkpoint_dir(spark).rstrip('/')}/layers-{uuid.uuid4().hex}")


def _built(spark: SparkSession, sf_dir: str):
    """Fixture L in a stored ledger, and the checked and published models over it."""
    from . import pipeline

    paths = _fresh_paths(spark)
    ST.prepare_storage(spark, paths.ledger, paths.watermarks)
    ST.append_ledger(ledger(spark, sf_dir), paths.ledger)
    pipeline.build_models(spark, paths, BASE_PARAMS, version="v1")
    return paths


@register("stored_ledger", ORACLE["ledger_scan"])
def q_stored_ledger(spark, sf_dir):
    """The ledger appended to its table twice under the same loads, and read back."""
    paths = _fresh_paths(spark)
    ST.prepare_storage(spark, paths.ledger, paths.watermarks)
    for _ in range(2):
        ST.append_ledger(ledger(spark, sf_dir), paths.ledger)
    ST.prepare_storage(spark, paths.ledger, paths.watermarks)
    return compaction.ledger_scan(ST.read_ledger(spark, paths.ledger))


@register(
    "stored_watermarks",
    f"select appid, load_id, cursor, max_updated_at, recorded_at from ({ORACLE['load_watermarks']})",
)
def q_stored_watermarks(spark, sf_dir):
    """One whole ingest run into stored tables; its watermarks read back."""
    from . import pipeline

    pg = pages(spark, sf_dir)
    paths = _fresh_paths(spark)
    pipeline.run_ingest(spark, pg, fixtures.requested_apps(pg), paths, RUN_TS)
    return ST.read_watermarks(spark, paths.watermarks)


@register(
    "streamed_watermarks",
    f"select appid, cursor, max_updated_at from ({ORACLE['load_watermarks']}) where review_count > 0",
)
def q_streamed_watermarks(spark, sf_dir):
    """One run's landing files read as a stream; the last watermarks in its state. An app without reviews lands no file."""
    import uuid

    from ..streaming.watermarks import latest_watermarks, stream_watermarks

    pg = pages(spark, sf_dir)
    run = ING.ingest(pg, fixtures.requested_apps(pg), RUN_TS)
    paths = _fresh_paths(spark)
    ST.write_landing(run.reviews, paths.landing, RUN_LOAD_ID)
    run.release()
    state = f"{checkpoint_dir(spark).rstrip('/')}/state-{uuid.uuid4().hex}"
    stream_watermarks(spark, paths.landing, paths.watermarks, state).awaitTermination()
    return latest_watermarks(ST.read_watermarks(spark, paths.watermarks))


@register("published_gold", ORACLE["adaptive_metrics"])
def q_published_gold(spark, sf_dir):
    """Gold of the gated build, read through its SQL view."""
    from . import pipeline

    views = pipeline.register_views(spark, _built(spark, sf_dir))
    return round_doubles(spark.sql(f"select * from {views['gold']}"))


@register(
    "metric_default_time",
    _with(*_GOLD_BASE)
    + f"select cast(snapshot_date as timestamp) as metric_time, {_METRIC_SELECT} from gold group by snapshot_date",
)
def q_metric_default_time(spark, sf_dir):
    """Metrics by the model's default time dimension, after the check of its primary entity."""
    published = ST.read_current(spark, _built(spark, sf_dir).gold)
    SEM.check_primary_entity(published)
    return round_doubles(SEM.query_metrics(published, _METRICS, ["metric_time"]))


@register("compact_stored", ORACLE["compact_latest"])
def q_compact_stored(spark, sf_dir):
    """Fixture L in a stored ledger, compacted by row locators; payloads are fetched last."""
    _prep(spark)
    paths = _fresh_paths(spark)
    ST.prepare_storage(spark, paths.ledger, paths.watermarks)
    ST.append_ledger(ledger(spark, sf_dir), paths.ledger)
    return compaction.compact_stored(ST.ledger_files(spark, paths.ledger))


@register("bucketed_upsert", ORACLE["incremental_upsert"])
def q_bucketed_upsert(spark, sf_dir):
    """Silver of the first load in hash buckets, the second merged into those that it touches; read by the manifest."""
    from ..sources import buckets as BK

    raw = ledger(spark, sf_dir)
    base = _fresh_paths(spark).silver
    for load, version in (("L1", "v1"), ("L2", "v2")):
        BK.merge_buckets(enrich.enrich(raw.filter(F.col("load_id") == load)), base, version)
    return round_doubles(BK.read_buckets(spark, base))


# The oracle knows nothing of the refresh: it builds gold from both loads at once.
@register("refreshed_gold", ORACLE["adaptive_metrics"])
def q_refreshed_gold(spark, sf_dir):
    """Gold of the first load, brought up to date after the second was merged into silver."""
    from ..sources import buckets as BK
    from . import refresh

    raw = ledger(spark, sf_dir)
    paths = _fresh_paths(spark)
    for load, version in (("L1", "v1"), ("L2", "v2")):
        batch = enrich.enrich(raw.filter(F.col("load_id") == load))
        BK.merge_buckets(batch, paths.silver, version, bucket_by=refresh.APP_BUCKETS)
        done = refresh.refresh_gold(spark, paths.silver, paths.gold, version, BASE_PARAMS)
    return round_doubles(done.gold)


# The oracle knows nothing of cursors: it admits the pages as they were before they were renumbered and landed twice.
@register("linked_pages", ORACLE["page_explode"])
def q_linked_pages(spark, sf_dir):
    """Pages without usable numbers, some landed before with other contents, read by following their cursors."""
    from ..operators import cursors as CU

    pg = pages(spark, sf_dir)
    unnumbered = pg.withColumn("page", F.pmod(F.xxhash64("cursor", "app_id"), F.lit(7)).cast("int"))
    stale = unnumbered.filter(F.length("cursor") % 2 == 0).withColumn("fetched_at", F.lit("2000-01-01T00:00:00"))
    stale = stale.withColumn("body", F.lit('{"success": 1, "cursor": "c1", "reviews": [{"recommendationid": "stale"}]}'))
    admitted = CU.admit_linked(unnumbered.unionByName(stale))
    return PG.explode_reviews(admitted).select("app_id", "page", "pos", "cursor", "fetched_at", "payload")


def _sketched(spark: SparkSession, sf_dir: str):
    """Fixture L with defects in a stored ledger, and the sketches of its loads."""
    from ..sources import distinct as DI

    paths = _fresh_paths(spark)
    sketches = f"{paths.ledger}_sketches"
    ST.append_ledger(defects(spark, sf_dir), paths.ledger)
    stored = ST.read_ledger(spark, paths.ledger)
    DI.record_loads(stored, sketches)
    return DI.read_sketches(spark, sketches), stored


@register("dup_rate_sketched", ORACLE["dup_rate"])
def q_dup_rate_sketched(spark, sf_dir):
    """Duplicate rates of the loads from their stored sketches; loads too large for them are counted."""
    from ..sources import distinct as DI

    return round_doubles(DI.dup_rate(*_sketched(spark, sf_dir)))


@register(
    "repeated_ids",
    _with(O.ledger_cte(), *_DEFECTS[:3])
    + """select count(*)::bigint as failures from (
    select recommendationid from silver_defects where recommendationid is not null group by 1 having count(*) > 1)""",
)
def q_repeated_ids(spark, sf_dir):
    """The uniqueness check of silver over three loads, from their stored sketches; suspect buckets are counted."""
    from ..sources import distinct as DI

    return DI.repeated_ids(*_sketched(spark, sf_dir))
