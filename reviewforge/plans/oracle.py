"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each function returns SQL text over the pre-registered views (``lineitem``,
``events``). The fixture derivations are repeated here so that the oracle
starts from the same raw tables as the Spark jobs; the model SQL follows the
metric definitions with naive (UTC) timestamps throughout. Float outputs
are rounded to 6 decimals on both sides because sum order differs.
"""

from __future__ import annotations

import json
import math

from ..params import DecayParams
from ..sources.fixtures import (
    APP_MODULUS,
    DEFECT_MODULUS,
    EMPTY_APP_ID,
    FIXTURE_AS_OF,
    FIXTURE_AS_OF_EPOCH,
    FIXTURE_INGESTED_ON,
    NULL_KEY_EVENT,
    PAGE_SIZE,
    PAGES_FETCHED_AT,
    STOP_MODULUS,
)


def _obj(*pieces: str) -> str:
    """JSON object text from SQL pieces; a piece evaluating to '' is skipped."""
    arr = ", ".join(pieces)
    return f"('{{' || array_to_string(list_filter([{arr}], lambda x: x <> ''), ',') || '}}')"


def _kv(key: str, value: str) -> str:
    return f"""('"{key}":' || {value})"""


def _q(value: str) -> str:
    return f"""('"' || {value} || '"')"""


def _b(cond: str) -> str:
    return f"(case when {cond} then 'true' else 'false' end)"


def _t(value: str) -> str:
    return f"cast({value} as varchar)"


# ---------------------------------------------------------------- fixture L

QUOTED_ZERO = "'0'"
QUOTED_FALSE = "'false'"


def _ledger_load(load: int) -> str:
    days = load - 1
    created = "created_epoch"
    upd = f"({created} + {86400 * days})"
    ingested = f"(DATE '{FIXTURE_INGESTED_ON}' + {days})"
    ingested_txt = f"(strftime({ingested}, '%Y-%m-%d') || 'T00:00:00')"
    voted = "l_returnflag <> 'R'" if load == 1 else "not (l_returnflag <> 'R')"
    cursor = "'*'" if load == 1 else "'c1'"
    appid = f"cast(l_partkey % {APP_MODULUS} as varchar)"
    recid = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)"
    author = (
        "(case when l_linenumber = 4 then '5' else "
        + _obj(
            f"(case when l_linenumber = 6 then {_kv('deck_playtime_at_review', QUOTED_ZERO)} else '' end)",
            _kv("last_played", _t(f"{created} - 86400")),
            _kv("num_games_owned", _t("l_suppkey % 50")),
            _kv("num_reviews", _t("l_quantity")),
            _kv("playtime_forever", _t("l_partkey")),
            _kv("playtime_last_two_weeks", _t("l_linenumber * 10")),
            _kv("steamid", _q(_t("l_suppkey"))),
        )
        + " end)"
    )
    lang = "(case when l_returnflag = 'A' then 'english' when l_returnflag = 'N' then 'german' else 'french' end)"
    wvs = "('0.' || cast(l_linenumber as varchar))"
    payload = _obj(
        _kv("app_id", _q(appid)),
        _kv("author", author),
        f"(case when l_linenumber = 2 then '' else {_kv('comment_count', _t('l_orderkey % 5'))} end)",
        _kv("cursor", _q(cursor)),
        _kv("fetched_at", _q(ingested_txt)),
        _kv("language", _q(lang)),
        _kv("page", _t("l_linenumber")),
        _kv("playtime_at_review", _t("l_partkey % 1000")),
        f"(case when l_linenumber = 6 then {_kv('primarily_steam_deck', QUOTED_FALSE)} else '' end)",
        _kv("received_for_free", _b("l_orderkey % 7 = 0")),
        _kv("recommendationid", _q(recid)),
        _kv("review", _q("('line ' || l_returnflag || l_linestatus)")),
        _kv("steam_purchase", _b("l_linestatus = 'F'")),
        _kv("timestamp_created", _t(created)),
        f"(case when l_linenumber = 5 then '' else {_kv('timestamp_updated', _t(upd))} end)",
        _kv("voted_up", _b(voted)),
        _kv("votes_funny", _t("l_suppkey % 3")),
        _kv("votes_up", "(case when l_linenumber = 7 then '\"bad\"' else cast(l_linenumber as varchar) end)"),
        _kv("weighted_vote_score", f"(case when l_orderkey % 2 = 0 then {_q(wvs)} else {wvs} end)"),
        _kv("written_during_early_access", _b("l_partkey % 4 = 0")),
    )
    where = "" if load == 1 else "where l_linenumber % 3 = 0"
    return f"""
    select {appid} as appid, {recid} as recommendationid,
           make_timestamp({upd} * 1000000) as updated_at,
           cast({ingested} as timestamp) as ingested_at,
           'L{load}' as load_id, sha256(payload) as hash_payload, {cursor} as cursor, payload
    from (select *, {payload} as payload from li) {where}"""


def ledger_cte(name: str = "ledger") -> str:
    """CTE text defining fixture L as ``name``."""
    li = f"""li as (
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus, l_shipdate,
        {FIXTURE_AS_OF_EPOCH} - (datediff('day', l_shipdate, DATE '{FIXTURE_AS_OF}') * 86400
            * (l_partkey % {APP_MODULUS} + 1)) // {APP_MODULUS} as created_epoch
    from lineitem)"""
    return f"{li},\n{name} as ({_ledger_load(1)}\n    union all{_ledger_load(2)}\n)"


# ------------------------------------------------------------- model layers

LEDGER_COLS = "appid, recommendationid, updated_at, ingested_at, load_id, hash_payload, cursor, payload"

_ORDER = "coalesce(updated_at, ingested_at) desc nulls last, ingested_at desc nulls last, load_id desc nulls last, hash_payload desc nulls last"


def compacted_cte(src: str = "ledger", name: str = "compacted", key: str = "appid, recommendationid") -> str:
    return f"""{name} as (
    select {LEDGER_COLS} from (
        select {LEDGER_COLS}, row_number() over (partition by {key} order by {_ORDER}) as row_num
        from {src}) where row_num = 1)"""


def _ts(epoch: str) -> str:
    """Epoch seconds (double) -> naive timestamp, truncated to microseconds."""
    return f"(case when abs({epoch}) <= 253402300799.0 then make_timestamp(cast(trunc({epoch} * 1000000.0) as bigint)) end)"


def _dbl(text: str) -> str:
    return f"(case when regexp_matches({text}, '^\\s*[+-]?[0-9]*\\.?[0-9]+([eE][+-]?[0-9]+)?[dDfF]\\s*$') then null else try_cast({text} as double) end)"


# The silver columns by type rule: output name -> place in the payload (fixed values of the column contract).
_SILVER_TEXT = {"review_language": "language", "review": "review", "author_steam_id": "author.steamid"}
_SILVER_COUNT = {
    "helpful_votes": "votes_up",
    "funny_votes": "votes_funny",
    "comment_count": "comment_count",
    "playtime_at_review_minutes": "playtime_at_review",
    "author_games_owned": "author.num_games_owned",
    "author_review_count": "author.num_reviews",
    "author_playtime_forever_minutes": "author.playtime_forever",
    "author_playtime_last_two_weeks_minutes": "author.playtime_last_two_weeks",
    "author_playtime_at_review_minutes": "author.playtime_at_review",
}
_SILVER_FLAG = {n: n for n in ("voted_up", "steam_purchase", "received_for_free", "written_during_early_access")}
_SILVER_NUMBER = {"weighted_vote_score": "weighted_vote_score", "author_last_played_epoch": "author.last_played"}
_SILVER_EPOCH = {"_created": "timestamp_created", "_updated": "timestamp_updated"}


def _silver_shape() -> str:
    """The payload's shape for json_transform: every field as text."""
    top: dict = {"page": "VARCHAR", "fetched_at": "VARCHAR", "author": {}}
    for places in (_SILVER_TEXT, _SILVER_COUNT, _SILVER_FLAG, _SILVER_NUMBER, _SILVER_EPOCH):
        for place in places.values():
            outer, _, inner = place.rpartition(".")
            (top[outer] if outer else top)[inner] = "VARCHAR"
    return json.dumps(top)


def enriched_cte(src: str = "compacted", name: str = "silver") -> str:
    """Silver from the column contract: the payload is parsed once into a
    struct of texts, and every column is its type's rule over one text."""
    rules = {
        **{out: f"p.{at}" for out, at in _SILVER_TEXT.items()},
        **{out: f"ifnull(try_cast(p.{at} as integer), 0)" for out, at in _SILVER_COUNT.items()},
        **{out: f"ifnull(try_cast(p.{at} as boolean), false)" for out, at in _SILVER_FLAG.items()},
        **{out: _dbl(f"p.{at}") for out, at in _SILVER_NUMBER.items()},
        **{out: _ts(_dbl(f"p.{at}")) for out, at in _SILVER_EPOCH.items()},
        "page": "try_cast(p.page as integer)",
        "fetched_at": "try_cast(p.fetched_at as timestamp)",
    }
    typed = ", ".join(f"{rule} as {out}" for out, rule in rules.items())
    return f"""{name}_parsed as (select * exclude (payload), json_transform(payload, '{_silver_shape()}') as p from {src}),
{name}_typed as (select * exclude (p), {typed} from {name}_parsed),
{name} as (
    select * exclude (_created, _updated, appid, updated_at, ingested_at, load_id, hash_payload),
        appid as app_id, false as is_deleted, _created as review_created_at,
        ifnull(_updated, updated_at) as review_updated_at, {_ts("author_last_played_epoch")} as author_last_played_at,
        coalesce(_updated, updated_at, _created, ingested_at) as record_changed_at,
        ingested_at as bronze_ingested_at, load_id as bronze_load_id, hash_payload as bronze_hash_payload
    from {name}_typed)"""


def _days(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 86400000000.0)"


def _clamp(expr: str, lo: float, hi: float) -> str:
    return f"least({float(hi)!r}, greatest({float(lo)!r}, {expr}))"


def gold_ctes(params: DecayParams, src: str = "silver", name: str = "gold") -> str:
    """

    A weight is the share of a half-life that is left, ``0.5 ^ (age / half-life)``,
    not an exponential of a rate. ``{name}_votes``: a row per counted review;
    ``{name}_life``: a row per app with its span and half-lives; ``{name}_halved``:
    the sums; ``{name}``: the metrics.
    """
    now = f"cast(DATE '{params.as_of.isoformat()}' as timestamp)" if params.as_of else "cast(current_date as timestamp)"

    def half_life(kind: str) -> str:
        share, least, most = (getattr(params, f"h_{kind}_{part}") for part in ("frac", "min_days", "max_days"))
        return f"{_clamp(f'{share!r} * days', least, most)} as {kind}_half"

    def halved(kind: str, of: str = "1.0") -> str:
        return f"sum({of} * pow(0.5::double, age / {kind}_half))"

    return f"""{name}_votes as (
    select app_id, review_created_at as created, review_updated_at as updated, record_changed_at as changed,
        coalesce(voted_up, false)::int::double as vote,
        least({float(params.weight_age_cap_days)!r}, {_days("review_created_at", now)}) as age
    from {src} where review_created_at is not null and is_deleted is distinct from true),
{name}_life as (
    select *, {half_life("short")}, {half_life("long")}, {half_life("pos")} from (
        select app_id, min(created) as born, max(created) as newest, max(updated) as touched, max(changed) as moved,
            greatest(1.0, {_days("min(created)", now)}) as days
        from {name}_votes group by app_id)),
{name}_halved as (
    select app_id, count(*) as n, sum(vote) as ups, {halved("pos", "vote")} as pos_ups, {halved("pos")} as pos_all,
        {halved("short")} as recent, {halved("long")} as lasting
    from {name}_votes join {name}_life using (app_id) group by app_id),
{name} as (
    select app_id, born as first_review_at, newest as latest_review_at, touched as latest_review_updated_at,
        moved as record_changed_at, date_trunc('day', moved) as snapshot_date, n as total_reviews, ups / n as avg_rating,
        case when pos_all <> 0 then pos_ups / pos_all end as edp_current,
        case when lasting <> 0 then recent / lasting end as decay_ewrr,
        ups / n / (ln(1 + n) / ln(10)) as cult_score,
        short_half as half_life_short_days, long_half as half_life_long_days, pos_half as half_life_pos_days
    from {name}_halved join {name}_life using (app_id))"""


def r6(col: str, alias: str | None = None) -> str:
    return f"round({col}, 6) as {alias or col}"


GOLD_SELECT_ROUNDED = ", ".join(
    [
        "app_id", "first_review_at", "latest_review_at", "latest_review_updated_at", "record_changed_at",
        "snapshot_date", "total_reviews",
        r6("avg_rating"), r6("edp_current"), r6("decay_ewrr"), r6("cult_score"),
        r6("half_life_short_days"), r6("half_life_long_days"), r6("half_life_pos_days"),
    ]
)


# ---------------------------------------------------------------- fixture P


NOT_ERROR = "event_type <> 'error'"


def pages_cte(with_defects: bool = False, name: str = "pages") -> str:
    """CTE text defining fixture P (page envelopes) as ``name``."""
    d = "true" if with_defects else "false"
    created = "(epoch_us(ts) // 1000000)"
    defect = f"(case when event_id % {DEFECT_MODULUS} = 0 and {d} then (event_id // {DEFECT_MODULUS}) % 6 end)"
    lang = "(case when event_id % 3 = 0 then 'english' when event_id % 3 = 1 then 'german' else 'french' end)"
    author = _obj(
        _kv("steamid", _q(_t("user_id"))),
        _kv("num_games_owned", _t("user_id % 30")),
        _kv("num_reviews", "'1'"),
        _kv("playtime_forever", "'100'"),
    )
    review = _obj(
        f"(case when event_id = {NULL_KEY_EVENT} then '' else {_kv('recommendationid', _q(_t('event_id')))} end)",
        _kv("language", f"(case when {defect} = 4 then 'null' else {_q(lang)} end)"),
        _kv("review", f"(case when {defect} = 3 then '42' else {_q('event_type')} end)"),
        _kv("timestamp_created", _t(created)),
        _kv("timestamp_updated", _t(f"{created} + 60")),
        f"(case when {defect} = 0 then '' else {_kv('voted_up', _b(NOT_ERROR))} end)",
        _kv("votes_up", f"(case when {defect} = 1 then '-1' else {_t('event_id % 7')} end)"),
        _kv("votes_funny", "'0'"),
        _kv("weighted_vote_score", "'\"0.5\"'"),
        _kv("comment_count", _t("event_id % 4")),
        _kv("steam_purchase", f"(case when {defect} = 2 then '\"yes\"' else {_b('event_id % 2 = 0')} end)"),
        _kv("received_for_free", "'false'"),
        _kv("written_during_early_access", "'false'"),
        _kv("playtime_at_review", _t("user_id % 100")),
        _kv("author", f"(case when {defect} = 5 then '5' else {author} end)"),
    )
    case = f"(case when page = greatest(2, last_page - 1) then cast(app_id as integer) % {STOP_MODULUS} else 0 end)"
    req = "(case when page = 1 then '*' else 'c' || cast(page - 1 as varchar) end)"
    nxt = f"(case when {case} = 4 then {req} else 'c' || cast(page as varchar) end)"
    success = f"(case when {case} = 1 then '2' else '1' end)"
    reviews = f"(case when {case} = 2 then '' else items end)"
    body = _obj(
        _kv("success", success),
        f"(case when {case} = 3 then '' else {_kv('cursor', _q(nxt))} end)",
        _kv("reviews", f"('[' || {reviews} || ']')"),
    )
    return f"""{name}_ev as (
    select event_id, ts, user_id, event_type, cast(user_id as varchar) as app_id,
           row_number() over (partition by cast(user_id as varchar) order by ts, event_id) as rn
    from events),
{name}_rv as (
    select app_id, cast(floor((rn - 1) / {PAGE_SIZE}) + 1 as integer) as page, rn, {review} as review
    from {name}_ev),
{name}_pg as (
    select app_id, page, string_agg(review, ',' order by rn) as items, max(page) over (partition by app_id) as last_page
    from {name}_rv group by app_id, page),
{name} as (
    select app_id, page, {req} as cursor, '{PAGES_FETCHED_AT}' as fetched_at, {body} as body
    from {name}_pg)"""


def requested_apps_cte(pages: str = "pages", name: str = "requested") -> str:
    return f"""{name} as (select distinct app_id from {pages} union select '{EMPTY_APP_ID}' as app_id)"""


# ------------------------------------------------------------- ingest side


def admitted_ctes(pages: str = "pages", name: str = "admitted", max_pages: int | None = None,
                  resume: str | None = None) -> str:
    """Page gates, stops, cap and resume over ``pages`` -> admitted pages."""
    start = "coalesce(rs.resume_page, 1)" if resume else "1"
    join_resume = f"left join {resume} rs using (app_id)" if resume else ""
    cap = f"and page <= greatest({int(max_pages)}, start_page)" if max_pages is not None else ""
    return f"""{name}_env as (
    select p.app_id, p.page, p.cursor, p.fetched_at, p.body, {start} as start_page,
        coalesce((json_type(p.body, '$.success') in ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE')
                  and cast(json_extract(p.body, '$.success') as double) = 1)
                 or (json_type(p.body, '$.success') = 'BOOLEAN' and cast(json_extract(p.body, '$.success') as boolean)),
                 false) as success_ok,
        p.body ->> 'cursor' as next_cursor,
        json_array_length(p.body, '$.reviews') as n_reviews
    from {pages} p {join_resume}),
{name}_live as (select * from {name}_env where page >= start_page),
{name}_stops as (
    select app_id,
        min(case when not success_ok or coalesce(n_reviews, 0) = 0 then page end) as stop_bad,
        min(case when next_cursor is null or next_cursor = '' or next_cursor = cursor then page end) as stop_chain,
        min(page) as first_page
    from {name}_live group by app_id),
{name}_gaps as (
    select l.app_id, min(l.page) as stop_gap from {name}_live l
    where not exists (select 1 from {name}_live n where n.app_id = l.app_id and n.page = l.page + 1)
    group by l.app_id),
{name} as (
    select l.* from {name}_live l join {name}_stops s using (app_id) join {name}_gaps g using (app_id)
    where first_page = start_page and page <= stop_gap
      and (stop_bad is null or page < stop_bad) and (stop_chain is null or page <= stop_chain) {cap})"""


def exploded_cte(src: str = "admitted", name: str = "yielded") -> str:
    """One row per review with its landed payload (review + fetch metadata)."""
    return f"""{name}_x as (
    select app_id, page, cursor, fetched_at,
        unnest(list_transform(from_json(json_extract(body, '$.reviews'), '["JSON"]'), lambda r, i: {{'r': r, 'i': i}})) as x
    from {src}),
{name} as (
    select app_id, page, cast(x.i - 1 as integer) as pos, cursor, fetched_at, cast(x.r as varchar) as review,
        regexp_replace(cast(x.r as varchar), '\\}}\\s*$', '')
        || case when regexp_matches(cast(x.r as varchar), '^\\s*\\{{\\s*\\}}\\s*$') then '' else ',' end
        || '"app_id":' || coalesce(cast(to_json(app_id) as varchar), 'null')
        || ',"page":' || coalesce(cast(page as varchar), 'null')
        || ',"cursor":' || coalesce(cast(to_json(cursor) as varchar), 'null')
        || ',"fetched_at":' || coalesce(cast(to_json(fetched_at) as varchar), 'null') || '}}' as payload
    from {name}_x)"""


def _jt(path: str) -> str:
    return f"json_type(review, '{path}')"


def _jint_ok(path: str) -> str:
    t = _jt(path)
    return (f"({t} in ('BIGINT', 'UBIGINT', 'HUGEINT') or ({t} = 'DOUBLE' and "
            f"cast(json_extract(review, '{path}') as double) = floor(cast(json_extract(review, '{path}') as double))))")


def _type_ok_sql(path: str, kind: str) -> str:
    t = _jt(path)
    if kind == "string":
        return f"({t} = 'VARCHAR')"
    if kind == "boolean":
        return f"({t} = 'BOOLEAN')"
    if kind == "object":
        return f"({t} = 'OBJECT')"
    if kind == "string|number":
        return f"({t} in ('VARCHAR', 'BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE'))"
    return _jint_ok(path)


def _rules_sql(prefix: str, required, types) -> list[str]:
    out = []
    for key in required:
        out.append(f"case when {_jt('$.' + prefix + key)} is null then 'required:{prefix}{key}' end")
    for key, kind in types:
        path = f"$.{prefix}{key}"
        present = f"{_jt(path)} is not null"
        ok = _type_ok_sql(path, kind)
        out.append(f"case when {present} and not {ok} then 'type:{prefix}{key}' end")
        if kind.startswith("integer>="):
            lo = float(kind.split(">=")[1])
            out.append(f"case when {present} and {ok} and cast(json_extract(review, '{path}') as double) < {lo} "
                       f"then 'minimum:{prefix}{key}' end")
    return out


def violations_sql() -> str:
    from ..functions.contract import (
        AUTHOR_PROPERTY_TYPES,
        AUTHOR_REQUIRED_KEYS,
        PROPERTY_TYPES,
        REQUIRED_KEYS,
    )

    top = ", ".join(_rules_sql("", REQUIRED_KEYS, PROPERTY_TYPES))
    author = ", ".join(_rules_sql("author.", AUTHOR_REQUIRED_KEYS, AUTHOR_PROPERTY_TYPES))
    return (f"(case when json_type(review) = 'OBJECT' then concat_ws(',', {top}, "
            f"case when {_jt('$.author')} = 'OBJECT' then nullif(concat_ws(',', {author}), '') end) "
            f"else 'type:$' end)")


def review_fields_sql() -> str:
    return ("review ->> 'recommendationid' as recommendationid, "
            "make_timestamp(try_cast(json_extract(review, '$.timestamp_updated') as bigint) * 1000000) as updated_at")


def defects_cte(name: str = "defects") -> str:
    """Fixture L with a defect in a copy of some L1 rows, told by the first digit of the hash."""
    return f"""{name} as (
    select * from ledger
    union all by name
    select case digit when '1' then null when '2' then cast((cast(appid as integer) + 1) % {APP_MODULUS} as varchar) else appid end as appid,
        if(digit = '0', null, recommendationid) as recommendationid, updated_at,
        if(digit = '3', ingested_at, ingested_at + interval 2 day) as ingested_at,
        if(digit = '3', load_id, 'L3') as load_id,
        if(digit = '5', null, hash_payload) as hash_payload, cursor,
        if(digit = '6', '{{}}', payload) as payload
    from (select *, hash_payload[1] as digit from ledger) where load_id = 'L1' and digit <= '6')"""


def drift_cte(name: str = "drifted") -> str:
    """Fixture L with the payloads of load L2 changed."""
    changed = """replace(replace(regexp_replace(payload, '"votes_funny":([0-9]+)', '"votes_funny":"\\1"'), '"fetched_at"', '"fetched"'),
        '"num_reviews":', '"device":{"deck":{"oled":true},"hours":[1.5]},"num_reviews":')"""
    return f"{name} as (select * exclude (payload), if(load_id = 'L2', {changed}, payload) as payload from ledger)"


def paths_cte(src: str = "drifted", name: str = "paths") -> str:
    """Every node of every payload, walked as a tree."""
    return f"""{name} as (
    select load_id, regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[*]', 'g') as path,
        case t.type when 'VARCHAR' then 'string' when 'DOUBLE' then 'number' when 'UBIGINT' then 'integer'
            when 'BIGINT' then 'integer' else lower(t.type) end as type, count(*) as rows
    from {src}, json_tree({src}.payload) t group by 1, 2, 3)"""


def gold_defects_cte(name: str = "gold_defects") -> str:
    return f"""{name} as (
    select if(k % 13 = 0, null, app_id) as app_id,
        case when k % 7 = 0 then avg_rating + 1.5 when k % 5 <> 0 then avg_rating end as avg_rating,
        if(k % 3 = 0, -0.5, edp_current) as edp_current
    from (select *, cast(app_id as integer) as k, unnest(if(cast(app_id as integer) % 11 = 0, [1, 2], [1])) from gold))"""


def _sorted_object(text: str, nested: tuple[str, ...] = ()) -> str:
    """JSON text of an object with its keys sorted; ``nested`` keys are objects treated alike."""
    value = f"cast(json_extract({text}, '$.\"' || k || '\"') as varchar)"
    for key in nested:
        inner = f"json_extract({text}, '$.{key}')"
        value = f"case when k = '{key}' and json_type({inner}) = 'OBJECT' then {_sorted_object(inner)} else {value} end"
    members = f"list_transform(list_sort(json_keys({text})), lambda k: cast(to_json(k) as varchar) || ': ' || {value})"
    return f"('{{' || array_to_string({members}, ', ') || '}}')"


def payload_hash_sql() -> str:
    return f"sha256({_sorted_object('payload', ('author',))})"
