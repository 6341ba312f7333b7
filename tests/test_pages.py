"""Page stops, cap and resume against a plain sequential read of the same pages."""

import datetime as dt
import json

import pytest

from reviewforge.operators import ingest as ING
from reviewforge.operators import pages as P
from reviewforge.sources import fixtures
from tests.conftest import SF_SMALL


def _sequential_read(app_pages, max_pages=None, start=1):
    """Brute force: the API read loop over landed pages of one app."""
    by_page = {p: body for p, _, body in app_pages}
    cursors = {p: c for p, c, _ in app_pages}
    page, out = start, []
    while page in by_page:
        env = json.loads(by_page[page])
        if env.get("success") != 1:
            break
        reviews = env.get("reviews", [])
        if not reviews:
            break
        out.append(page)
        nxt = env.get("cursor")
        if not nxt or nxt == cursors[page]:
            break
        page += 1
        if max_pages is not None and page > max_pages:
            break
    return out


@pytest.fixture(scope="module")
def landed(spark):
    pg = fixtures.page_envelopes(spark, SF_SMALL)
    rows = pg.select("app_id", "page", "cursor", "body").collect()  # small fixture only
    by_app = {}
    for r in rows:
        by_app.setdefault(r.app_id, []).append((r.page, r.cursor, r.body))
    return pg, by_app


@pytest.mark.parametrize("max_pages", [None, 2, 5])
def test_admitted_pages_match_sequential_read(spark, landed, max_pages):
    pg, by_app = landed
    got = {}
    for r in P.admit_pages(pg, max_pages).select("app_id", "page").collect():
        got.setdefault(r.app_id, []).append(r.page)
    for app, pages in by_app.items():
        assert sorted(got.get(app, [])) == _sequential_read(pages, max_pages), app


def test_stop_cases_reached(landed):
    """One app in five stops at its last page but one (page 2 at least); all others are read to the end."""
    _, by_app = landed
    kept_at_stop = {1: 0, 2: 0, 3: 1, 4: 1}  # whether the page of the stop is read
    seen = set()
    for app, pages in by_app.items():
        last = len(pages)
        stop = max(2, last - 1)
        case = int(app) % fixtures.STOP_MODULUS
        read = _sequential_read(pages)
        if case in kept_at_stop and stop <= last:
            seen.add(case)
            assert max(read) == stop - 1 + kept_at_stop[case], (app, read)
        else:
            assert len(read) == last
    assert seen == set(kept_at_stop)


def test_resume_reads_at_least_one_page(spark, landed):
    pg, by_app = landed
    resume = spark.createDataFrame([(a, 3) for a in by_app], "app_id string, resume_page int")
    got = {}
    for r in P.admit_pages(pg, 1, resume).select("app_id", "page").collect():
        got.setdefault(r.app_id, []).append(r.page)
    for app, pages in by_app.items():
        assert sorted(got.get(app, [])) == _sequential_read(pages, 1, start=3), app


def test_watermarks_and_zero_review_app(spark, landed):
    pg, _ = landed
    run = ING.ingest(pg, fixtures.requested_apps(pg), dt.datetime(2024, 2, 1, 6), ING.RunOptions(max_pages=2))
    wm = {r.appid: r for r in run.watermarks.collect()}
    assert wm[fixtures.EMPTY_APP_ID].cursor is None and wm[fixtures.EMPTY_APP_ID].review_count == 0
    full = [r for a, r in wm.items() if a != fixtures.EMPTY_APP_ID]
    assert all(r.cursor == "c1" and r.load_id == "20240201T060000" for r in full)  # page 2's request cursor


def test_payload_carries_fetch_metadata(spark, landed):
    pg, _ = landed
    row = P.explode_reviews(P.admit_pages(pg)).first()
    payload = json.loads(row.payload)
    review = json.loads(row.review)
    assert payload["app_id"] == row.app_id and payload["page"] == row.page and payload["cursor"] == row.cursor
    assert {k: v for k, v in payload.items() if k not in ("app_id", "page", "cursor", "fetched_at")} == review


def test_filters(spark, landed):
    pg, _ = landed
    y = P.explode_reviews(P.admit_pages(pg))
    with pytest.raises(ValueError):
        P.filter_reviews(y, review_type="great")
    f = P.filter_reviews(y, "german", "negative", "non_steam")
    for r in f.select("review").collect():
        d = json.loads(r.review)
        assert d["language"] == "german" and d["voted_up"] is False and d["steam_purchase"] is False


def test_strict_mode_raises_on_contract_break(spark):
    pg = fixtures.page_envelopes(spark, SF_SMALL, with_defects=True)
    with pytest.raises(ING.ContractViolation):
        ING.ingest(pg, fixtures.requested_apps(pg), dt.datetime(2024, 2, 1), ING.RunOptions(strict=True))
