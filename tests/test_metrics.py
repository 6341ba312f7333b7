"""Gold metrics: hand-worked cases and invariants."""

import datetime as dt
import math

from pyspark.sql import functions as F

from reviewforge.operators import metrics as M
from reviewforge.params import DecayParams

SILVER_SCHEMA = (
    "app_id string, review_created_at timestamp_ntz, review_updated_at timestamp_ntz, "
    "record_changed_at timestamp_ntz, voted_up boolean, is_deleted boolean"
)


def _silver(spark, rows):
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def test_single_review_at_as_of(spark):
    t = dt.datetime(2024, 3, 1)
    g = M.adaptive_metrics(_silver(spark, [("a", t, t, t, True, False)]), DecayParams().with_as_of("2024-03-01")).first()
    assert g.total_reviews == 1 and g.avg_rating == 1.0
    assert (g.half_life_short_days, g.half_life_long_days, g.half_life_pos_days) == (7.0, 30.0, 30.0)
    assert math.isclose(g.cult_score, 1 / math.log10(2))
    assert g.edp_current == 1.0 and g.decay_ewrr == 1.0
    assert g.snapshot_date == dt.datetime(2024, 3, 1)


def test_old_reviews_weigh_equally(spark):
    old = dt.datetime(2020, 1, 1)
    rows = [("a", old + dt.timedelta(days=i), None, old, i % 3 == 0, False) for i in range(9)]
    g = M.adaptive_metrics(_silver(spark, rows), DecayParams().with_as_of("2024-01-01")).first()
    assert math.isclose(g.edp_current, g.avg_rating)
    assert math.isclose(g.decay_ewrr, math.exp(-(math.log(2) / 30) * 365) / math.exp(-(math.log(2) / 180) * 365))


def test_filters_and_deleted(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t, t, t, True, False), ("a", None, t, t, False, False), ("a", t, t, t, False, True)]
    g = M.adaptive_metrics(_silver(spark, rows), DecayParams().with_as_of("2024-01-02")).first()
    assert g.total_reviews == 1 and g.avg_rating == 1.0


def test_invariants_on_fixture(spark):
    from reviewforge.plans.queries import BASE_PARAMS, gold
    from tests.conftest import SF_SMALL

    g = gold(spark, SF_SMALL, BASE_PARAMS)
    bad = g.filter(
        (F.col("avg_rating") < 0) | (F.col("avg_rating") > 1)
        | (F.col("edp_current") < 0) | (F.col("edp_current") > 1 + 1e-12)
        | (F.col("decay_ewrr") > 1 + 1e-12)
        | ~F.col("half_life_short_days").between(7, 30)
        | ~F.col("half_life_long_days").between(30, 180)
        | ~F.col("half_life_pos_days").between(30, 120)
    )
    assert g.count() > 0 and bad.count() == 0


def test_backfill_allows_weight_above_one(spark):
    t = dt.datetime(2024, 1, 10)
    g = M.adaptive_metrics(_silver(spark, [("a", t, t, t, True, False)]), DecayParams().with_as_of("2024-01-01")).first()
    assert g.half_life_short_days == 7.0  # tenure floored at 1 day
    assert g.edp_current == 1.0


def test_params_override_by_name():
    p = DecayParams().overrides(h_short_frac=0.1, as_of="2024-01-01")
    assert p.h_short_frac == 0.1 and p.as_of == dt.date(2024, 1, 1)


def test_default_as_of_is_today(spark):
    today = dt.date.today()
    t = dt.datetime(today.year, today.month, today.day)
    g = M.adaptive_metrics(_silver(spark, [("a", t, t, t, True, False)])).first()  # as_of unset: current date
    assert g.half_life_short_days == 7.0 and g.edp_current == 1.0


def test_primary_entity_check(spark):
    import pytest

    from reviewforge.operators import quality as Q
    from reviewforge.operators import semantic as SEM

    ok = spark.createDataFrame([("a", 0.5), ("b", 0.2)], "app_id string, avg_rating double")
    SEM.check_primary_entity(ok)
    with pytest.raises(Q.DataQualityError):
        SEM.check_primary_entity(ok.unionByName(ok))
