"""One ingest run as a lazy plan: pages -> reviews -> ledger rows + watermarks.

The reference reads each app in a loop, writing one line and one row per
review; here a run over all requested apps is one DataFrame plan with two
bulk writes (landing files and ledger) and one per-app aggregate
(watermarks). Nothing is pulled to the driver.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.contract import add_violations
from ..functions.payload import canonical_hash
from . import pages as P


class ContractViolation(ValueError):
    """Raised in strict mode when a landed review breaks the contract."""


def load_id_for(run_ts: _dt.datetime) -> str:
    """Run identifier: UTC start time to the second, ``yyyymmddThhmmss``."""
    return run_ts.strftime("%Y%m%dT%H%M%S")


@dataclass(frozen=True)
class RunOptions:
    language: str = "all"
    review_type: str = "all"
    purchase_type: str = "all"
    max_pages: int | None = None
    validate: bool = True
    strict: bool = False


@dataclass
class IngestResult:
    reviews: DataFrame  # every yielded review (app_id, page, pos, cursor, fetched_at, review, payload, ...)
    quarantine: DataFrame  # reviews breaking the contract, with ``violations``
    ledger: DataFrame  # the 8 ledger columns
    watermarks: DataFrame  # one row per requested app
    kept: DataFrame | None = None  # the persisted checked batch, if any

    def release(self) -> None:
        """Unpersist the checked batch once the run's outputs are written."""
        if self.kept is not None:
            self.kept.unpersist()


def with_violations(reviews: DataFrame) -> DataFrame:
    return add_violations(reviews, "review", "violations")


def ledger_rows(reviews: DataFrame, load_id: str, ingested_at: _dt.datetime) -> DataFrame:
    """Ledger projection; reviews without app id or review id are skipped."""
    r = P.review_fields(reviews).filter(F.col("app_id").isNotNull() & F.col("recommendationid").isNotNull())
    return r.select(
        F.col("app_id").cast("string").alias("appid"),
        F.col("recommendationid"),
        F.col("updated_at"),
        F.lit(ingested_at.replace(tzinfo=None)).cast("timestamp_ntz").alias("ingested_at"),
        F.lit(load_id).alias("load_id"),
        canonical_hash(F.col("payload")).alias("hash_payload"),
        F.col("cursor").cast("string").alias("cursor"),
        F.col("payload"),
    )


def load_watermarks(
    reviews: DataFrame,
    requested: DataFrame,
    load_id: str,
    recorded_at: _dt.datetime,
) -> DataFrame:
    """Per requested app: last non-empty cursor in arrival order, latest
    update time and review count; apps without reviews get NULLs and 0."""
    r = P.review_fields(reviews)
    nonempty = F.col("cursor").isNotNull() & (F.col("cursor") != F.lit(""))
    per_app = r.groupBy("app_id").agg(
        F.max(F.when(nonempty, F.struct("page", "pos", "cursor")))["cursor"].alias("cursor"),
        F.max("updated_at").alias("max_updated_at"),
        F.count(F.lit(1)).alias("review_count"),
    )
    out = requested.select("app_id").join(per_app, "app_id", "left")
    return out.select(
        F.col("app_id").alias("appid"),
        F.lit(load_id).alias("load_id"),
        F.col("cursor"),
        F.col("max_updated_at"),
        F.lit(recorded_at.replace(tzinfo=None)).cast("timestamp_ntz").alias("recorded_at"),
        F.coalesce(F.col("review_count"), F.lit(0)).cast("long").alias("review_count"),
    )


def resume_points(watermarks: DataFrame, pages: DataFrame) -> DataFrame:
    """Where a later run restarts each app: the page whose request cursor is
    the latest watermark's cursor (that page is read again)."""
    latest = watermarks.filter(F.col("cursor").isNotNull()).groupBy("appid").agg(
        F.max_by("cursor", F.struct("recorded_at", "load_id")).alias("cursor")
    )
    hits = pages.select("app_id", "cursor", "page").join(
        latest.withColumnRenamed("appid", "app_id"), ["app_id", "cursor"]
    )
    return hits.groupBy("app_id").agg(F.min("page").alias("resume_page"))


def ingest(
    pages: DataFrame,
    requested: DataFrame,
    run_ts: _dt.datetime,
    options: RunOptions = RunOptions(),
    resume: DataFrame | None = None,
) -> IngestResult:
    """Plan one run: page gates and stops, explode, filters, contract, ledger, watermarks."""
    load_id = load_id_for(run_ts)
    admitted = P.admit_pages(pages, options.max_pages, resume)
    reviews = P.filter_reviews(
        P.explode_reviews(admitted), options.language, options.review_type, options.purchase_type
    )
    if options.validate:
        # The checked batch feeds three outputs (ledger, watermarks,
        # quarantine): keep it once instead of re-parsing each time. Lost
        # blocks are recomputed from lineage.
        checked = with_violations(reviews).persist(StorageLevel.MEMORY_AND_DISK)
        bad = checked.filter(F.col("violations") != F.lit(""))
        if options.strict:
            first = bad.select("app_id", "page", "pos", "violations").limit(1).collect()
            if first:
                raise ContractViolation(f"review breaks the contract: {first[0].asDict()}")
        reviews = checked.filter(F.col("violations") == F.lit("")).drop("violations")
        quarantine = bad
    else:
        # Without the contract an element that is no object still can't land.
        checked = None
        quarantine = with_violations(reviews.filter(~P.is_object(F.col("review"))))
        reviews = reviews.filter(P.is_object(F.col("review")))
    return IngestResult(
        reviews=reviews,
        quarantine=quarantine,
        ledger=ledger_rows(reviews, load_id, run_ts),
        watermarks=load_watermarks(reviews, requested, load_id, run_ts),
        kept=checked,
    )
