"""End to end: an ingest run, then the model build gated by the quality checks.

``run_ingest`` plans a run over all requested apps and performs three bulk
writes (landing files, ledger append, watermark append) plus the quarantine.
``build_models`` rebuilds silver and gold from the ledger: each layer is
written into a new version folder, checked, and only then published, so a
failing check leaves the previous version in place and stops the build
before the next layer.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import compaction, enrich, ingest, metrics, quality
from ..params import DecayParams
from ..sources import ledger as store


@dataclass(frozen=True)
class Paths:
    root: str

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def landing(self) -> str:
        return self._p("landing")

    @property
    def ledger(self) -> str:
        return self._p("bronze/steam_reviews_raw")

    @property
    def watermarks(self) -> str:
        return self._p("bronze/load_watermarks")

    @property
    def quarantine(self) -> str:
        return self._p("bronze/quarantine")

    @property
    def silver(self) -> str:
        return self._p("silver/steam_reviews_enriched")

    @property
    def gold(self) -> str:
        return self._p("gold/fct_steam_review_metrics_adaptive")


def run_ingest(
    spark: SparkSession,
    pages: DataFrame,
    requested: DataFrame,
    paths: Paths,
    run_ts: _dt.datetime | None = None,
    options: ingest.RunOptions = ingest.RunOptions(),
    resume: bool = False,
) -> ingest.IngestResult:
    """One ingest run; with ``resume`` each app restarts at its last watermark."""
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    store.prepare_storage(spark, paths.ledger, paths.watermarks)
    load_id = ingest.load_id_for(run_ts)
    resume_df = None
    if resume:
        # earlier runs only: a re-executed run resumes where it first started
        earlier = store.read_watermarks(spark, paths.watermarks).filter(F.col("load_id") != F.lit(load_id))
        resume_df = ingest.resume_points(earlier, pages)
    result = ingest.ingest(pages, requested, run_ts, options, resume_df)
    store.write_landing(result.reviews, paths.landing, load_id)
    store.append_ledger(result.ledger, paths.ledger)
    store.append_watermarks(result.watermarks, paths.watermarks)
    if options.validate:
        result.quarantine.select("app_id", "page", "pos", "cursor", "fetched_at", "review", "violations").write.mode(
            "overwrite"
        ).parquet(f"{paths.quarantine}/load_id={load_id}")
    result.release()  # outputs written: drop the batch kept for them
    return result


def _publish_checked(spark: SparkSession, df: DataFrame, base: str, version: str, model: str) -> DataFrame:
    """Write ``df`` as a version and publish it if its checks pass.

    Null and range checks are counted by the write itself; only the uniqueness
    checks read the staged files, the key column alone. A failure leaves a
    folder that no pointer names.
    """
    observed = quality.Observed(model, df)
    staged = store.stage_version(observed.rows, base, version)
    quality.raise_failed(observed.failures())
    unique = [c for c in quality.CHECKS if c.model == model and c.test == "unique"]
    if unique:
        quality.gate(quality.run_checks({model: staged}, unique))
    store.publish_version(spark, base, version)
    return staged


def build_models(
    spark: SparkSession,
    paths: Paths,
    params: DecayParams = DecayParams(),
    version: str | None = None,
) -> dict[str, DataFrame]:
    """Ledger -> compacted view -> silver table -> gold table, each checked."""
    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    raw = store.read_ledger(spark, paths.ledger)
    compacted = compaction.compact_stored(store.ledger_files(spark, paths.ledger))
    quality.gate(quality.run_checks({"steam_reviews_raw": raw, "steam_reviews_raw_compacted": compacted}))
    silver = _publish_checked(spark, enrich.enrich(compacted), paths.silver, version, "steam_reviews_enriched")
    gold = _publish_checked(
        spark, metrics.adaptive_metrics(silver, params), paths.gold, version, "fct_steam_review_metrics_adaptive"
    )
    return {"compacted": compacted, "silver": silver, "gold": gold}


# The layer names users query.
VIEW_NAMES = {
    "raw": "steam_reviews_raw",
    "compacted": "steam_reviews_raw_compacted",
    "silver": "steam_reviews_enriched",
    "gold": "fct_steam_review_metrics_adaptive",
    "watermarks": "load_watermarks",
}


def register_views(spark: SparkSession, paths: Paths) -> dict[str, str]:
    """Expose the layers to ``spark.sql`` under their model names.

    The ledger and its compaction are views (evaluated per query, like the
    reference's view models); silver and gold point at the published version.
    """
    raw = store.read_ledger(spark, paths.ledger)
    raw.createOrReplaceTempView(VIEW_NAMES["raw"])
    compaction.compact_latest(raw).createOrReplaceTempView(VIEW_NAMES["compacted"])
    store.read_watermarks(spark, paths.watermarks).createOrReplaceTempView(VIEW_NAMES["watermarks"])
    for layer, base in (("silver", paths.silver), ("gold", paths.gold)):
        if store.current_version(spark, base) is not None:
            store.read_current(spark, base).createOrReplaceTempView(VIEW_NAMES[layer])
    return dict(VIEW_NAMES)
