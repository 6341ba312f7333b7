"""Paged reads that follow cursors instead of page numbers.

The API hands out pages as a chain: each page names the cursor of the next. A
sequential reader starts at ``*`` and asks for one cursor after the other. Over
landed pages this is list ranking: every page is a node, keyed by its request
cursor, with a pointer to the page whose request cursor it names. Pointer
doubling ranks all chains at once: after k rounds the first 2^k pages of every
chain are known, and each pointer spans 2^k pages. So a chain of n pages takes
log2(n) rounds of two equi-joins on (app, cursor), keys that are unique per
page; no app is sent to a task, however long its chain.

Landed page numbers are not used: a page's number is its place in the chain. A
page that was landed several times counts once, with its last landing. A page
that was not landed ends the read before it, and a loop, over one cursor or
several, ends it where it would begin again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .pages import parse_envelopes

FIRST_CURSOR = "*"


def _landings(pages: DataFrame, groups: list[str]) -> DataFrame:
    """The last landing of each page, parsed: where the read goes on (NULL: nowhere) and whether the page ends it unread."""
    latest = Window.partitionBy(*groups, "cursor").orderBy(F.col("fetched_at").desc_nulls_last(), F.xxhash64("body").desc())
    # Parsed after the choice: one body per page.
    last = pages.withColumn("_nth", F.row_number().over(latest)).filter("_nth = 1").drop("_nth")
    return parse_envelopes(last).withColumn("bad", ~F.col("success_ok") | F.coalesce(F.size("reviews") <= 0, F.lit(True)))


def rank_chains(links: DataFrame, starts: DataFrame, groups: list[str], limit: int | None = None, max_rounds: int = 64) -> DataFrame:
    """(groups, cursor, step): every node on the chain of its group, from 0 on.

    ``links``: (groups, cursor, next), a row per node, ``next`` NULL at an end;
    ``starts``: (groups, cursor), a node per group at most. ``limit`` bounds the
    steps. Nodes that no chain reaches have no row.
    """
    nodes = links.select(*groups, "cursor")
    step0 = starts.join(nodes, [*groups, "cursor"]).withColumn("step", F.lit(0).cast("long"))
    # Pointers to pages that were not landed lead nowhere.
    jumps = links.filter("next is not null").join(nodes.withColumnRenamed("cursor", "next"), [*groups, "next"], "left_semi")
    reached, jumps = written(step0, "chain"), written(jumps.select(*groups, "cursor", "next"), "jumps")
    known = reached.count()
    for k in range(max_rounds):
        span = 1 << k
        if limit is not None and span >= limit:
            break
        ahead = reached.join(jumps, [*groups, "cursor"]).select(*groups, F.col("next").alias("cursor"), (F.col("step") + span).alias("step"))
        # A loop comes back to known pages; their first visit counts.
        more = written(reached.unionByName(ahead).groupBy(*groups, "cursor").agg(F.min("step").alias("step")), "chain")
        found = more.count()
        reached = more
        if found == known:
            break
        known = found
        onward = jumps.select(*groups, F.col("cursor").alias("next"), F.col("next").alias("after"))
        jumps = written(jumps.join(onward, [*groups, "next"]).select(*groups, "cursor", F.col("after").alias("next")), "jumps")
    else:
        raise RuntimeError("the chains did not settle")
    return reached if limit is None else reached.filter(F.col("step") < limit)


def admit_linked(
    pages: DataFrame,
    max_pages: int | None = None,
    resume: DataFrame | None = None,
    groups: tuple[str, ...] = ("app_id",),
) -> DataFrame:
    """The pages that a sequential read consumes, by their cursors; ``page`` is the place in the chain.

    Same columns as ``admit_pages``. ``groups`` tells apart reads that must not
    be linked, e.g. ``("run_id", "app_id")``. ``resume``: optional (groups,
    cursor, resume_page), where each read starts and with which number; a
    resumed read gets at least one page, and the cap counts from page 1.
    """
    keys = list(groups)
    landed = written(_landings(pages, keys), "landings")
    ends = F.col("bad") | F.col("next_cursor").isNull() | (F.col("next_cursor") == "") | (F.col("next_cursor") == F.col("cursor"))
    links = landed.select(*keys, "cursor", F.when(~ends, F.col("next_cursor")).alias("next"))
    if resume is None:
        starts = landed.filter(F.col("cursor") == FIRST_CURSOR).select(*keys, "cursor")
        first = F.lit(1)
    else:
        starts = resume.select(*keys, "cursor")
        first = F.coalesce(F.col("resume_page"), F.lit(1))
    # Without a resume no read goes past the cap; with one, the pages before its start count, too.
    order = rank_chains(links, starts, keys, max(1, int(max_pages)) if max_pages is not None else None)
    whole = landed.filter("not bad").join(order, [*keys, "cursor"])
    if resume is not None:
        whole = whole.join(resume.select(*keys, "resume_page"), keys)
    whole = whole.withColumn("page", (first + F.col("step")).cast("int")).withColumn("start_page", first.cast("int"))
    if max_pages is not None:
        whole = whole.filter(F.col("page") <= F.greatest(F.lit(int(max_pages)), F.col("start_page")))
    return whole.drop("bad", "step", *(["resume_page"] if resume is not None else []))
