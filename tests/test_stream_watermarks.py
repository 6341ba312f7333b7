"""Watermarks of a micro-batch follow the rule of a run's watermarks."""

import datetime as dt
import json

from reviewforge.sources import ledger as ST
from reviewforge.streaming.tail import _batch_watermarks


def test_empty_cursors_are_skipped_and_pages_decide(spark):
    at = dt.datetime(2024, 1, 1)

    def row(app, rid, page, cursor):
        return (app, rid, at, at, "s", "h", cursor, json.dumps({"recommendationid": rid, "page": page, "cursor": cursor}))

    rows = [row("a", "9", 1, "*"), row("a", "1", 2, "c1"), row("a", "5", 3, ""), row("a", "6", 4, None), row("b", "2", 1, ""), row("c", "30", 10, "c9"), row("c", "4", 9, "c8")]
    got = {r.appid: r.cursor for r in _batch_watermarks(spark.createDataFrame(rows, ST.LEDGER_SCHEMA), "s", at).collect()}
    assert got == {"a": "c1", "b": None, "c": "c9"}
