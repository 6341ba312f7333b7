"""Landing files: a folder per run whatever the number of apps, exact replay, and the older folders per app."""

import os

import pytest

from reviewforge.sources import ledger as ST
from reviewforge.streaming.watermarks import latest_watermarks, stream_watermarks

RUN = "20240101T000000"


def _files(root):
    return [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.startswith("part-")]


def test_files_grow_with_tasks_not_apps(spark, scratch):
    path = os.path.join(scratch, "landing")
    reviews = spark.range(0, 400, 1, 3).selectExpr("cast(id as string) app_id", "concat('{\"page\": ', id, '}') payload")
    ST.write_landing(reviews, path, RUN)
    assert len(_files(path)) <= 3
    got = {tuple(r) for r in ST.read_landing(spark, path).collect()}
    assert got == {(f'{{"page": {i}}}', str(i), RUN) for i in range(400)}


def test_replay_is_exact(spark, scratch):
    path = os.path.join(scratch, "landing")
    rows = [
        ("007", '{"a": "x\\ny", "b": "é "}'),
        ("a/b=c%2F+ d:e", '{\n  "pretty": 1.0\n}'),
        (None, "no json"),
        ("", "{}"),
        ("9", None),
        ("9", ""),
    ]
    ST.write_landing(spark.createDataFrame(rows, "app_id string, payload string"), path, "r 1+%41:x")
    got = sorted(map(repr, map(tuple, ST.read_landing(spark, path).collect())))
    assert got == sorted(repr((payload, app, "r 1+%41:x")) for app, payload in rows)


def test_a_rerun_replaces_its_run_whole(spark, scratch):
    path = os.path.join(scratch, "landing")
    for run, apps in ((RUN, "ab"), ("other", "a"), (RUN, "b")):
        ST.write_landing(spark.createDataFrame([(a, "{}") for a in apps], "app_id string, payload string"), path, run)
    assert {(r.app_id, r.load_id) for r in ST.read_landing(spark, path).collect()} == {("b", RUN), ("a", "other")}


@pytest.mark.parametrize("stream", [False, True])
def test_folders_per_app_are_read_beside_runs(spark, scratch, stream):
    path, marks, state = (os.path.join(scratch, x) for x in ("landing", "marks", "state"))
    old = [("007", '{"page": 1, "cursor": "old"}'), ("x:y +%", '{"page": 1, "cursor": "odd"}'), (None, '{"page": 1}')]
    table = spark.createDataFrame(old, "app_id string, value string").selectExpr("*", f"'{RUN}' load_id")
    table.write.partitionBy("app_id", "load_id").text(path)
    ST.write_landing(spark.createDataFrame([("007", '{"page": 1, "cursor": "new"}')], "app_id string, payload string"), path, "20240102T000000")
    if stream:
        assert stream_watermarks(spark, path, marks, state).awaitTermination(180)
        got = {r.appid: r.cursor for r in latest_watermarks(ST.read_watermarks(spark, marks)).collect()}
        assert got == {"007": "new", "x:y +%": "odd"}
    else:
        got = {(r.app_id, r.payload, r.load_id) for r in ST.read_landing(spark, path).collect()}
        assert got == {(a, p, RUN) for a, p in old} | {("007", '{"page": 1, "cursor": "new"}', "20240102T000000")}
