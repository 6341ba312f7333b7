"""Contract rules and the canonical payload hash."""

import json

from pyspark.sql import functions as F

from reviewforge.functions.contract import add_violations
from reviewforge.functions.payload import canonical_hash

VALID = {
    "recommendationid": "1", "language": "english", "review": "ok", "timestamp_created": 10,
    "timestamp_updated": 11, "voted_up": True, "votes_up": 0, "votes_funny": 0,
    "weighted_vote_score": "0.5", "steam_purchase": False, "received_for_free": False,
    "written_during_early_access": False,
    "author": {"steamid": "9", "num_games_owned": 1, "num_reviews": 1, "playtime_forever": 3},
}


def _check(spark, docs):
    df = spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "review string")
    return [r.violations for r in add_violations(df).collect()]


def test_rules(spark):
    def mod(**kw):
        d = json.loads(json.dumps(VALID))
        for k, v in kw.items():
            if v is KeyError:
                d.pop(k)
            else:
                d[k] = v
        return d

    docs = [
        VALID,
        mod(voted_up=KeyError),
        mod(votes_up=-1),
        mod(steam_purchase="yes"),
        mod(review=42),
        mod(language=None),
        mod(author=5),
        mod(votes_up=1.0, weighted_vote_score=0.7, extra_key=[1]),
        mod(votes_up=1.5),
        mod(author={"steamid": 1, "num_games_owned": 1, "num_reviews": 1}),
        "[1, 2]",
        "not json",
    ]
    assert _check(spark, docs) == [
        "",
        "required:voted_up",
        "minimum:votes_up",
        "type:steam_purchase",
        "type:review",
        "type:language",
        "type:author",
        "",
        "type:votes_up",
        "required:author.playtime_forever,type:author.steamid",
        "type:$",
        "type:$",
    ]


def test_canonical_hash_ignores_key_order_and_spacing(spark):
    a = '{"b": 1, "a": {"y": [1, 2], "x": "s"}}'
    b = '{"a":{"x":"s","y":[1,2]},"b":1}'
    c = '{"a":{"x":"s","y":[1,2]},"b":2}'
    df = spark.createDataFrame([(a,), (b,), (c,)], "p string")
    h = [r[0] for r in df.select(canonical_hash(F.col("p"))).collect()]
    assert h[0] == h[1] != h[2] and len(h[0]) == 64
