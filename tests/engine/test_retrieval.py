"""Stems and the retrieval harness."""

from __future__ import annotations

from glyphloom.functions.stemming import stem
from glyphloom.operators import retrieval

STEMS = {
    "caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "sized": "size", "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "rational": "ration", "digitizer": "digit",
    "triplicate": "triplic", "hopeful": "hope", "goodness": "good", "revival": "reviv", "adoption": "adopt", "probate": "probat", "rate": "rate", "controll": "control", "roll": "roll",
}


def test_published_examples():
    assert {w: stem(w) for w in STEMS} == STEMS


def test_aliases_raise_a_target(spark):
    plain = spark.createDataFrame([("a", "rightwards arrow"), ("b", "black star"), ("c", "white star")], "entity_id string, text string")
    more = spark.createDataFrame([("a", "rightwards arrow pointing right"), ("b", "black star"), ("c", "white star")], "entity_id string, text string")
    asked = spark.createDataFrame([(1, "pointed rights", "a"), (2, "stars", "c")], "query_id int, query string, target string")
    got = {r["query_id"]: (r["baseline_rank"], r["augmented_rank"]) for r in retrieval.compared(plain, more, asked).collect()}
    assert got == {1: (None, 1), 2: (2, 2)}
