"""Claims: phrase rules, verification plans, cases, terms, calibration, seeded order."""

from __future__ import annotations

from pyspark.sql import functions as F

from glyphloom.operators import claims as c


def test_phrase_rules(spark):
    df = spark.createDataFrame([("acute accent", "grave mark", "overall_form", "two curved arms"), ("arrow left", "left arrow", "distinctive_feature", "black circle 2"), ("symbol", "x", "mood", "two curved arms")], "name string, phrase string, slot string, text string")
    rows = df.select(c.contradicts(F.col("name"), F.col("phrase")).alias("x"), c.useful_phrase(F.col("slot"), F.col("text")).alias("u"), c.normalised_phrase(F.col("name")).alias("n"), c.normalised_phrase(F.col("phrase")).alias("p")).collect()
    assert [r["x"] for r in rows] == [True, False, False]
    assert [r["u"] for r in rows] == [True, False, False]
    assert [r["n"] for r in rows] == ["acute accent", "arrow left", None] and rows[2]["p"] is None


CLAIMS = [
    (1, "e", "p", "proposed", 0.9, "enrich", None, None), (2, "e", "p", "verified", 0.5, "enrich", "v1", None), (3, "e", "q", "proposed", 0.4, "blind_ground", None, 1),
    (4, "e", "r", "contested", 0.4, "enrich", None, None), (5, "f", "s", "verified", 0.9, "enrich", "v1", None), (6, "g", "t", "rejected", 0.9, "enrich", None, None),
]


def test_verification_plan(spark):
    df = spark.createDataFrame([(i, e, p, p, s, x, st, v, n) for i, e, p, s, x, st, v, n in CLAIMS], "claim_id int, entity_id string, phrase string, normalized_phrase string, status string, confidence double, source_stage string, verifier_version string, vendor_support int")
    plan = c.verification_plan(df, ["v1"], 2)
    assert {r["claim_id"]: r["action"] for r in plan.collect()} == {1: "reject", 2: "retain", 4: "verify", 5: "retain", 6: "none"}
    assert {r["entity_id"]: r["outcome"] for r in c.verification_outcome(plan).collect()} == {"e": "ready", "f": "passed", "g": "failed"}
    context = {r["entity_id"]: r for r in c.rewrite_context(df).collect()}
    assert (context["e"]["accepted"], context["e"]["repair"], context["e"]["gap"]) == (["p"], ["p", "q", "r"], 2)
    queries = spark.createDataFrame([([2],), ([2, 5],)], "claim_ids array<int>")
    assert [r["claim_id"] for r in c.synthesis_claims(df, queries).collect()] == [5]


def test_cases_and_recovery(spark):
    q = spark.createDataFrame([(1, "a", ["b"], []), (2, "z", [], [])], "query_id int, entity_id string, must_beat array<string>, must_not array<string>")
    near = spark.createDataFrame([("a", "c", 1), ("a", "d", 2), ("a", "b", 3)], "id string, other string, rank int")
    look = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "1"), ("d", "4"), ("z", "9")], "id string, visual_key string")
    got = c.adjudication_cases(q, near, look).orderBy("query_id", "place").collect()
    assert [(r["query_id"], r["candidate"]) for r in got] == [(1, "a"), (1, "b"), (1, "d")]
    assert [r["query_id"] for r in c.skipped_adjudications(q.withColumn("status", F.lit("pending"))).where("status = 'skipped'").collect()] == [2]
    v = spark.createDataFrame([("a", "a"), ("a", "a"), ("b", "b"), ("b", None)], "entity_id string, picked_entity_id string")
    assert {r["entity_id"]: r["passed"] for r in c.recovery(v).collect()} == {"a": True, "b": False}


def test_calibration_counts(spark):
    expected = spark.createDataFrame([("x", "1", True), ("x", "2", False), ("y", "1", True)], "case_id string, path string, good boolean")
    given = spark.createDataFrame([("x", "1", False), ("x", "2", True)], "case_id string, path string, accepted boolean")
    row = c.calibration(expected, given).first()
    assert (row["false_rejects"], row["false_accepts"], row["complete"], row["false_accept_rate"]) == (1, 1, False, 1.0)


def test_seeded_order_and_signals(spark):
    values = list("abcdefgh")
    assert c.shuffled(values, "s") == c.shuffled(values, "s") != values and sorted(c.shuffled(values, "t")) == values
    df = spark.createDataFrame([([("r", 1), ("r", 2), ("s", 3), ("r", 4)],)], "s array<struct<rule:string,start:int>>")
    got = df.select(c.packed_signals(F.col("s"), 3).alias("p")).first()["p"]
    assert [(x["rule"], x["start"]) for x in got] == [("r", 1), ("s", 3), ("r", 2)]


def test_samples_stay(spark):
    e = spark.createDataFrame([(f"e{k}", "xy"[k % 2]) for k in range(20)], "entity_id string, stratum string")
    first = c.frozen_holdout(e, None, "stratum", 6, "seed")
    assert sorted(r["stratum"] for r in first.collect()) == ["x"] * 3 + ["y"] * 3
    again = c.frozen_holdout(e.where("entity_id > 'e5'"), first, "stratum", 6, "seed")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    assert c.sampled_families(e, "stratum", "entity_id", "s", 2).count() == 4


def test_generation_groups(spark):
    rows = [("→", "RIGHTWARDS ARROW", "arrows", False), ("•", "BULLET", "general-punctuation", False), ("!", "EXCLAMATION MARK", "basic-latin", False), ("x", "x", "emoji", False), ("∑", "N-ARY SUMMATION", "mathematical-operators", False), ("a", "LATIN SMALL LETTER A", "basic-latin", False)]
    df = spark.createDataFrame(rows, "g string, n string, b string, s boolean")
    got = [r[0] for r in df.select(c.generation_group(F.col("g"), F.col("n"), F.col("b"), F.col("s"))).collect()]
    assert got == ["arrows", "formatting", "punctuation", "emoji", "special-symbols", "everything-else"]
