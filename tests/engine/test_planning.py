"""Planning a corpus, cohorts, failure edges, and the report on a run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from glyphloom.operators import planning, reports

CHARACTERS = "code_point int, hex string, name string, category_key string, character string, popularity int, synonyms string"
ROWS = [
    (0x2192, "2192", "RIGHTWARDS ARROW", "arrows", "→", 10, ""), (0x2603, "2603", "SNOWMAN", "miscellaneous-symbols", "☃", 0, "snow"), (0x41, "0041", "LATIN CAPITAL LETTER A", "basic-latin", "A", 3, None),
    (0x42, "0042", "LATIN CAPITAL LETTER B", "basic-latin", "B", 0, "bee"), (0x4E00, "4E00", "CJK UNIFIED IDEOGRAPH-4E00", "cjk-unified-ideographs", "一", 0, None), (0x4E01, "4E01", "CJK UNIFIED IDEOGRAPH-4E01", "cjk-unified-ideographs", "丁", 0, None),
    (0xE000, "E000", "PRIVATE USE", "private-use-area", "", 5, None), (0xE001, "E001", "PRIVATE USE", "private-use-area", "", 5, None), (0x2014, "2014", "EM DASH", "general-punctuation", "—", 0, "dash"),
]
SEQUENCES = [("2603-fe0f", "snowman", "☃️", "emoji", 7, ""), ("1f1e9-1f1ea", "flag: Germany", "🇩🇪", "emoji", 9, "flag")]


def entities(spark):
    characters = spark.createDataFrame(ROWS, CHARACTERS)
    sequences = spark.createDataFrame(SEQUENCES, "sequence_key string, name string, emoji string, category_key string, popularity int, synonyms string")
    return planning.characters_to_plan(characters).unionByName(planning.sequences_to_plan(sequences, characters))


def test_planned_corpus(spark):
    failures = spark.createDataFrame([("character:66", 2, 4), ("57345", 1, 1)], "key string, count int, severity int")
    seeds = spark.createDataFrame([("character:19969",)], "key string")
    scored = planning.with_scores(planning.with_failures(entities(spark), failures), seeds)
    got = {r["key"]: r for r in planning.planned(scored, 7, share=0.5).collect()}
    # folded: the snowman with a selector; out: the private-use character that nothing asks for
    assert "emoji_sequence:2603-fe0f" not in got and "character:57344" not in got
    assert [got[f"character:{c}"]["group"] for c in (0x2192, 0x2603, 0x2014, 0x42)] == ["arrows", "special-symbols", "punctuation", "everything-else"]
    assert got["emoji_sequence:1f1e9-1f1ea"]["group"] == "emoji"
    # four priority entities, three more: two by score and one by categories in turn
    assert sorted(r["selection_rank"] for r in got.values()) == list(range(1, 8))
    assert got["character:66"]["selection_score"] == 2000 + 1_000_000 + 2 * 20_000 + 4 * 5_000 + 3_000 and got["character:66"]["selection_tier"] == 0
    assert got["character:8212"]["selection_tier"] == 2 and got["character:8212"]["selection_reasons"][0] == "generation-group:punctuation"
    explored = [k for k, r in got.items() if "category-exploration" in r["selection_reasons"]]
    assert len(explored) == 1 and {"character:66", "character:57345"} <= set(got)
    # priority groups are never cut
    assert planning.planned(scored, 1).count() == 4


def test_cohorts_and_seeds(spark):
    chars = spark.createDataFrame([(1, "arrow"), (2, "arrow"), (3, "math")], "code_point int, family string")
    assert planning.cohort(chars, family="arrow").count() == 2 and planning.cohort(chars, code_points=[3]).count() == 1
    for wrong in ({"family": "arrow", "code_points": [1]}, {}, {"code_points": [1, 9]}, {"family": "emoji"}):
        with pytest.raises(ValueError):
            planning.cohort(chars, **wrong)
    seeds = spark.createDataFrame([("2192", "ARROW"), ("1f1e9-1f1ea", "GERMANY")], "hex string, fallback_name string")
    reference = spark.createDataFrame([("8594", "RIGHTWARDS ARROW", "→")], "target_key string, name string, character string")
    got = {r["target_key"]: (r["kind"], r["name"], r["character"]) for r in planning.seed_targets(seeds, reference).collect()}
    assert got == {"8594": ("character", "RIGHTWARDS ARROW", "→"), "1f1e9-1f1ea": ("emoji_sequence", "GERMANY", "")}
    pairs = spark.createDataFrame([("to the right", "2192", "1f1e9-1f1ea"), ("lost", "2192", "2603")], "query string, victim string, thief string")
    selected = spark.createDataFrame([("character:8594",), ("emoji_sequence:1f1e9-1f1ea",)], "key string")
    assert [tuple(r) for r in planning.failure_edges(pairs, selected).collect()] == [("character:8594", "emoji_sequence:1f1e9-1f1ea", "failure-query:to the right", 1.0)]
    terms = spark.createDataFrame([("k", "Right arrow", "right arrow", 2), ("k", "right  arrow", "right arrow", 1), ("k", "next", "next", 3), ("k", "!", "", 4)], "target_key string, term string, normalized string, ordinal int")
    assert planning.synonym_backfill(terms).first()["synonyms"] == "right  arrow; next"


def test_inspection_report(spark):
    documents = [
        ("s", "post", 1, 1, 1, 1, 11, 1, 1), ("s", "post", 11, 1, 11, 2, None, None, 2), ("s", "comment", 101, 1, 11, None, None, None, None), ("s", "comment", 102, 1, 11, None, None, None, None),
        ("s", "comment", 103, 1, 1, None, None, None, None), ("s", "post", 2, 2, 2, 1, 99, 3, None),
    ]
    docs = spark.createDataFrame(documents, "site string, kind string, id int, qid int, post_id int, type int, accepted int, answers int, comments int")
    candidates = spark.createDataFrame([("s", 1), ("s", 2), ("s", 7)], "site string, qid int")
    hits = spark.createDataFrame([("s", "comment", 101, 11), ("s", "post", 2, 2), ("s", "comment", 5, 500)], "site string, kind string, id int, post_id int")
    routing = spark.createDataFrame([("s", 1, 1), ("s", 11, 1), ("s", 2, 2)], "site string, id int, qid int")
    sites = spark.createDataFrame([("s", True)], "site string, complete boolean")
    got = reports.inspection_report(docs, candidates, hits, routing, sites).first().asDict()
    assert got == {
        "status": "complete_with_warnings", "candidates": 3, "documents": 6, "discovery_hits": 3, "comment_only_threads": 1, "missing_questions": 1, "orphan_discovery_hits": 1,
        "missing_accepted_answers": 1, "comment_count_mismatches": 0, "answer_count_mismatches": 1,
    }
    assert reports.inspection_report(docs, candidates, hits, routing, sites.withColumn("complete", F.lit(False))).first()["status"] == "incomplete"
