"""Queries and operators do the whole job: no prefixes, no windows that ties can outgrow, no ranges cut off."""

from __future__ import annotations

import random

from glyphloom.operators import graph
from glyphloom.plans.registry import queries


def test_normalised_terms_reads_whole_texts(spark, tmp_path):
    text = "Ä " + "wort " * 100 + "Ende Ω"
    spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["term"], r["record_text"]) for r in queries()["normalised_terms"](spark, str(tmp_path)).collect()}
    assert got == {1: ("a " + "wort " * 100 + "ende", "ä " + "wort " * 100 + "ende ω"), 2: (None, None)}


def test_nearest_in_block_with_ties_of_any_size(spark):
    rng = random.Random(2)
    rows = [(k, "x", 5.0) for k in range(40)] + [(k, "x", float(rng.randrange(4))) for k in range(40, 70)] + [(k, "y", float(rng.randrange(3))) for k in range(70, 90)]
    rng.shuffle(rows)
    found = graph.nearest_in_block(spark.createDataFrame(rows, "k int, b string, p double"), ["b"], "k", "p", 3).collect()
    got = {(r["id"], r["rank"]): (r["other"], r["distance"]) for r in found}
    want = {}
    for k, b, p in rows:
        near = sorted((abs(q - p), o) for o, c, q in rows if c == b and o != k)[:3]
        want |= {(k, n + 1): (o, d) for n, (d, o) in enumerate(near)}
    assert got == want and len(found) == len(want)


def test_taxonomy_knows_characters_beyond_the_basic_plane(spark, tmp_path):
    spark.createDataFrame([(1, "a 😀 𝐀 𠀀")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {chr(r["cp"]) for r in queries()["taxonomy_families"](spark, str(tmp_path)).collect()}
    assert got == set("a 😀𝐀𠀀")
    names = queries()["taxonomy_name_tokens"](spark, str(tmp_path)).where("size = 1 AND token IN ('LATIN', 'EMOJI', 'GRINNING')").collect()
    assert {r["token"] for r in names} >= {"LATIN", "GRINNING"}
