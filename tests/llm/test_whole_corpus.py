"""Stages of the pipeline decide by row and by absolute evidence."""

from __future__ import annotations

import random

from glyphloom.llm import language_id, near_dedup, quality
from tests.llm import brute


def _words(seed: int, n: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_one_of_each_decides_by_row(spark):
    near = _words(1) + " tail"
    rows = [(None, _words(2)), (None, _words(3)), (None, _words(4)), (None, _words(4)), (7, _words(5)), (7, _words(6)), (1, _words(1)), (2, _words(7)), (2, near), (3, ""), (3, ""), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in near_dedup.one_of_each(docs).collect()), key=str)
    want = [(None, _words(2)), (None, _words(3)), (None, _words(4)), (7, _words(5)), (7, _words(6)), (1, _words(1)), (2, _words(7)), (3, ""), (None, None), (None, None)]
    assert got == sorted(want, key=str)


def test_language_stage_rejects_text_without_evidence(spark):
    import corpus_pipeline

    rng = random.Random(1)
    german, english = "der Hund und die Katze gehen in den Garten ", "the dog and the cat are walking through the green garden "
    junk = " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(6)) for _ in range(80))
    rows = [(k, german * 9, "de") for k in range(10)] + [(k, english * 40, "en") for k in range(10, 20)]
    rows += [(20, junk, None), (21, "Это предложение на другом языке", None), (22, german * 9 + english * 7, None), (23, german * 2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, "").collect()}
    assert got == {*range(20), 23}


def test_run_on_awkward_rows(spark, tmp_path):
    """Nulls everywhere, repeated rows, ids on several texts, columns with clashing names: the whole pipeline, and on no rows at all."""
    import corpus_pipeline

    rows = brute.documents() + [(None, _words(9), None, None, None, "x", 2, "t"), (0, _words(10), "en", "a", 5, None, None, None), (None, None, None, None, None, None, None, None)]
    labels = [(0, 1, 0), (5, 0, 0), (None, 1, 0), (3, None, None), (77, 1, 0)]
    for name, own, marks in (("some", rows, labels), ("none", [], [])):
        folder = str(tmp_path / name)
        docs = brute.frame(spark, own).withColumnsRenamed({"size": "keep", "target": "score"})
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        packed = corpus_pipeline.run(spark, folder).collect()
        if not own:
            assert packed == []
            continue
        now = docs
        for stage_name, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, now, folder)
            assert out.columns == now.columns, stage_name
            now = spark.createDataFrame(out.collect(), out.schema)
        # the run packs every document that the four stages keep, and no other
        assert sum(r["start"] == 0 for r in packed) == now.count() > 0


def test_quality_and_language_stages_keep_what_their_operators_keep(spark, sf_dir):
    import corpus_pipeline

    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r["doc_id"] for r in corpus_pipeline.quality_stage(spark, docs, sf_dir).collect()}
    assert kept == {r["doc_id"] for r in quality.classify(docs, labels).where("keep").collect()}
    # most labelled documents fall on the side of their label
    told = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert sum((d in kept) == bool(q) for d, q in told.items()) > 0.95 * len(told)
    sure = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, sf_dir).collect()}
    assert sure == {r["doc_id"] for r in language_id.identify(docs).collect() if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.MIN_LANGUAGE_SCORE}
