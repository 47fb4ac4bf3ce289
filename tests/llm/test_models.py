"""Chat formatting, language-model scores, quality, top-k search, fingerprints, language identification, pipeline."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glyphloom.llm import chat_format, fingerprints, language_id, lm_scoring, quality, topk_search
from glyphloom.llm.queries import queries, tokenizer_path
from tests.llm import brute
from tests.llm.test_text_operators import check_packing

TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "yo\nline ### Assistant: x"),
    (2, 0, "user", "a </turn>\nb"), (2, 1, "assistant", "\\"), (2, 2, "assistant", "\\\\ \\n \\### end\\"),
    (3, 1, None, None), (3, 1, "assistant", None), (3, None, "user", "first"), (3, 1, "assistant", ""),
    (4, 0, "odd: role\\", "text: with # and < > / \\: \n"), (4, 1, "assistant", "</turn>"), (4, 2, "assistant", "</turn>\n### user: fake </turn>\n"),
    (5, 0, "assistant", "x" * 100_000), (5, 0, "assistant", "x" * 100_000), (None, 3, "user", "no conversation"), (6, 0, "user", "<</turn>turn> ####"), (6, 1, "assistant", "日本 é <\\/turn>"),
]


def conversations(spark, rows=TURNS):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string, turns int")


def test_round_trip_of_every_conversation(spark):
    formatted = chat_format.format_conversations(conversations(spark))
    rows = {r["conv_id"]: r for r in formatted.collect()}
    digests = {r["conv_id"]: r for r in chat_format.conversation_digests(formatted).collect()}
    spans = {r["conv_id"]: r["s"] for r in formatted.select("conv_id", chat_format.loss_spans(F.col("turns")).alias("s")).collect()}
    for conv in {r[0] for r in TURNS}:
        own = sorted(((-1 << 63) if t is None else t, role or "", text or "") for c, t, role, text in TURNS if c == conv)
        assert [(t["role"], t["text"]) for t in rows[conv]["turns"]] == [x[1:] for x in own]
        assert rows[conv]["round_trip"] and digests[conv]["formatted_chars"] == len(rows[conv]["formatted"])
        assert digests[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest()
        loss = "".join(t for _, r, t in own if r == "assistant")
        assert (digests[conv]["loss_chars"], digests[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        written = [rows[conv]["formatted"][s["begin"] : s["end"]] for s in spans[conv]]
        assert written == [t["written"] for t in rows[conv]["turns"] if t["role"] == "assistant"]
    assert {rows[c]["escape_level"] for c in rows} == {0, 1, 2}
    masked = {r["conv_id"]: r for r in chat_format.masked_conversations(conversations(spark)).collect()}
    for conv, r in masked.items():
        assert [tuple(s) for s in r["loss_mask"]] == [tuple(s) for s in spans[conv]] and r["formatted"] == rows[conv]["formatted"]
    assert chat_format.format_conversations(conversations(spark).limit(0)).count() == 0


def test_lm_counts_and_scores(spark):
    rows = [r for r in brute.documents() if r[0] != 13] + [(50 + k, " ".join(f"w{(k * j) % 11}" for j in range(k)), "en", "s", 1, None, None, None) for k in range(60)]
    got = lm_scoring.score_documents(brute.frame(spark, rows).repartition(3)).collect()
    assert len(got) == len(rows)
    fold = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5
    train = [brute.words(r[1]) + ["\0end"] for r in rows if fold(r[0]) != 1]
    count = Counter(w for t in train for w in t)
    n, v = sum(count.values()), len(count)
    texts = {r[0]: brute.words(r[1]) + ["\0end"] for r in rows}
    for r in got:
        own = texts[r["doc_id"]]
        assert r["held_out"] == (fold(r["doc_id"]) == 1)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(count[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own))
        assert r["score"] < 0
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    again = {r["doc_id"]: r["score"] for r in lm_scoring.score_documents(brute.frame(spark, rows)).collect()}
    assert all(r["score"] == pytest.approx(again[r["doc_id"]]) for r in got)
    assert lm_scoring.score_documents(brute.frame(spark).limit(0)).count() == 0


@pytest.mark.parametrize("fan", [512, 3])
def test_lm_model_is_the_mixture_it_says(spark, monkeypatch, fan):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 200)
    monkeypatch.setattr(lm_scoring, "FAN", fan)
    seen = {}
    learn = lm_scoring.learn_weights
    monkeypatch.setattr(lm_scoring, "learn_weights", lambda *a: seen.setdefault("w", learn(*a)))
    rows = [(k, " ".join(f"w{(k * j) % 7}" for j in range(k % 13)), "en", "s", 1, None, None, None) for k in range(80)]
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score_documents(brute.frame(spark, rows)).collect()}
    tokens = {r[0]: ["\0begin", *brute.words(r[1]), "\0end"] for r in rows}
    train = [d for d in tokens if zlib.crc32(str(d).encode()) % 5 != 1]
    one = Counter(w for d in train for w in tokens[d][1:])
    two = Counter(p for d in train for p in zip(tokens[d], tokens[d][1:]))
    context = one + Counter({"\0begin": len(train)})
    n, v = sum(one.values()), len(one)
    for d, own in tokens.items():
        total = 0.0
        for h, w in zip(own, own[1:]):
            c = context[h]
            l2, l1, l0 = seen["w"][min(lm_scoring.BUCKETS - 1, 1 + int(math.log2(c)) if c else 0)]
            total += math.log10(l2 * two[h, w] / max(c, 1) + l1 * one[w] / n + l0 / (v + 1))
        assert got[d] == pytest.approx(total)


def test_lm_levels_hold_every_block():
    for blocks in (1, 2, 136, 512, 513, 300_000, 17_000_000):
        depth, fan = lm_scoring.levels(blocks)
        assert fan**depth >= blocks and fan <= lm_scoring.FAN and (depth == 1 or lm_scoring.FAN ** (depth - 1) < blocks)
    for most in (0, 3, 255, 256, 1 << 40):
        x = np.array([0, most, 1])
        assert lm_scoring._unpack_counts(lm_scoring._pack_counts(x), 3).tolist() == x.tolist()


def test_lm_weights_are_those_of_exact_em(spark, monkeypatch):
    """EM over every single held-out occurrence, in plain Python, gives nearly the weights of the binned histogram."""
    seen = {}
    learn = lm_scoring.learn_weights
    monkeypatch.setattr(lm_scoring, "learn_weights", lambda *a: seen.setdefault("w", learn(*a)))
    rng = np.random.default_rng(7)
    rows = [(k, " ".join(f"w{int(x)}" for x in np.minimum(rng.zipf(1.4, rng.integers(5, 80)), 300)), "en", "s", 1, None, None, None) for k in range(300)]
    lm_scoring.score_documents(brute.frame(spark, rows)).collect()
    texts = [["\0begin", *brute.words(r[1]), "\0end"] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 1]
    one = Counter(w for t in texts for w in t[1:])
    two = Counter(p for t in texts for p in zip(t, t[1:]))
    context = one + Counter({"\0begin": len(texts)})
    n, v = sum(one.values()), len(one)
    weights = {}
    held = [(context[h] - 1, two[h, w] - 1, one[w] - 1) for t in texts for h, w in zip(t, t[1:])]
    place = [1 + int(math.log2(c)) if c else 0 for c, _, _ in held]
    for b in set(place):
        weights[b] = [0.4, 0.4, 0.2]
    for _ in range(lm_scoring.EM_STEPS):
        sums = {b: [0.0, 0.5, 0.5] for b in weights}
        for b, (c, k, u) in zip(place, held):
            parts = [x * y for x, y in zip(weights[b], (k / c if c else 0.0, u / (n - 1), 1 / (v + 1)))]
            total = sum(parts)
            sums[b] = [x + y / total for x, y in zip(sums[b], parts)]
        weights = {b: [x / sum(own) for x in own] for b, own in sums.items()}
    for b, own in weights.items():
        if b:
            assert np.abs(np.array(own) - seen["w"][b]).max() < 0.03, b


def test_quality_keeps_the_good(spark):
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for k in range(600):
        good = k % 5 > 0
        body = [f"{'abcdefgh'[rng.integers(8)]}{'aeiou'[rng.integers(5)]}n" for _ in range(rng.integers(20, 80))]
        text = " ".join(body) + "." if good else " ".join(f"{w.upper()}!!" for w in body)
        rows.append((k, text, "en", "s", len(text), None, None, None))
        if k % 2:
            labels.append((k, int(good), 0))
    labels += [(None, 1, 0), (3, None, 0), (99999, 0, 0), (5, 1, 0)]
    docs = brute.frame(spark, rows + brute.documents()[7:10])
    named = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = quality.classify(docs, named)
    assert got.count() == docs.count()
    scored = {r["doc_id"]: r for r in got.collect() if r["doc_id"] > 9}
    unlabelled = [k for k in scored if k % 2 == 0]
    right = [scored[k]["keep"] == (k % 5 > 0) for k in unlabelled]
    assert np.mean(right) > 0.97
    assert all(0 <= r[c] <= 1 for r in scored.values() for c in ("text_score", "meta_score", "quality_score"))
    models = [quality.fitted(quality.featured(x), named) for x in (docs, docs.repartition(5))]
    assert np.allclose(models[0].combination.weights, models[1].combination.weights)


def test_exchange_teaches_the_view_that_labels_alone_do_not(spark):
    """Sixteen labels tell the metadata view all that it needs, and the text view next to nothing; documents
    without metadata are then told by the text that the other view's pseudo-labels taught."""
    rng = np.random.default_rng(11)

    def text(good: bool) -> str:
        size = rng.integers(40, 90)
        out = []
        for _ in range(size):
            word = "".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 9)) + (rng.random() < (0.9 if good else 0.1))))
            word = word.upper() if rng.random() < noise[0] else word
            out.append(word + ("!" if rng.random() < noise[1] else "") + ("1" if rng.random() < noise[2] else "") + ("\n" if rng.random() < noise[3] else ""))
        return " ".join(out)

    rows, labels, hidden = [], [], {}
    for k in range(2600):
        noise = rng.random(4) * 0.5
        good = bool(rng.random() < 0.5)
        source = None if k >= 2000 else "ab"[good]
        rows.append((k, text(good), "en" if source else None, source, None, None, None, None))
        if k < 16:
            labels.append((k, int(good), 0))
        if source is None:
            hidden[k] = good
    docs, named = brute.frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    features = quality.featured(docs, ("doc_id",))
    auc = {}
    for rounds in (0, quality.ROUNDS):
        found = {r["doc_id"]: r["text_score"] for r in quality.scored(features, quality.fitted(features, named, rounds=rounds), ("doc_id",)).collect()}
        good, bad = ([found[k] for k in hidden if hidden[k] == g] for g in (True, False))
        auc[rounds] = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc[quality.ROUNDS] > auc[0] + 0.1, auc


def test_one_newton_step_is_that_of_all_rows_together(spark):
    """The distributed sums against the same sums in one piece."""
    docs = brute.frame(spark, [(k, f"word{k % 7} " * (k % 13 + 1), "en", "ab"[k % 2], k, None, None, None) for k in range(90)]).repartition(4)
    features = quality.featured(docs)
    table = features.toArrow()
    text, slots = quality._matrices(table.column(quality.OWN[1]), table.column(quality.OWN[2]))
    label = (slots[:, 0] == slots[0, 0]).astype(float)
    known = quality.Labelled(text[:20], slots[:20], label[:20], np.arange(20) % 8)
    model = quality.co_train(known, features.limit(0).select(*quality.OWN[1:]), 0)
    found = quality._summed(features.select(*quality.OWN[1:]), model, model.views[0])
    (y, w), (z, v) = model.pseudo_labels(text, slots)
    g, c = model.views[0].sums(text, y, w)
    assert w.any() and np.allclose(found.weight, [w[y == 0].sum(), w[y == 1].sum()])
    assert np.allclose(found.gradient.sum(axis=0), g) and np.allclose(found.curve.sum(axis=0), c) and np.allclose(found.counts, quality.slot_counts(slots, z, v))


def test_labelled_rows_are_bounded_whatever_an_id_has(spark):
    rows = [(1, f"text {k}", "en", "s", 1, None, None, None) for k in range(3000)] + [(None, "no id", None, None, None, None, None, None)] * 5
    rows += [(k, "other words", "en", "s", 1, None, None, None) for k in range(2, 50)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(1, 50)], "doc_id bigint, quality int, toxic int")
    features = quality.featured(brute.frame(spark, rows))
    known = quality.labelled_rows(features, quality._votes(labels, 100), 100)
    assert 50 < len(known.label) <= 100
    assert quality.classify(brute.frame(spark, rows), labels, max_labels=100).count() == len(rows)


def test_quality_without_labels(spark):
    docs = brute.frame(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality.classify(docs, none, tuple(docs.columns), prefix="q_")
    assert got.where("q_keep").count() == docs.count() and got.columns[: len(docs.columns)] == docs.columns
    assert quality.classify(docs.limit(0), none).count() == 0


def test_views_see_only_their_own():
    a, b = (quality.meta_slots(pa.array(["s", None, "t"]), pa.array(["en", None, None]), pa.array(n, pa.int64())) for n in ([5, None, 70], [5, None, 71]))
    assert (a == b).all() and len({tuple(r) for r in a}) == 3 and a.max() < sum(quality.SLOTS)


@pytest.mark.parametrize("blocks", [(1024, 4096), (7, 11)])
def test_top_k_is_exact(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", blocks[1])
    rng = np.random.default_rng(2)
    vectors = [(int(k), [float(x) for x in np.round(rng.normal(size=6), 1)]) for k in range(230)]
    vectors += [(k, vectors[k % 3][1]) for k in range(300, 330)]  # ties
    odd = [(50, None), (400, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (450, [float("nan")] * 6), (500, [float("inf")] * 6), (None, [1.0] * 6), (550, [1.0, 2.0]), (551, [3.0, -1.0]), vectors[0], vectors[7]]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors + odd], "vec_id bigint, embedding array<double>, score int")
    got = sorted(map(tuple, topk_search.top_k(df, lambda v: v % 50 == 0).collect()))
    quantised = {i: [math.floor(256 * x) for x in v] for i, v in vectors} | {550: [256, 512], 551: [768, -256]}
    want = []
    for i in sorted(quantised):
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(quantised[i], v, strict=True)), j) for j, v in quantised.items() if j != i and len(v) == len(quantised[i]))
            want += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:5], 1)]
    assert got == want
    assert topk_search.top_k(df.limit(0), lambda v: v % 50 == 0).count() == 0


def test_top_k_of_huge_components(spark):
    rng = np.random.default_rng(3)
    vectors = {k: [float(x) for x in rng.normal(size=2) * 10.0 ** (k % 19)] for k in range(120)}
    vectors |= {200: [3e8, 5.1e8], 250: [-3e8, 5.1e8], 300: [1e300, -1e300], 301: [2.0, 3.0]}
    df = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, topk_search.top_k(df, lambda v: v % 50 == 0).collect()))
    hold = lambda x, low, high: max(low, min(high, x))
    q = {i: [hold(math.floor(256 * x), -(1 << 63), (1 << 63) - 1) for x in v] for i, v in vectors.items()}
    most = topk_search.MOST_SCORE
    want = []
    for i in (0, 50, 100, 200, 250, 300):
        scored = sorted((-hold(sum(a * b for a, b in zip(q[i], v, strict=True)), -most, most), j) for j, v in q.items() if j != i)
        want += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:5], 1)]
    assert got == want


def test_top_k_without_queries(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<double>")
    assert topk_search.top_k(df, lambda v: v % 50 == 0).count() == 0


@pytest.mark.parametrize("range_bytes", [16 << 20, 30_000])
def test_edited_texts_and_fingerprints(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", range_bytes)
    rows = [r for k, r in enumerate(brute.documents()) if k < 16]
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(brute.frame(spark, rows).repartition(3)).collect()}
    assert len(got) == len(rows)
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0]) + [r for r in rows if r[0] is None]
    for r, nxt in zip(order, order[1:] + order[:1], strict=True):
        text, after = r[1] or "", nxt[1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        own = got[r[0]]
        assert own["n_chars"] == len(text) and own["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (fingerprints.digests(pa.array([x])) for x in (text, edited, after))
        assert (own["fingerprint"], own["edited_fingerprint"]) == (fingerprints.hexed(a)[0], fingerprints.hexed(b)[0])
        assert own["near_edited"] == pytest.approx(fingerprints.likeness(a, b)[0]) and own["near_next"] == pytest.approx(fingerprints.likeness(a, c)[0])
    assert fingerprints.fingerprint_edits(brute.frame(spark).limit(0)).count() == 0


def test_fingerprints_of_repeated_and_missing_ids(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 400)
    rows = [(None, f"text {k % 3} without id") for k in range(40)] + [("b", f"text {k} of b") for k in range(40)] + [("a", "the same")] * 40
    got = fingerprints.fingerprint_edits(spark.createDataFrame([(*r, 1) for r in rows], "doc_id string, text string, part int")).collect()
    assert len(got) == len(rows)
    # in the order by id, each text is followed by one of its id, but for the last of an id
    by = {i: [r for r in got if r["doc_id"] == i] for i in ("a", "b", None)}
    assert [len(by[i]) for i in by] == [40, 40, 40]
    same = hashlib.sha256(b"the the ").hexdigest()
    assert sum(r["edited_sha256"] == same for r in by["a"]) == 39
    edits = {hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest() for _, t in rows for _, n in rows}
    assert all(r["edited_sha256"] in edits for r in got)


def test_one_document_is_its_own_next(spark):
    row = fingerprints.fingerprint_edits(brute.frame(spark, [(5, "abcd", None, None, None, None, None, None)])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1


def test_digest_counts_every_triplet():
    text = "äbc" * 50 + "xyz"
    raw = text.encode()
    counts = np.zeros(256, int)
    for k in range(len(raw) - 2):
        value = raw[k] | raw[k + 1] << 8 | raw[k + 2] << 16
        counts[(value * 0x9E3779B1 & 0xFFFFFFFF) >> 24] += 1
    q = np.sort(counts)[[63, 127, 191]]
    codes = [(c > q).sum() for c in counts]
    own = fingerprints.digests(pa.array(["", text, "q" * 2_500_000 + text]))[1]
    assert [own[2 + k // 4] >> 2 * (k % 4) & 3 for k in range(256)] == codes
    many = fingerprints.digests(pa.array([text, text + "!", "something else entirely"]))
    assert (many[0] == own).all() and fingerprints.likeness(many[:1], many[:1])[0] == 1
    assert fingerprints.likeness(many[:1], many[1:2])[0] > fingerprints.likeness(many[:1], many[2:])[0] >= 0


def test_language_id_learns_and_refuses(spark):
    rng = np.random.default_rng(4)
    parts = {"aa": ["thon", "er", "ing", "wh"], "bb": ["ción", "ado", "ll", "que"], "cc": ["шко", "ть", "ов", "ра"]}
    rows = []
    for k in range(400):
        lang = sorted(parts)[k % 3]
        text = " ".join("".join(rng.choice(parts[lang], 2)) for _ in range(rng.integers(4, 40)))
        rows.append((k, text, lang if k % 7 else None, "s", 1, None, None, None))
    rows += [(1000, None, "aa", None, None, None, None, None), (1001, " 12 !? ", "bb", None, None, None, None, None), (None, rows[0][1], "aa", None, None, None, None, None)]
    got = language_id.identify(brute.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[k]["lang_pred"] == sorted(parts)[k % 3] for k in range(400))
    assert (by[1000]["lang_pred"], by[1001]["lang_pred"], by[1001]["score"]) == ("und", "und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert language_id.identify(brute.frame(spark).limit(0)).count() == 0
    unlabelled = language_id.identify(brute.frame(spark, [(1, "words", None, None, None, None, None, None)])).first()
    assert unlabelled["lang_pred"] == "und"


def test_bloom_filter_has_no_false_negative():
    names = [f"l{k:03d}" for k in range(70)]
    rng = np.random.default_rng(1)
    own = {k: rng.integers(0, 1 << 32, 50).astype(np.uint32) for k in range(70)}
    bits = np.zeros((2, 20_000), np.uint64)
    for k, grams in own.items():
        for at in language_id._slots(grams, bits.shape[1]):
            bits[k // 64, at] |= np.uint64(1 << k % 64)
    model = language_id.Model(names, bits, np.zeros(70), np.full(70, 1 / 70))
    for k, grams in own.items():
        assert model.hits(grams)[k].all()


def test_held_out_languages_of_the_documents(spark):
    got = queries()["op10_language_id"](spark, "/root/testdata/sf0.01").where("held_out")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    assert got.where("score >= 0.25").count() > 0.99 * got.count()
    right = got.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_predictions_are_those_of_plain_sets(spark):
    """The filters' decisions against sets of n-grams and exact counts, on held-out texts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    train = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0 and r["lang"] is not None and r["text"]]

    def windows(text: str) -> list[bytes]:
        raw = language_id.normalised(text)
        return [raw[k : k + 4] for k in range(max(1, len(raw) - 3))]

    counts: dict[str, Counter] = {}
    for r in train:
        counts.setdefault(r["lang"], Counter()).update(windows(r["text"]))
    total = {lang: sum(c.values()) for lang, c in counts.items()}
    top = {}
    for lang, c in counts.items():
        for g, n in c.items():
            top[g] = max(top.get(g, 0), n / total[lang])
    known = {lang: {g for g, n in c.items() if n / total[lang] >= max(language_id.MIN_SHARE, language_id.MIN_RATIO * top[g])} for lang, c in counts.items()}
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    for r in rows:
        own = windows(r["text"] or "")
        share = sorted(((sum(g in known[lang] for g in own) / len(own), lang) for lang in known), key=lambda x: (-x[0], x[1]))
        if not any(ch.isalpha() for ch in r["text"] or ""):
            assert got[r["doc_id"]]["lang_pred"] == "und"
        elif share[0][0] - share[1][0] > 0.02:
            assert got[r["doc_id"]]["lang_pred"] == share[0][1]
            assert got[r["doc_id"]]["score"] == pytest.approx(share[0][0] ** 2 / (share[0][0] + share[1][0]), abs=0.02)


def test_held_out_scores_of_the_documents(spark):
    got = queries()["op6_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_pipeline_on_the_smallest_tables(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert docs.count() <= before
        before = docs.count()
    assert before > 0.5 * spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute.components(rows, 5, 80)
    assert all(d == c for d, c in want.items())
    from tokenizers import Tokenizer

    packed = dict(corpus_pipeline.STAGES)["packing"](spark, docs, sf_dir).collect()
    check_packing(packed, Tokenizer.from_file(tokenizer_path()), dict(rows))
    mixed = dict(corpus_pipeline.STAGES)["mixing"](spark, docs, sf_dir)
    assert mixed.columns == docs.columns
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 3
