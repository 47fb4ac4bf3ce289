"""Mixing, token counts, packing, near duplicates."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from glyphloom.llm import mixing, near_dedup, packing, token_counts
from glyphloom.llm._arrays import shingles, words_of
from glyphloom.llm.queries import tokenizer_path
from tests.llm import brute


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_words_match_the_pattern():
    texts = [r[1] for r in brute.documents()]
    got = {}
    for a, _, hashes, counts in words_of(pa.array(texts, pa.string())):
        ends = np.cumsum(counts)
        for k, n in enumerate(counts):
            got[a + k] = hashes[ends[k] - n : ends[k]]
    named: dict[int, str] = {}
    for k, t in enumerate(texts):
        own = brute.words(t)
        assert len(own) == len(got[k]), k
        for w, h in zip(own, got[k], strict=True):
            assert named.setdefault(int(h), w) == w


def test_long_text_is_hashed_in_parts_like_a_whole():
    long = "ab cd " * 300_000
    (_, _, hashes, counts),  = words_of(pa.array([long]))
    assert counts.tolist() == [600_000] and len(set(hashes.tolist())) == 2


@pytest.mark.parametrize("width", [4, 5])
def test_shingles_are_sets(width):
    texts = [r[1] for r in brute.documents()]
    sizes = []
    for _, _, hashes, counts in words_of(pa.array(texts, pa.string())):
        sizes += shingles(hashes, counts, width)[1].tolist()
    assert sizes == [len(brute.shingle_set(t, width)) for t in texts]


def test_mix_reaches_its_targets(spark):
    rows = [(k, "w " * (k % 9 + 1), "en", ("a", "b", "c", None)[0 if k % 3 else k % 4], 1, None, None, None) for k in range(4000)]
    got = mixing.mix_sources(brute.frame(spark, rows)).collect()
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] % r["size"] == 0
        by[r["source"]][0] += r["size"]
        by[r["source"]][1] += r["taken"]
        by[r["source"]][2] = r["target"]
    total = sum(v[0] for v in by.values())
    order = sorted(by, key=lambda s: (s is None, s))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    # brute force: reshare the excess until no source is above its cap
    target, capped = {}, set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(3 * by[s][0] for s in capped)
        target = {s: 3.0 * by[s][0] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in order}
        over = {s for s in free if target[s] > 3 * by[s][0]}
        if not over:
            break
        capped |= over
    for s in order:
        assert by[s][2] == pytest.approx(target[s])
        assert abs(by[s][1] - target[s]) <= 9
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix_sources(brute.frame(spark, rows).repartition(3)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}


@pytest.mark.parametrize("most", [20_000, 0])
def test_mix_tells_rows_without_ids_and_repeated_rows(spark, monkeypatch, most):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", most)
    rows = [(None, f"w w w w x{k}", "en", "a", 1, None, None, None) for k in range(1000)]
    rows += [(7, "the same five words again", "en", "b", 1, None, None, None)] * 1000
    rows += [(k, "z " * 9, "en", "c", 1, None, None, None) for k in range(100)]
    docs = brute.frame(spark, rows)
    runs = [mixing.mix_sources(x).collect() for x in (docs.repartition(3), docs.coalesce(1))]
    for got in runs:
        assert len(got) == len(rows)
        for source, size in (("a", 5), ("b", 5), ("c", 9)):
            own = [r for r in got if r["source"] == source]
            assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 2 * size, source
    told = [sorted((str(r["doc_id"]), r["text"], r["taken"]) for r in got) for got in runs]
    assert told[0] == told[1]


def test_mix_on_awkward_documents(spark):
    docs = brute.frame(spark)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["size"] == len(brute.words(r["text"])) and r["length"] in (1, None)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    times = defaultdict(int)
    for r in got:
        times[r["doc_id"], r["text"]] += r["copies"]
    taken = defaultdict(int)
    for r in mixed.collect():
        taken[r["doc_id"], r["text"]] += 1
        assert (r["size"], r["target"]) == (("clash", "t") if r["doc_id"] is not None else (None, None))
    assert taken == {k: n for k, n in times.items() if n}
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_token_counts_are_the_library_s(spark, tokenizer):
    rows = brute.documents()
    got = token_counts.count_tokens(brute.frame(spark), tokenizer_path()).collect()
    want = sorted(((r[0] if r[0] is not None else -1), len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    assert token_counts.count_tokens(brute.frame(spark).limit(0), tokenizer_path()).count() == 0


AWKWARD = ["", " ", "  ", " a", "a ", "a  b", "a \n b\t\tc", "é\n\nb", "x\x1c y\x85 z  q", "it's don't 'x' 12 3x", "a.b,c ?!?", "\r\n \r\n", "日本 語　 。 x", "“q” – z", "b<|endoftext|> c  <|endoftext|>  d", "<|endoftext|>"]


def test_pieces_never_change_tokens(tokenizer):
    for text in AWKWARD + ["".join(x) for x in zip(AWKWARD, AWKWARD[::-1], strict=True)]:
        (counts, ids), = token_counts.encoded(tokenizer_path(), pa.array([text]), True)
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
        assert counts.tolist() == [len(ids)]


def test_pieces_of_random_texts(tokenizer):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.text(st.sampled_from("ab'Z9 .,!\n\t\r é  日́\x1c\x85-"), max_size=14), min_size=1, max_size=4))
    def same(texts):
        groups = list(token_counts.encoded(tokenizer_path(), pa.array(texts), True))
        assert np.concatenate([ids for _, ids in groups]).tolist() == [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids]

    same()


def test_sentencepiece_counts(spark):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(1, "Some words, ünd more.", None, None, None, None, None, None), (2, None, None, None, None, None, None, None)]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(brute.frame(spark, rows), path).collect()}
    assert got == {1: len(model.encode(rows[0][1])), 2: 0}


def thue_morse(n: int, letters: str = "ab") -> str:
    """The sequence and its complement have equal sums under any powers of an odd number, modulo a power of two."""
    return "".join(letters[k.bit_count() & 1] for k in range(n))


def test_structured_texts_keep_their_own_tokens(spark, tokenizer):
    texts = [thue_morse(n, letters) for n in (1024, 4096, 1 << 16) for letters in ("ab", "ba")]
    texts += [" ".join([thue_morse(256), thue_morse(256, "ba")] * 3), "<|endoftext|> special", "plain"]
    rows = [(k, t, "en", "s", 1, None, None, None) for k, t in enumerate(texts)]
    want = {k: tokenizer.encode(t, add_special_tokens=False).ids for k, t in enumerate(texts)}
    got = token_counts.count_tokens(brute.frame(spark, rows).coalesce(1), tokenizer_path()).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {k: len(x) for k, x in want.items()}
    check_packing(packing.pack_documents(brute.frame(spark, rows).coalesce(1), tokenizer_path()).collect(), tokenizer, dict(enumerate(texts)))
    linked = near_dedup.near_duplicates(brute.frame(spark, rows), 4, 80).collect()
    assert all(r["component_id"] == r["doc_id"] for r in linked)


def test_repeated_hashes_do_not_change_tokens(tokenizer, monkeypatch):
    monkeypatch.setattr(token_counts, "span_hashes", lambda data, starts: np.zeros(len(starts), np.uint64))
    monkeypatch.setattr(token_counts, "_memos", {})
    texts = ["one two three", "four five", "", "six <|endoftext|> seven"]
    (counts, ids), = token_counts.encoded(tokenizer_path(), pa.array(texts), True)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def check_packing(rows, tokenizer, texts, limit=2048):
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= limit
        total += at
        padding += 0 if at & (at - 1) == 0 else limit - at
    assert padding <= 0.02 * total + limit
    for doc, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        own = sorted(pieces[doc], key=lambda r: r["start"])
        at = 0
        for r in own:
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_packing_is_a_partition_of_all_ids(spark, tokenizer):
    rows = [r for k, r in enumerate(brute.documents()) if k < 16]
    rows += [(100 + k, "some words " * (k * 37 % 900), "en", "s", 1, None, None, None) for k in range(60)]
    got = packing.pack_documents(brute.frame(spark, rows), tokenizer_path()).collect()
    check_packing(got, tokenizer, {r[0]: r[1] for r in rows})
    assert packing.pack_documents(brute.frame(spark).limit(0), tokenizer_path()).count() == 0


def test_packing_of_repeated_rows(spark):
    rows = [brute.documents()[0]] * 3
    got = packing.pack_documents(brute.frame(spark, rows), tokenizer_path()).collect()
    assert sum(r["length"] for r in got) == 3 * got[0]["doc_tokens"]


@pytest.mark.parametrize("limits", [packing.Limits(64, 5, 40, 16), packing.Limits(2048, 256, 2048, 64), packing.Limits(32, 2, 8, 4)])
def test_packer_keeps_every_limit(limits):
    rng = np.random.default_rng(3)
    examples = []
    for k in range(300):
        n = int(rng.integers(1, 90))
        ids = rng.integers(0, 1000, n).astype(np.uint32)
        examples.append(packing.Piece(k, 0, ids, rng.random(n) < 0.5, n))
    seen = defaultdict(list)
    for sequence in packing.pack_pieces(iter(examples), limits):
        assert sum(len(p.ids) for p in sequence) <= limits.tokens
        assert len(sequence) <= limits.segments
        assert sum(int(p.loss.sum()) for p in sequence) <= limits.loss_tokens
        for p in sequence:
            seen[p.key].append(p)
    for e in examples:
        own = sorted(seen[e.key], key=lambda p: p.start)
        assert np.concatenate([p.ids for p in own]).tolist() == e.ids.tolist()
        assert [p.start for p in own] == np.cumsum([0, *[len(p.ids) for p in own]])[:-1].tolist()


@pytest.mark.parametrize(("limits", "binding"), [(packing.Limits(64, 50, 64, 8), 0), (packing.Limits(10_000, 4, 10_000, 8), 1), (packing.Limits(10_000, 50, 32, 8), 2)])
def test_each_limit_closes_sequences(limits, binding):
    rng = np.random.default_rng(4)
    examples = [packing.Piece(k, 0, np.arange(n, dtype=np.uint32), np.arange(n) % 2 == 1, n) for k, n in enumerate(rng.integers(10, 40, 200).tolist())]
    found = list(packing.pack_pieces(iter(examples), limits))[:-4]
    sizes = np.array([(sum(len(p.ids) for p in s), len(s), sum(int(p.loss.sum()) for p in s)) for s in found])
    caps = (limits.tokens, limits.segments, limits.loss_tokens)
    # most sequences end at that limit, but for the pieces that closing at a power of two gives back, and at no other
    assert np.mean(sizes[:, binding] >= caps[binding] / 2) > 0.75
    assert all(sizes[:, k].max() < caps[k] for k in range(3) if k != binding)


def test_packed_conversations(spark, tokenizer):
    from glyphloom.llm import chat_format

    rows = [(c, t, "assistant" if t % 2 else "user", f"turn {t} of {c}: " + "words and more " * ((c * 7 + t) % 30)) for c in range(60) for t in range(4)]
    rows += [(100, 0, "user", "no answer"), (101, 0, "assistant", "é </turn>\n\\ ### x"), (None, 0, None, None)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    masked = {r["conv_id"]: r for r in chat_format.masked_conversations(frame).collect()}
    got = packing.pack_conversations(frame, tokenizer_path()).collect()
    sequences, loss, total = defaultdict(list), defaultdict(int), {}
    for r in got:
        sequences[r["sequence_id"]].append(r)
        loss[r["conv_id"]] += r["loss_tokens"]
        total[r["conv_id"]] = r["doc_tokens"]
    limits = packing.CHAT_LIMITS
    for parts in sequences.values():
        assert sum(r["length"] for r in parts) <= limits.tokens and len(parts) <= limits.segments and sum(r["loss_tokens"] for r in parts) <= limits.loss_tokens
    for conv, r in masked.items():
        whole = tokenizer.encode(r["formatted"], add_special_tokens=False)
        under = sum(any(s["begin"] <= a < s["end"] for s in r["loss_mask"]) for a, _ in whole.offsets)
        assert (total[conv], loss[conv]) == (len(whole.ids) + 1, under + 1)
    assert loss[100] == 1 and packing.pack_conversations(frame.limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize(("width", "rows"), [(4, brute.documents()), (5, brute.planted()), (4, brute.planted(30))])
def test_components_are_exact(spark, width, rows):
    got = near_dedup.near_duplicates(brute.frame(spark, rows).repartition(3), width=width, percent=80).collect()
    assert len(got) == len(rows)
    want = brute.components(rows, width, 80)
    sizes = {r[0]: len(brute.shingle_set(r[1], width)) for r in rows}
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (sizes[r["doc_id"]], want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


def test_large_bucket_is_compared_in_cells(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CELL", 7)
    monkeypatch.setattr(near_dedup, "FANOUT", 5)
    rows = brute.planted()
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(brute.frame(spark, rows), 4, 80).collect()}
    assert got == brute.components(rows, 4, 80)


def test_rows_without_ids_and_ids_on_several_texts(spark):
    near = [" ".join([f"w{j}" for j in range(200)] + [f"own{k}"]) for k in range(60)]
    apart = " ".join(f"other{j}" for j in range(50))
    rows = [(None, t) for t in near * 3] + [(5, near[0]), (5, apart), (5, apart), (8, apart + " more"), (9, near[1])]
    docs = brute.frame(spark, [(*r, None, None, None, None, None, None) for r in rows])
    got = near_dedup.near_duplicates(docs, 4, 80).collect()
    assert len(got) == len(rows)
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {5}
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == {5: 5, 8: 5, 9: 5}
    kept = near_dedup.one_of_each(docs).collect()
    assert sorted(r["text"] == apart for r in kept) == [False, True] and {r["doc_id"] for r in kept} == {5}


def test_one_of_each_group_stays(spark):
    rows = brute.planted(12)
    docs = brute.frame(spark, [*rows, rows[0], rows[0]])
    got = near_dedup.one_of_each(docs)
    assert got.columns == docs.columns
    want = brute.components(rows, 5, 80)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(d for d, c in want.items() if d == c)
    assert near_dedup.one_of_each(docs.limit(0)).count() == 0


def test_odd_sketches_tell_high_similarities():
    rng = np.random.default_rng(1)
    for similarity in (0.8, 0.9, 0.97):
        inside = []
        for _ in range(40):
            n = 2000
            common = int(n * 2 * similarity / (1 + similarity))
            pool = rng.integers(0, 1 << 63, 2 * n - common).astype(np.uint64)
            a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:common], pool[n:]]))
            s = near_dedup.samples(np.concatenate([a, b]), np.array([len(a), len(b)]))
            odd = near_dedup.odd_sketch(s)
            inside.append(int(np.unpackbits(odd[0] ^ odd[1]).sum()))
        assert abs(np.mean(inside) - near_dedup.expected_xor(similarity)) < 8
        assert max(inside) <= near_dedup.most_xor(80)


def test_components_of_paths_and_stars(spark):
    from glyphloom.llm.components import components

    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201), (201, 200), (202, 202), (129, 300), (300, 301)]
    got = {r["u"]: r["component"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 30)} | {201: 200, 300: 100, 301: 100}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
