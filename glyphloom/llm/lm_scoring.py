"""Language-model scores by deleted interpolation, with exact corpus-wide counts.

The model is a bigram model: P(w | h) mixes the maximum-likelihood estimates c(h w) / c(h), c(w) / N and
the uniform 1 / (V + 1), with weights that depend on how frequent the context h is (buckets of its
count).  The weights are learned by expectation-maximisation on held-out counts: every training occurrence
is held out from the counts that predict it (each of c(h w), c(h), c(w), N less one).

How counts meet texts.  Documents are dealt into blocks of a few MB by their place.  A block sends its sorted
distinct n-gram keys, with its own training counts, to key ranges; a range adds up the counts of all blocks
and answers each block with counts in the order of its keys.  So an n-gram moves once for each block, not
for each occurrence, no table is broadcast, and a frequent word is one key per block.  Every node talks to at
most ``FAN`` others: beyond ``FAN`` blocks the keys pass through nodes that merge as many blocks for a
part of the keys, level by level (as in a butterfly), and the answers come back by the same way.  Messages thus
grow as blocks x FAN x levels, never as the square of the input, and a node holds about as many keys as a block.
The block then turns every token into its counts and stores them with the parts of the score that need no
weights; a second pass over that table scores.  For EM the counts are gathered in a histogram over logarithmic
bins of all training tokens, with each bin's mean estimates; its size is bounded whatever the input, and only it
comes to the driver.  Counts
are exact up to 2**53 tokens; words and bigrams are named by 64-bit hashes.

Defined cases: a null text counts as empty (its only token is the end); a null doc_id has crc32 of the empty
string; repeated rows are counted and scored each; without training documents N and V are 0 and both
scores use the uniform estimate; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphloom.llm._arrays import U64, mix, words_of
from glyphloom.llm._storage import input_bytes, small_batches, stored

BLOCK_BYTES = 6 << 20
#: Most blocks, or nodes, that a node takes keys from, and most key ranges that it sends to.
FAN = 512
#: Bins of EM's histogram per factor of two, and buckets of the context count (by powers of two).
BINS = 4
BUCKETS = 40
EM_STEPS = 60
END = U64(0x2545F4914F6CDD1D)
BEGIN = U64(0x9E6C63D0876A9A99)
_PAIR = U64(0xD1342543DE82EF95)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all rows of a column: unigram keys with an end each, bigram keys, tokens per row."""
    words, sizes = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for _, _, w, n in words_of(column):
        words.append(w)
        sizes.append(n)
    words, sizes = np.concatenate(words), np.concatenate(sizes)
    ends = np.cumsum(sizes + 1) - 1
    total = int(ends[-1]) + 1 if len(ends) else 0
    token = np.empty(total, U64)
    inner = np.ones(total, bool)
    inner[ends] = False
    token[inner], token[ends] = words, END
    context = np.empty(total, U64)
    context[1:] = token[:-1]
    context[ends[:-1] + 1] = BEGIN
    if total:
        context[0] = BEGIN
    # a unigram key has its lowest bit clear, a bigram key set: one key space for both
    return token & ~U64(1), mix(context * _PAIR + token) | U64(1), sizes + 1


def _block_keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys of a block, their places by token (unigram, bigram), tokens and held_out by row."""
    uni, bi, sizes = _tokens(table.column("text").combine_chunks())
    out = table.column("out").to_numpy()
    keys, place = np.unique(np.concatenate([uni, bi]), return_inverse=True)
    return keys, place[: len(uni)], place[len(uni) :], sizes, out


def _pack(x: np.ndarray) -> bytes:
    """Numbers by byte plane (all first bytes, all second bytes, ...), compressed."""
    planes = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(raw: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(raw, n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n)


def _pack_counts(x: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs; the first byte tells how many."""
    width = next(w for w in (1, 2, 4, 8) if int(x.max(initial=0)) < 1 << 8 * w)
    return bytes([width]) + _pack(x.astype(f"<u{width}"))


def _unpack_counts(raw: bytes, n: int) -> np.ndarray:
    raw = memoryview(raw)
    return _unpack(raw[1:], n, f"<u{raw[0]}").astype(np.int64)


def _pack_codes(x: np.ndarray) -> list[bytes]:
    """Numbers with many repeats: their distinct values, and which of them each is."""
    value, code = np.unique(x, return_inverse=True)
    return [value.astype(np.int64).tobytes(), _pack(code.astype(np.uint32))]


def _unpack_codes(value: bytes, code: bytes, n: int) -> np.ndarray:
    return np.frombuffer(value, np.int64)[_unpack(code, n, np.uint32)]


def levels(blocks: int) -> tuple[int, int]:
    """How often keys are merged, and the fan of each level: fan ** levels >= blocks, fan <= FAN."""
    depth = 1
    while FAN**depth < blocks:
        depth += 1
    fan = 1
    while fan**depth < blocks:
        fan += 1
    return depth, fan


#: A node is a group of blocks and a key range: (g, r); at level 0 a block, with r = 0.  ``child``: who sent.
_REQUEST = pa.schema([("g", pa.int64()), ("r", pa.int64()), ("child_g", pa.int64()), ("child_r", pa.int64()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_REPLY = pa.schema([("g", pa.int64()), ("r", pa.int64()), ("range", pa.int64()), ("n", pa.int32()), ("counts", pa.binary()), ("tokens", pa.int64()), ("kinds", pa.int64())])
_REQUEST_SQL = "g bigint, r bigint, child_g bigint, child_r bigint, n int, keys binary, counts binary"
_REPLY_SQL = "g bigint, r bigint, range bigint, n int, counts binary, tokens bigint, kinds bigint"


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema) if rows else schema.empty_table()


def _sent(keys: np.ndarray, counts: np.ndarray, g: int, r: int, level: int, fan: int) -> pa.Table:
    """The messages of a node of ``level`` to the ``fan`` nodes above it, by key range."""
    parts, first = fan ** (level + 1), r * fan
    limits = np.array([(q << 64) // parts for q in range(first + 1, first + fan)], U64)
    edges = np.concatenate([[0], np.searchsorted(keys, limits), [len(keys)]])
    # keys go as differences: sorted and even, they need a quarter less room
    rows = [
        (g // fan, first + j, g, r, int(b - a), _pack(np.diff(keys[a:b], prepend=U64(0))), _pack_counts(counts[a:b]))
        for j, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a
    ]
    return _rows(rows, _REQUEST)


def _requests(fan: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, uni, bi, sizes, out = _block_keys(table)
        train = np.repeat(~out, sizes)
        counts = np.bincount(np.concatenate([uni[train], bi[train]]), minlength=len(keys))
        return _sent(keys, counts, key[0].as_py(), 0, 0, fan)

    return run


def _received(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Of a node's messages: their lengths, its distinct keys, each received key's place among them, and sums."""
    n = table.column("n").to_pylist()
    keys = np.concatenate([np.cumsum(_unpack(k.as_buffer(), m, U64), dtype=U64) for k, m in zip(table.column("keys"), n, strict=True)])
    counts = np.concatenate([_unpack_counts(c.as_buffer(), m) for c, m in zip(table.column("counts"), n, strict=True)])
    distinct, place = np.unique(keys, return_inverse=True)
    return n, distinct, place, np.bincount(place, weights=counts.astype(np.float64)).astype(np.int64)


def _merged(level: int, fan: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, distinct, _, total = _received(table)
        return _sent(distinct, total, key[0].as_py(), key[1].as_py(), level, fan)

    return run


def _answered(table: pa.Table, r: int, n: list[int], total: np.ndarray, place: np.ndarray, facts: tuple[int, int]) -> pa.Table:
    """An answer to each message, in the order of its keys; ``facts`` go with the first."""
    ends, children = np.cumsum(n), zip(table.column("child_g").to_pylist(), table.column("child_r").to_pylist(), strict=True)
    rows = [(*child, r, m, _pack_counts(total[place[e - m : e]]), *(facts if k == 0 else (0, 0))) for k, (child, m, e) in enumerate(zip(children, n, ends, strict=True))]
    return _rows(rows, _REPLY)


def _totals(key: tuple, table: pa.Table) -> pa.Table:
    """The highest nodes: sums of all blocks for a key range, and the range's own totals once."""
    n, distinct, place, total = _received(table)
    unigram = (distinct & U64(1)) == 0
    return _answered(table, key[1].as_py(), n, total, place, (int(total[unigram].sum()), int((total[unigram] > 0).sum())))


def _told(replies: pa.Table, expected: int) -> tuple[np.ndarray, tuple[int, int]]:
    """All counts that came back to a node, in key order, and the facts that came with them."""
    order = np.argsort(replies.column("range").to_numpy())
    parts = [_unpack_counts(replies.column("counts")[int(k)].as_buffer(), replies.column("n")[int(k)].as_py()) for k in order]
    counts = np.concatenate([*parts, np.zeros(0, np.int64)])
    if len(counts) != expected:
        raise RuntimeError("a block's keys changed between two readings of the documents")
    return counts, (sum(replies.column("tokens").to_pylist()), sum(replies.column("kinds").to_pylist()))


def _passed_on(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
    """A node in between: what came back for its keys, dealt out to those who sent them."""
    if not table.num_rows:
        return _REPLY.empty_table()
    n, distinct, place, _ = _received(table)
    total, facts = _told(replies, len(distinct))
    return _answered(table, key[1].as_py(), n, total, place, facts)


def corpus_counts(dealt: DataFrame, blocks: int) -> DataFrame:
    """Answers for every block: for its distinct keys in order, their counts in the whole corpus."""
    depth, fan = levels(blocks)
    up = [dealt.groupBy("block").applyInArrow(_requests(fan), _REQUEST_SQL)]
    for level in range(1, depth):
        up.append(up[-1].groupBy("g", "r").applyInArrow(_merged(level, fan), _REQUEST_SQL))
    replies = up[-1].groupBy("g", "r").applyInArrow(_totals, _REPLY_SQL)
    for sent in reversed(up[:-1]):
        replies = sent.groupBy("g", "r").cogroup(replies.groupBy("g", "r")).applyInArrow(_passed_on, _REPLY_SQL)
    return replies


#: Kinds: 0 the documents of a block, 1 a bin of EM's histogram, 2 totals of key ranges (N in bin, V in n).
_COUNTED = "kind int, doc_id array<{}>, held_out array<boolean>, n_tokens array<bigint>, n_known array<bigint>, base_sum array<double>, payload array<binary>, bin bigint, n bigint, bigram double, unigram double"


def _bins(x: np.ndarray) -> np.ndarray:
    """Logarithmic bin of positive numbers, 0 for none."""
    return np.where(x > 0, 1 + np.round(np.log2(np.maximum(x, 1)) * BINS), 0).astype(np.int64)


def _counted(kind: pa.DataType):
    lists = [("doc_id", kind), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_sum", pa.float64()), ("payload", pa.binary())]
    schema = pa.schema([("kind", pa.int32()), *((c, pa.list_(t)) for c, t in lists), ("bin", pa.int64()), ("n", pa.int64()), ("bigram", pa.float64()), ("unigram", pa.float64())])

    def run(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        keys, uni, bi, sizes, out = _block_keys(docs)
        counts, (tokens, kinds) = _told(replies, len(keys))
        c_w, c_hw = counts[uni], counts[bi]
        ends = np.cumsum(sizes)
        begins = ends - sizes
        known = np.add.reduceat((c_w > 0).astype(np.int64), begins)
        base = np.add.reduceat(np.log10(c_w + 0.5), begins)
        # the context of a token is the token before it; a text's first has the begin, as frequent as the end
        c_h = np.empty(len(c_w), np.int64)
        c_h[1:] = c_w[:-1]
        c_h[begins] = c_w[ends - 1]
        train = np.repeat(~out, sizes)
        value, place, n = np.unique(em_code(c_hw[train] - 1, c_h[train] - 1, c_w[train] - 1), return_inverse=True, return_counts=True)
        bigram = np.bincount(place, weights=(c_hw[train] - 1) / np.maximum(c_h[train] - 1, 1), minlength=len(value))
        unigram = np.bincount(place, weights=(c_w[train] - 1).astype(float), minlength=len(value))
        more = len(value) + 1
        whole = [docs.column("doc_id").to_pylist(), out.tolist(), sizes.tolist(), known.tolist(), base.tolist(), [*_pack_codes(c_w), *_pack_codes(c_hw)]]
        return pa.Table.from_arrays(
            [
                pa.array([0, *[1] * len(value), 2], pa.int32()),
                *(pa.array([x, *[None] * more], schema.field(c).type) for (c, _), x in zip(lists, whole, strict=True)),
                pa.array([None, *value.tolist(), tokens], pa.int64()),
                pa.array([None, *n.tolist(), kinds], pa.int64()),
                pa.array([None, *bigram.tolist(), None], pa.float64()),
                pa.array([None, *unigram.tolist(), None], pa.float64()),
            ],
            schema=schema,
        )

    return run


def bucket(c_h: np.ndarray) -> np.ndarray:
    """The bucket of a context count: 0 for unseen, then by powers of two."""
    return np.minimum(BUCKETS - 1, np.where(c_h > 0, 1 + np.floor(np.log2(np.maximum(c_h, 1))), 0)).astype(np.int64)


def em_code(c_hw: np.ndarray, c_h: np.ndarray, c_w: np.ndarray) -> np.ndarray:
    """Bucket of the context, bin of c(h) / c(h w) and bin of c(w), as one number."""
    ratio = np.where(c_hw > 0, c_h / np.maximum(c_hw, 1), 0)
    return (bucket(c_h) << 20) | (_bins(ratio) << 10) | _bins(c_w)


@dataclass
class Model:
    tokens: int
    kinds: int
    #: BUCKETS x 3: weights of the bigram, unigram and uniform estimates
    weights: np.ndarray

    def log10(self, c_w: np.ndarray, c_hw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Scores of texts whose tokens stand in a row."""
        c_h = np.empty(len(c_w))
        c_h[1:] = c_w[:-1]
        c_h[begins] = c_w[ends - 1]
        w = self.weights[bucket(c_h)]
        p = w[:, 0] * c_hw / np.maximum(c_h, 1) + w[:, 1] * c_w / max(self.tokens, 1) + w[:, 2] / (self.kinds + 1)
        return np.add.reduceat(np.log10(p), begins)


def learn_weights(code: np.ndarray, n: np.ndarray, bigram: np.ndarray, unigram: np.ndarray, tokens: int, kinds: int) -> np.ndarray:
    """EM over the histogram of held-out occurrences: ``n`` by bin, and sums of c(h w) / c(h) and c(w) over each bin."""
    weights = np.tile(np.array([0.4, 0.4, 0.2]), (BUCKETS, 1))
    own = code >> 20
    p = np.stack([bigram / n, unigram / n / max(tokens - 1, 1), np.full(len(code), 1 / (kinds + 1))], axis=1)
    for _ in range(EM_STEPS):
        part = weights[own] * p
        part *= (n / part.sum(axis=1))[:, None]
        new = np.stack([np.bincount(own, weights=part[:, k], minlength=BUCKETS) for k in range(3)], axis=1)
        new = new + np.array([0.0, 0.5, 0.5])  # no bucket gives up the estimates that cover unseen words
        weights = new / new.sum(axis=1, keepdims=True)
    weights[0] = [0, weights[0][1], weights[0][2]]
    weights[0] /= weights[0].sum()
    return weights


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    small_batches(docs.sparkSession)
    size = docs.agg(input_bytes(F.col("text"))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    # by place, so that repeated rows are dealt out too
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("long").alias("block")
    dealt = docs.select(block, "doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("out"))
    replies = corpus_counts(dealt, blocks)
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow_kind = docs.select("doc_id").limit(0).toArrow().schema.field(0).type
    counted = dealt.groupBy("block").cogroup(replies.groupBy("g")).applyInArrow(_counted(arrow_kind), _COUNTED.format(kind))
    counted = stored(counted, "lm-counts")
    facts = counted.where(F.col("kind") == 2).agg(F.coalesce(F.sum("bin"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("n"), F.lit(0)).alias("kinds")).first()
    histogram = counted.where(F.col("kind") == 1).groupBy("bin").agg(*[F.sum(c).alias(c) for c in ("n", "bigram", "unigram")]).toArrow().sort_by("bin")
    code, n, bigram, unigram = (histogram.column(c).to_numpy().astype(kind) for c, kind in (("bin", np.int64), ("n", float), ("bigram", float), ("unigram", float)))
    tokens, kinds = facts["tokens"], facts["kinds"]
    model = Model(tokens, kinds, learn_weights(code, n, bigram, unigram, tokens, kinds))

    base = float(np.log10(tokens + 0.5 * (kinds + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["n_tokens"], np.int64)
                ends, payload = np.cumsum(sizes), row["payload"]
                c_w, c_hw = (_unpack_codes(*payload[k : k + 2], int(ends[-1])).astype(np.float64) for k in (0, 2))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_id"], arrow_kind),
                        pa.array(row["held_out"], pa.bool_()),
                        pa.array(sizes),
                        pa.array(row["n_known"], pa.int64()),
                        pa.array(np.array(row["base_sum"]) - sizes * base),
                        pa.array(model.log10(c_w, c_hw, ends - sizes, ends)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    rows = counted.where(F.col("kind") == 0).select("doc_id", "held_out", "n_tokens", "n_known", "base_sum", "payload")
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
