"""MinHash near-duplicate detection with odd sketches, confirmed on full shingle sets.

1. One pass over the texts: the distinct shingles of each document, a key of the whole set, ``HASHES`` MinHash
   values, folded into ``BANDS`` band keys and into an odd sketch (the parity bitmap of the hashed samples),
   and a second odd sketch of the shingles themselves.
2. Equal sets are one node, whatever their number.  Nodes that share a band key meet: every node of a bucket
   with the bucket's leader, the one that shares most buckets.  The XOR of two odd sketches bounds
   the similarity; pairs that can't reach the threshold stop here, the rest are confirmed on the full
   sets of both texts.  Confirmed links give first components.
3. Buckets that still span several components: all pairs across components are compared by their sketches,
   inside the task, in cells of bounded size (a large bucket is divided into chunks, every two of which
   meet in a cell), and only pairs that pass leave it, to be confirmed as before.  So a link is never
   lost for want of a leader, and no group's pairs are emitted.

The population count of the XOR of the shingles' sketches never exceeds the number of shingles in which two
sets differ, so that bound loses nothing, and for sets of up to some thousand shingles it is nearly exact;
for longer texts the samples' sketch decides, at five deviations.  The chance that a pair at the threshold
shares no band is 1.2e-7 with 40 bands of 5.  A leader with many partners is salted: at most ``FANOUT``
partners per task key.  Shingles are told apart by 128 bits (two 64-bit hashes under independent keys) wherever
a link or an equality is confirmed: two different shingles count as one with a chance of 2**-128.

Defined cases: A-Z is lower-cased; a text with fewer words than the width is one shingle; a null or blank
text has no shingles and links with nothing; repeated rows are one node; rows with a null id, or with an id that
stands on several texts, are told apart by their texts; null ids never name a component unless
all ids in it are null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.llm._arrays import U64, mix, shingles, words_of
from glyphloom.llm._storage import dropped, small_batches, stored
from glyphloom.llm.components import components

BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
SKETCH_BITS = 512
#: Bits of the sketch of the shingles themselves.
SET_BITS = 2048
FANOUT = 200
#: Sets of a chunk of a large bucket; a task compares two chunks at once.
CELL = 256
_MULTIPLY = (mix(np.arange(1, HASHES + 1).astype(U64)) | U64(1)).astype(np.uint32)
_FLIP = (mix(np.arange(1001, HASHES + 1001).astype(U64)) >> U64(32)).astype(np.uint32)


def expected_xor(similarity: float) -> float:
    """Expected differing bits of two odd sketches."""
    return SKETCH_BITS / 2 * (1 - np.exp(-4 * HASHES * (1 - similarity) / SKETCH_BITS))


def most_xor(percent: int) -> int:
    """Beyond this many differing bits a pair is below the threshold: five deviations of MinHash and sketch."""
    low = percent / 100
    low -= 5 * np.sqrt(low * (1 - low) / HASHES + 1e-9)
    bits = expected_xor(max(0.0, low))
    return int(bits + 5 * np.sqrt(bits * (1 - bits / SKETCH_BITS)) / 2)


def samples(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """HASHES x rows MinHash values of rows with at least one shingle."""
    x = (values >> U64(32)).astype(np.uint32)
    begins = np.cumsum(counts) - counts
    out = np.empty((HASHES, len(counts)), np.uint32)
    for k in range(HASHES):
        out[k] = np.minimum.reduceat((x ^ _FLIP[k]) * _MULTIPLY[k], begins)
    return out


def band_keys(sample: np.ndarray) -> np.ndarray:
    """Rows x BANDS keys; equal keys only within one band."""
    out = np.empty((sample.shape[1], BANDS), np.int64)
    for b in range(BANDS):
        key = np.full(sample.shape[1], b, U64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            key = mix(key + sample[k].astype(U64) * U64(0x9E3779B97F4A7C15))
        out[:, b] = key.view(np.int64)
    return out


def odd_sketch(sample: np.ndarray) -> np.ndarray:
    """Rows x SKETCH_BITS / 8 bytes: the parity of the samples that fall on each bit."""
    hashes, rows = sample.shape
    bit = mix(sample.astype(U64) + (np.arange(hashes).astype(U64) << U64(32))[:, None]) % U64(SKETCH_BITS)
    place = np.arange(rows)[None, :] * SKETCH_BITS + bit.astype(np.int64)
    parity = np.bincount(place.ravel(), minlength=rows * SKETCH_BITS).reshape(rows, SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8), axis=1)


def set_sketch(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows x SET_BITS / 8 bytes: the parity of the shingles that fall on each bit."""
    place = np.repeat(np.arange(len(counts)), counts) * SET_BITS + (values % U64(SET_BITS)).astype(np.int64)
    out = []
    for a in range(0, len(counts), 256):
        own = place[(place >= a * SET_BITS) & (place < (a + 256) * SET_BITS)] - a * SET_BITS if len(counts) > 256 else place
        rows = min(256, len(counts) - a)
        out.append(np.packbits((np.bincount(own, minlength=rows * SET_BITS) & 1).astype(np.uint8).reshape(rows, SET_BITS), axis=1))
    return np.concatenate(out)


def _set_key(values: np.ndarray, others: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes() + others.tobytes(), digest_size=16).digest()


def _merge(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A sort-merge join at every size: the plan of a small input is that of a large one, and large keys can be split."""
    return left.join(right.hint("merge"), on, how)


def signatures(docs: DataFrame, width: int, more: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, set_key, bands, sketch of every row, the last three null without shingles; and the columns ``more``."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (a, b, words, counts), (_, _, other, _) in zip(words_of(batch.column(1)), words_of(batch.column(1), 1), strict=True):
                values, n, others = shingles(words, counts, width, other)
                full = np.flatnonzero(n)
                keys = np.full(b - a, None, object)
                bands, sketch = [None] * (b - a), [None] * (b - a)
                if len(full):
                    sample = samples(values, n[full])
                    ends = np.cumsum(n)
                    band, odd = band_keys(sample).tolist(), np.hstack([odd_sketch(sample), set_sketch(values, n[full])])
                    for k, row in enumerate(full):
                        own = slice(ends[row] - n[row], ends[row])
                        keys[row] = _set_key(values[own], others[own])
                        bands[row], sketch[row] = band[k], odd[k].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary()), *(x.slice(a, b - a) for x in batch.columns[2:])],
                    names=["doc_id", "n_shingles", "set_key", "bands", "sketch", *more],
                )

    return docs.select("doc_id", "text", *more).mapInArrow(run, f"doc_id {kind}, n_shingles bigint, set_key binary, bands array<bigint>, sketch binary{kinds}")


def _xor(a: str, b: str, first: int, count: int):
    """Differing bits of a part of two sketch columns, given as longs."""
    both = F.zip_with(F.slice(a, first, count), F.slice(b, first, count), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(both, F.lit(0), lambda s, x: s + x)


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose full sets reach the threshold."""
    limit = most_xor(percent)
    of = nodes.select("set_key", "n", "sketch", F.struct("first.doc_id", "first._text_key").alias("doc"))
    # a quick look at the sketches and sizes first
    one = of.select(F.col("set_key").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"), F.col("doc").alias("d_a"))
    two = of.select(F.col("set_key").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"), F.col("doc").alias("d_b"))
    near = (
        _merge(_merge(pairs, one, "a"), two, "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .where(_xor("s_a", "s_b", 1, SKETCH_BITS // 64) <= limit)
        .where(_xor("s_a", "s_b", SKETCH_BITS // 64 + 1, SET_BITS // 64) * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))
        .select("a", "b", "d_a", "d_b")
    )
    near = stored(near, "near-pairs")
    wanted = near.select(F.col("a").alias("set_key"), F.col("d_a").alias("d")).unionByName(near.select(F.col("b").alias("set_key"), F.col("d_b").alias("d"))).distinct()
    # a text is told by its id and digest; where several rows have both, one of them will do
    wanted = wanted.select("set_key", F.col("d.doc_id").alias("_id"), F.col("d._text_key").alias("_key")).hint("merge")
    rows = docs.select("doc_id", "text", "_text_key")
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))).groupBy("set_key").agg(F.first("text").alias("text"))
    # written, so that the join with it has nothing between it and its shuffle and a leader with many partners can be split
    fan = stored(near.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / FANOUT).cast("int").alias("_salts")), "near-fan")
    salt = F.pmod(F.xxhash64("a"), F.col("_salts")).cast("int").alias("salt")
    partners = _merge(_merge(near.select("a", "b"), fan, "b").select("b", salt, "a"), texts.select(F.col("set_key").alias("a"), "text"), "a").select("b", "salt", F.lit(1).alias("kind"), "a", "text")
    leaders = _merge(fan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))), texts.select(F.col("set_key").alias("b"), "text"), "b").select("b", "salt", F.lit(0).alias("kind"), F.col("b").alias("a"), "text")
    both = leaders.unionByName(partners).repartition("b", "salt").sortWithinPartitions("b", "salt", "kind", "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, own, own_others = None, np.zeros(0, U64), np.zeros(0, U64)
        for batch in batches:
            b_keys, kinds, a_keys = (batch.column(k).to_pylist() for k in (0, 2, 3))
            found: tuple[list, list] = ([], [])
            for (x, y, words, counts), (_, _, other, _) in zip(words_of(batch.column(4)), words_of(batch.column(4), 1), strict=True):
                values, n, others = shingles(words, counts, width, other)
                ends = np.cumsum(n)
                for row in range(x, y):
                    at = slice(ends[row - x] - n[row - x], ends[row - x])
                    mine, mine_others = values[at], others[at]
                    if kinds[row] == 0:
                        owner, own, own_others = b_keys[row], mine, mine_others
                        continue
                    if owner != b_keys[row]:
                        raise RuntimeError("a pair's text is missing: the documents changed between two readings")
                    _, p, q = np.intersect1d(own, mine, assume_unique=True, return_indices=True)
                    shared = int((own_others[p] == mine_others[q]).sum())
                    if 100 * shared >= percent * (len(own) + len(mine) - shared):
                        found[0].append(a_keys[row])
                        found[1].append(owner)
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.binary()), pa.array(found[1], pa.binary())], names=["a", "b"])

    links = stored(both.mapInArrow(run, "a binary, b binary"), "near-links")
    dropped(near, fan)
    return links


def _across(live: DataFrame, nodes: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a bucket and may be similar by their sketches."""
    limit = most_xor(percent)
    member = _merge(live.select("set_key", "bucket", "m").where("m > 2"), joined, "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))
    open_ = member.groupBy("bucket").agg(F.first("m").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi")).where(F.col("lo") != F.col("hi"))
    chunks = F.ceil(F.col("m") / CELL).cast("int")
    placed = _merge(member.drop("m"), open_.select("bucket", chunks.alias("g")), "bucket").withColumn("i", F.pmod(F.xxhash64("set_key"), F.col("g")).cast("int"))
    # every two chunks meet in one cell
    cells = placed.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    cells = cells.select("bucket", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"), "i", "set_key", "component")
    full = _merge(cells, nodes.select("set_key", "n", F.col("raw").alias("sketch")), "set_key").select("bucket", "x", "y", "i", "set_key", "component", "n", "sketch")
    dealt = full.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")

    def pairs(rows: list[tuple]) -> tuple[list, list]:
        _, x, y, i, key, comp, n, sketch = (list(c) for c in zip(*rows, strict=True))
        bits = np.frombuffer(b"".join(sketch), np.uint64).reshape(len(rows), -1)
        head = SKETCH_BITS // 64
        i, n, x, y = np.array(i), np.array(n), x[0], y[0]
        _, comp = np.unique(comp, return_inverse=True)
        a_keys, b_keys = [], []
        for k in range(len(rows) - 1):
            rest = slice(k + 1, None)
            ok = comp[rest] != comp[k]
            if x != y:
                ok &= i[rest] != i[k]
            ok &= 100 * np.minimum(n[rest], n[k]) >= percent * np.maximum(n[rest], n[k])
            at = np.flatnonzero(ok) + k + 1
            if len(at):
                differ = np.bitwise_count(bits[at] ^ bits[k])
                # 100 x shared >= percent x all, in terms of the sizes and of the difference
                near = differ[:, head:].sum(axis=1, dtype=np.int64) * (100 + percent) <= (n[at] + n[k]) * (100 - percent)
                at = at[near & (differ[:, :head].sum(axis=1) <= limit)]
            for p in at:
                a, b = sorted((key[k], key[p]))
                a_keys.append(b)
                b_keys.append(a)
        return a_keys, b_keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != now:
                    if len(rows) > 1:
                        a, b = pairs(rows)
                        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                    now, rows = row[:3], []
                rows.append(row)
        if len(rows) > 1:
            a, b = pairs(rows)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def _linked(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``signatures`` of all rows, one row for each set, and (set_key, first, component) of every set; ``first``: its first row's id and digest."""
    docs = docs.select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("_text_key"))
    signed = stored(signatures(docs, width, ("_text_key",)), "near-sets")
    first_row = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_text_key")).alias("first")
    longs = F.transform(F.sequence(F.lit(0), F.lit((SKETCH_BITS + SET_BITS) // 64 - 1)), lambda k: F.conv(F.substring(F.hex("sketch"), k * 16 + 1, F.lit(16)), 16, -10).cast("long"))
    grouped = signed.where(F.col("n_shingles") > 0).groupBy("set_key").agg(first_row, F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    nodes = stored(grouped.select("set_key", "first", "n", "bands", F.col("sketch").alias("raw"), longs.alias("sketch")), "near-nodes")
    banded = nodes.select("set_key", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    live = stored(_merge(banded, shared, "bucket"), "near-live")
    # the node that shares most buckets is nearest to the middle of its group
    weight = live.groupBy("set_key").agg(F.sum("m").alias("w"))
    leaders = _merge(live, weight, "set_key").groupBy("bucket").agg(F.max(F.struct("w", "set_key")).alias("top")).select("bucket", F.col("top.set_key").alias("b"))
    stars = _merge(live, leaders, "bucket").where(F.col("set_key") != F.col("b")).select(F.col("set_key").alias("a"), "b").distinct()
    links = _confirmed(stars, nodes, docs, width, percent)
    edges = lambda x: x.select(F.col("a").alias("u"), F.col("b").alias("v"))
    first = components(edges(links))
    joined = first.withColumnRenamed("u", "set_key")
    across = stored(_across(live, nodes, joined, percent), "near-across")
    more = _confirmed(across, nodes, docs, width, percent)
    dropped(live, across, links)
    if not more.isEmpty():
        joined = components(first.select("u", F.col("component").alias("v")).unionByName(edges(more))).withColumnRenamed("u", "set_key")
    dropped(more)
    return signed, nodes, _merge(nodes.select("set_key", "first"), joined, "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text)."""
    signed, _, owned = _linked(docs, width, percent)
    named = owned.groupBy("component").agg(F.min("first.doc_id").alias("component_id"))
    of_set = _merge(owned, named, "component").select("set_key", "component_id")
    rows = _merge(signed.select("doc_id", "n_shingles", "set_key"), of_set, "set_key", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component, whatever its ids, and the rows without shingles; of repeated rows of an id, one.

    A row is told by its id and its text's digest: an id may be null or stand on several texts.  Rows without id
    and shingles are not known to be the same, so all of them stay.
    """
    signed, nodes, owned = _linked(docs, width, percent)
    firsts = owned.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("_kept_id"), F.col("first._text_key").alias("_kept_key"))
    blank = signed.where("n_shingles = 0").select(F.col("doc_id").alias("_kept_id"), F.col("_text_key").alias("_kept_key"), F.col("doc_id").isNull().alias("_all")).distinct()
    repeated = signed.groupBy(F.col("doc_id").alias("_id"), F.col("_text_key").alias("_key")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    kept = firsts.withColumn("_all", F.lit(False)).unionByName(blank)
    kept = kept.join(repeated.hint("merge"), F.col("_kept_id").eqNullSafe(F.col("_id")) & F.col("_kept_key").eqNullSafe(F.col("_key")), "left")
    found = stored(kept.select("_kept_id", "_kept_key", (F.col("_rows").isNotNull() & ~F.col("_all")).alias("_several")), "near-kept")
    dropped(signed, nodes)
    keyed = docs.withColumn("_text_key", F.md5(F.col("text").cast("binary")))
    own = keyed.join(found, keyed["doc_id"].eqNullSafe(F.col("_kept_id")) & keyed["_text_key"].eqNullSafe(F.col("_kept_key")))
    single = own.where(~F.col("_several")).select(*[keyed[c] for c in docs.columns])
    if found.where("_several").isEmpty():
        return single
    several = own.where("_several").dropDuplicates(["_kept_id", "_kept_key"]).select(*[keyed[c] for c in docs.columns])
    return single.unionByName(several)
