"""Exact top-k search by distributed histogram selection.

Vectors are quantised to integers and packed into blocks once, in as few bytes a component as they need.  Queries
and candidates meet in tiles: a block of queries with a block of candidates, every pair scored by an integer-exact
matrix product, no pair of which leaves its task.  In each round the tiles count their scores by query in
the bins of the query's current score range (only down to where a tile alone has k, for the k-th of all can't lie
lower), the counts are summed, and the bin that holds the k-th best becomes the next range, until bins
are one score wide.  A last pass keeps the scores above the k-th value and, at the value itself, the k smallest
ids of each tile; ranks follow from score, then id.

Defined cases: rows with a null id, a null vector, or null or non-finite components take no part; vectors are compared
with those of their own length; a component beyond a long is held at its end, and so is an inner product beyond
2**62 - 1; identical rows count once; of several vectors under one id each is a candidate
and the smallest is the query; a query's own id is no candidate; with fewer than k candidates all are
returned; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.llm._storage import dropped, small_batches, stored

#: Rows of a block of queries and of a block of candidates.
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
BINS = 256
#: Doubles hold every integer below this.
_EXACT = float(1 << 53)
#: Scores are held within this, so that differences of scores fit a long.
MOST_SCORE = (1 << 62) - 1


def quantised(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(vec_id, q array<long>) of the rows that take part."""
    v = F.col(vector_column)
    good = v.isNotNull() & F.col(id_column).isNotNull() & F.forall(F.coalesce(v, F.array()), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    q = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return vectors.where(good).select(F.col(id_column).cast("long").alias("vec_id"), q.alias("q")).distinct()


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products, held within MOST_SCORE: in doubles or longs where every partial sum fits, else in whole numbers of any size."""
    dim = max(1, a.shape[1])
    tops = [np.abs(x.astype(np.float64)).max(axis=1, initial=0) for x in (a, b)]
    bound = tops[0].max(initial=0) * tops[1].max(initial=0) * dim
    if bound < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < MOST_SCORE / 2:
        return a.astype(np.int64) @ b.astype(np.int64).T
    # only rows with large components go the slow way
    large = [t >= np.sqrt(MOST_SCORE / 4 / dim) for t in tops]
    out = np.empty((len(a), len(b)), np.int64)
    out[np.ix_(~large[0], ~large[1])] = a[~large[0]].astype(np.int64) @ b[~large[1]].astype(np.int64).T
    whole = lambda x, y: np.clip(x.astype(object) @ y.astype(object).T, -MOST_SCORE, MOST_SCORE).astype(np.int64)
    if large[0].any():
        out[large[0]] = whole(a[large[0]], b)
    if large[1].any():
        out[np.ix_(~large[0], large[1])] = whole(a[~large[0]], b[large[1]])
    return out


def _packed(rows: np.ndarray) -> bytes:
    """Integers in as few bytes each as the largest needs; the first byte tells how many."""
    low, high = int(rows.min(initial=0)), int(rows.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return bytes([width]) + rows.astype(f"<i{width}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<i{raw[0]}", offset=1)


_BLOCK = pa.schema([("d", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("states", pa.binary())])


def _blocks(rows: DataFrame, count: int, salt: int) -> DataFrame:
    """(vec_id, q, state) packed by vector length and block."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        flat = table.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        states = table.column("state").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        values = [[key[0].as_py()], [key[1].as_py()], [_packed(table.column("vec_id").to_numpy())], [_packed(flat)], [_packed(states)]]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(values, _BLOCK, strict=True)], schema=_BLOCK)

    block = F.pmod(F.xxhash64("vec_id", "q", F.lit(salt)), F.lit(count)).cast("int")
    return rows.select(F.size("q").alias("d"), block.alias("block"), "vec_id", "q", "state").groupBy("d", "block").applyInArrow(pack, "d int, block int, ids binary, vectors binary, states binary")


def _tiles(work, columns: list[str]):
    """Score each tile, a row with a block of queries and one of candidates, and give what ``work`` makes of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asks, offers = (_unpacked(row[c]).astype(np.int64) for c in ("q_ids", "c_ids"))
                a, b = (_unpacked(row[c]).reshape(len(ids), row["d"]) for c, ids in (("q_vectors", asks), ("c_vectors", offers)))
                states = _unpacked(row["states"]).astype(np.int64).reshape(len(asks), 2)
                out = work(asks.tolist(), states.tolist(), _product(a, b), offers)
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=columns)

    return run


def top_k(vectors: DataFrame, queries_where, k: int = 5, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every query.

    ``queries_where``: the condition on ``vec_id`` that makes a row a query.
    """
    small_batches(vectors.sparkSession)
    base = stored(quantised(vectors, id_column, vector_column, scale), "topk-vectors")
    queries = base.where(queries_where(F.col("vec_id"))).groupBy("vec_id").agg(F.min("q").alias("q"))
    largest = F.aggregate("q", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double"))))
    facts = base.agg(F.count(F.lit(1)).alias("n"), F.max(largest).alias("top"), F.max(F.size("q")).alias("dim")).first()
    asked = queries.count()
    c_blocks, q_blocks = max(1, -(-facts["n"] // CANDIDATE_BLOCK)), max(1, -(-asked // QUERY_BLOCK))
    no_state = F.expr("cast(array() as array<bigint>)").alias("state")
    candidates = stored(_blocks(base.select("vec_id", "q", no_state), c_blocks, 7), "topk-candidates")

    def tiled(states: DataFrame, work, columns: list[str]) -> DataFrame:
        """A tile is (vector length, query block, candidate block); each side is copied to the tiles it is in."""
        asking = _blocks(states, q_blocks, 0).select("d", F.col("block").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("b"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), "states")
        offered = candidates.select("d", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("a"), F.col("block").alias("b"), F.col("ids").alias("c_ids"), F.col("vectors").alias("c_vectors"))
        met = asking.join(offered.hint("merge"), ["d", "a", "b"])
        return met.mapInArrow(_tiles(work, columns), ", ".join(f"{c} bigint" for c in columns))

    # scores lie in [-bound, bound]; a state is (low end of the range, still needed)
    bound = min(MOST_SCORE, int((facts["top"] or 0.0) ** 2 * (facts["dim"] or 0)) + 1)
    width = 1
    while width * BINS < 2 * bound + 1:
        width *= BINS
    states = stored(queries.withColumn("state", F.array(F.lit(-bound).cast("long"), F.lit(k).cast("long"))), "topk-state")

    def histogram(width: int):
        def work(ids, states, scores, c_ids):
            out: list[list[int]] = [[], [], []]
            for query, (low, need), row in zip(ids, states, scores, strict=True):
                own = row[c_ids != query]
                bins = (own - low) // width
                bins = bins[(bins >= 0) & (bins < BINS)]
                if len(bins) > need:
                    bins = np.partition(bins, len(bins) - need)[len(bins) - need :]
                found, counts = np.unique(bins, return_counts=True)
                out[0] += [query] * len(found)
                out[1] += found.tolist()
                out[2] += counts.tolist()
            return out

        return work

    while True:
        counts = tiled(states, histogram(width), ["query_id", "bin", "n"]).groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        # at most k bins of each query and tile come in, of which those from the top to the k-th matter
        found = counts.groupBy("query_id").agg(F.reverse(F.array_sort(F.collect_list(F.struct("bin", "n")))).alias("bins"))
        walk = F.aggregate(
            "bins",
            F.struct(F.lit(0).cast("long").alias("above"), F.lit(-1).cast("long").alias("bin"), F.lit(False).alias("done")),
            lambda acc, b: F.when(acc["done"], acc).otherwise(F.struct(F.when(acc["above"] + b["n"] >= F.col("_need"), acc["above"]).otherwise(acc["above"] + b["n"]).alias("above"), b["bin"].alias("bin"), (acc["above"] + b["n"] >= F.col("_need")).alias("done"))),
        )
        joined = states.withColumn("_need", F.col("state")[1]).join(found, F.col("vec_id") == F.col("query_id"))
        walked = joined.withColumn("_w", walk)
        # with fewer than k in all, the lowest bin holds the last; what it holds is all that is needed there
        inside = F.when(F.col("_w.done"), F.col("_need") - F.col("_w.above")).otherwise(F.greatest(F.lit(1).cast("long"), F.element_at("bins", -1)["n"]))
        new = stored(walked.select("vec_id", "q", F.array(F.col("state")[0] + F.col("_w.bin") * width, inside.cast("long")).alias("state")), "topk-state")
        dropped(states)
        states = new
        if width == 1:
            break
        width //= BINS

    def last(ids, states, scores, c_ids):
        out: list[list[int]] = [[], [], []]
        for query, (value, _), row in zip(ids, states, scores, strict=True):
            keep = np.flatnonzero((row >= value) & (c_ids != query))
            order = np.lexsort((c_ids[keep], -row[keep]))[:k]
            keep = keep[order]
            out[0] += [query] * len(keep)
            out[1] += c_ids[keep].tolist()
            out[2] += row[keep].tolist()
        return out

    kept = tiled(states, last, ["query_id", "vec_id", "score"])
    best = kept.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("_best"))
    return best.select("query_id", F.posexplode("_best").alias("_p", "_b")).select(
        "query_id", (F.col("_p") + 1).cast("int").alias("rank"), F.col("_b.vec_id").alias("vec_id"), (-F.col("_b.s")).alias("score")
    )
