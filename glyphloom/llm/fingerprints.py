"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Every triplet of neighbouring bytes of the UTF-8 text is hashed into one of 256 buckets.  The digest holds,
for each bucket, in which quartile of the document's own bucket counts its count lies (two bits), and the
length on a logarithmic scale (two bytes).  Two digests are compared by a bounded difference: bucket
steps (0 to 3 apart; 3 counts double) plus the length difference, as a share of what unrelated texts
can reach; likeness is one minus that.  Digests of equal texts are equal.

``fingerprint_edits`` walks the documents in descending id.  They are dealt by ranges of (id, text's hash, place), so
that neither an id nor a text on many rows makes a range large, and each range is one stream: a task holds a
few MB of texts.  A range's first and last row are written with it, and a second, small step joins each
range's last row with the first row of the next one.

Defined cases: a null text counts as empty; texts of fewer than three bytes have all-zero buckets and differ
by their length and their bytes (kept in the length part); a null doc_id sorts last; rows of one
doc_id are ordered by their texts' hashes, equal rows in any order; ids are of any type that has an order; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphloom.llm._arrays import row_slices, utf8
from glyphloom.llm._storage import input_bytes, small_batches, stored

BUCKETS = 256
#: Bytes of text in a range, and most ranges (Spark samples 100 keys of each for their bounds): beyond that ranges grow,
#: which a stream does not mind.
RANGE_BYTES = 16 << 20
MOST_RANGES = 20_000
_MIX = np.uint32(0x9E3779B1)


def digests(column: pa.Array) -> np.ndarray:
    """One row of BUCKETS / 4 + 2 bytes for each text."""
    data, offsets = utf8(column)
    out = np.zeros((len(offsets) - 1, BUCKETS // 4 + 2), np.uint8)
    for a, b in row_slices(offsets):
        part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        rows = b - a
        counts = np.zeros((rows, BUCKETS), np.int64)
        # a very long text is counted in parts that overlap by two bytes
        for x in range(0, max(1, len(part)), 1 << 20):
            piece = part[x : x + (1 << 20) + 2].astype(np.uint32)
            if len(piece) < 3:
                continue
            triple = piece[:-2] | piece[1:-1] << np.uint32(8) | piece[2:] << np.uint32(16)
            bucket = (triple * _MIX) >> np.uint32(24)
            row = np.searchsorted(own, np.arange(x, x + len(triple)), "right") - 1
            inside = np.arange(x, x + len(triple)) + 2 < own[row + 1]
            counts += np.bincount((row[inside] * BUCKETS + bucket[inside]), minlength=rows * BUCKETS).reshape(rows, BUCKETS)
        quartiles = np.sort(counts, axis=1)[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
        code = (counts[:, :, None] > quartiles[:, None, :]).sum(axis=2).astype(np.uint8)
        packed = code.reshape(rows, BUCKETS // 4, 4)
        out[a:b, 2:] = packed[:, :, 0] | packed[:, :, 1] << 2 | packed[:, :, 2] << 4 | packed[:, :, 3] << 6
        length = np.diff(own)
        scale = np.where(length > 2, np.minimum(65535, 768 + np.round(np.log2(np.maximum(length, 1)) * 1024)), 0).astype(np.int64)
        for k in np.flatnonzero(length <= 2):
            scale[k] = int.from_bytes(part[own[k] : own[k + 1]].tobytes(), "big") % 511 + 1 if length[k] else 0
        out[a:b, 0], out[a:b, 1] = scale >> 8, scale & 255
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for rows of two digest tables; equal digests give 1."""

    def codes(x: np.ndarray) -> np.ndarray:
        return np.stack([x[:, 2:] >> s & 3 for s in (0, 2, 4, 6)], axis=2).astype(np.int16).reshape(len(x), -1)

    step = np.abs(codes(a) - codes(b))
    length = np.abs((a[:, 0].astype(float) * 256 + a[:, 1]) - (b[:, 0].astype(float) * 256 + b[:, 1])) / 1024
    difference = np.where(step == 3, 6, step).sum(axis=1) + 8 * np.minimum(length, 16)
    return 1 - np.minimum(1.0, difference / (BUCKETS * 2.0))


def hexed(table: np.ndarray) -> list[str]:
    raw, width = table.tobytes().hex(), table.shape[1] * 2
    return [raw[k * width : (k + 1) * width] for k in range(len(table))]


def fingerprint(column: pa.Array) -> list[str]:
    return hexed(digests(column))


#: What is found of a document, besides its id.
_FOUND = {"n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}


def _edits(ids: list, texts: list[str], own: np.ndarray, kind: pa.DataType) -> dict[str, pa.Array]:
    """The results of all but the last of consecutive documents, whose digests are ``own``."""
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts[:-1], texts[1:], strict=True)]
    other = digests(pa.array(edited, pa.large_string()))
    sums = [hashlib.sha256(e.encode()).hexdigest() for e in edited]
    found = ([len(t) for t in texts[:-1]], sums, hexed(own[:-1]), hexed(other), likeness(own[:-1], other), likeness(own[:-1], own[1:]))
    return {"doc_id": pa.array(ids[:-1], kind)} | {c: pa.array(x, t) for (c, t), x in zip(_FOUND.items(), found, strict=True)}


_RESULT = "doc_id {}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: Which row of a range an edge is.
FIRST, LAST = 1, 2


def _range_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of a range's rows but its last, and its first and last row as edges."""
    part, carried, kind = TaskContext.get().partitionId(), None, None

    def rows(found: dict[str, pa.Array], edge: int, texts: list[str] | None) -> pa.RecordBatch:
        n = len(found["doc_id"])
        more = [pa.array([x] * n, pa.int32()) for x in (part, edge)]
        return pa.RecordBatch.from_arrays([*more, pa.array(texts or [None] * n, pa.string()), *found.values()], names=["part", "edge", "text", *found])

    def edge(which: int, doc: object, text: str) -> pa.RecordBatch:
        return rows({"doc_id": pa.array([doc], kind)} | {c: pa.nulls(1, t) for c, t in _FOUND.items()}, which, [text])

    for batch in batches:
        if not batch.num_rows:
            continue
        kind = batch.schema.field(0).type
        ids, texts, own = batch.column(0).to_pylist(), batch.column(1).to_pylist(), digests(batch.column(1))
        if carried is None:
            yield edge(FIRST, ids[0], texts[0])
        else:
            ids, texts, own = [carried[0], *ids], [carried[1], *texts], np.vstack([carried[2], own])
        if len(ids) > 1:
            yield rows(_edits(ids, texts, own, kind), 0, None)
        carried = ids[-1], texts[-1], own[-1:]
    if carried is not None:
        yield edge(LAST, *carried[:2])


def _edge_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of (doc_id, text, next text)."""
    for batch in batches:
        for doc, text, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = _edits([doc, None], [text, after], digests(pa.array([text, after])), batch.schema.field(0).type)
            yield pa.RecordBatch.from_arrays(list(found.values()), names=list(found))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness; see the contract of op9.

    The edited text has its last floor(n / 2) code points replaced by as many from the start of the next
    document in descending doc_id (after the last: the first).
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = docs.agg(input_bytes(F.col("text"))).first()[0]
    ranges = max(1, min(MOST_RANGES, -(-size // RANGE_BYTES)))
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_hash"), F.monotonically_increasing_id().alias("_place"))
    order = [F.desc_nulls_last("doc_id"), F.asc("_hash"), F.asc("_place")]
    dealt = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "text")
    found = stored(dealt.mapInArrow(_range_edits, f"part int, edge int, text string, {_RESULT.format(kind)}"), "fingerprints")
    firsts = found.where(F.col("edge") == FIRST).select(F.col("part").alias("_next"), F.col("text").alias("_after"))
    # one row for each range, MOST_RANGES at most: the next range that has rows, after the last the first
    everything = W.partitionBy(F.lit(0))
    following = F.coalesce(F.lead("_next").over(everything.orderBy("_next")), F.min("_next").over(everything))
    nexts = firsts.select(F.col("_next").alias("part"), following.alias("_next"))
    lasts = found.where(F.col("edge") == LAST).select("part", "doc_id", "text")
    edges = lasts.join(nexts, "part").join(firsts, "_next").select("doc_id", "text", "_after").mapInArrow(_edge_edits, _RESULT.format(kind))
    return found.where("edge = 0").drop("part", "edge", "text").unionByName(edges)
