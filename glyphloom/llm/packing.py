"""Packing examples into fixed-length sequences, as vector bin packing with a dot-product heuristic.

A sequence has three limits at once: tokens, segments (pieces of examples) and loss-bearing tokens.  Of
the pieces that fit, the one whose size vector has the largest dot product with what the sequence has left
(each dimension as a share of its limit) is placed next.  When no whole piece fits, one is cut so that
it does, and its rest stays in the pool; so a sequence is closed full, or at a power of two where its
segments or loss tokens run out.  Nothing is dropped and each token lies in exactly one piece.

``pack_pieces`` is the packer for any stream of examples; its pool is bounded, so memory does not grow
with the input.  ``pack_documents`` tokenizes and packs each input partition in one pass without a
shuffle; at the end of a partition its last tokens go into sequences that are powers of two long.
``pack_conversations`` does so with chat-formatted conversations, where the limit of loss tokens binds: of their tokens
only those under the loss mask, and the closing id, bear loss.
Sequences are numbered by partition (upper bits) and order, so a retried task gives the same rows.

Defined cases: a null text counts as empty and has the closing id alone; null ids and repeated rows are
packed row by row; a text of any length is cut into full sequences; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.llm._storage import small_batches
from glyphloom.llm.chat_format import masked_conversations
from glyphloom.llm.token_counts import encoded, memo

#: Id that ends every document.
END_ID = 1
_FACTS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048
    #: Examples that the packer chooses from; bounds its memory.
    pool: int = 256


#: For conversations: at most 16 to a sequence, and half of its tokens under loss.
CHAT_LIMITS = Limits(segments=16, loss_tokens=1024)


@dataclass
class Piece:
    """Tokens ``start`` to ``start + len(ids)`` of an example; ``loss`` marks those that bear loss."""

    key: object
    start: int
    ids: np.ndarray
    loss: np.ndarray
    total: int

    def split(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.key, self.start, self.ids[:n], self.loss[:n], self.total),
            Piece(self.key, self.start + n, self.ids[n:], self.loss[n:], self.total),
        )


def pack_pieces(pieces: Iterable[Piece], limits: Limits = Limits()) -> Iterator[list[Piece]]:
    """Sequences, each a list of pieces in order."""
    pool: list[Piece] = []
    source = iter(pieces)
    cap = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
    sizes = np.zeros((0, 3))
    more = True

    def put(p: Piece) -> None:
        nonlocal sizes
        pool.append(p)
        sizes = np.vstack([sizes, [len(p.ids), 1, p.loss.sum()]]) if len(sizes) < len(pool) else sizes
        sizes[len(pool) - 1] = (len(p.ids), 1, p.loss.sum())

    def take(k: int) -> Piece:
        out = pool[k]
        pool[k] = pool[-1]
        sizes[k] = sizes[len(pool) - 1]
        pool.pop()
        return out

    while True:
        while more and len(pool) < limits.pool:
            p = next(source, None)
            if p is None:
                more = False
                break
            # what fills a sequence alone needs no choice
            while len(p.ids) >= limits.tokens and p.loss[: limits.tokens].sum() <= limits.loss_tokens:
                head, p = p.split(limits.tokens)
                yield [head]
            if len(p.ids):
                put(p)
        if not pool:
            return
        left, placed = cap.copy(), []
        while pool and left[0] >= 1 and left[1] >= 1:
            now = sizes[: len(pool)]
            fits = (now <= left).all(axis=1)
            if fits.any():
                score = np.where(fits, (now / cap) @ (left / cap), -1.0)
                p = take(int(score.argmax()))
            else:
                # nothing fits whole: cut the largest so that its head fits every limit
                k = int(now[:, 0].argmax())
                room = min(int(left[0]), len(pool[k].ids))
                upto = np.cumsum(pool[k].loss)
                room = min(room, int(np.searchsorted(upto, left[2], "right")))
                if room < 1:
                    break
                p = take(k)
                if room < len(p.ids):
                    p, rest = p.split(room)
                    put(rest)
            placed.append(p)
            left -= (len(p.ids), 1, p.loss.sum())
        total = sum(len(p.ids) for p in placed)
        if total < limits.tokens:
            # close at a power of two; the tail goes back
            excess = total - (1 << (total.bit_length() - 1))
            while excess:
                p = placed.pop()
                if len(p.ids) > excess:
                    p, rest = p.split(len(p.ids) - excess)
                    placed.append(p)
                    p = rest
                excess -= len(p.ids)
                put(p)
        yield placed


def _packed(frame: DataFrame, examples: Callable[[pa.RecordBatch], Iterator[tuple[object, np.ndarray, np.ndarray]]], limits: Limits) -> DataFrame:
    """The pieces of all rows of ``frame``, whose first column names them; ``examples`` gives name, ids and loss mask of a batch's rows."""
    small_batches(frame.sparkSession)
    name, kind = frame.columns[0], frame.schema[0].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                kinds[:] = [batch.schema.field(0).type]
                for key, ids, loss in examples(batch):
                    yield Piece(key, 0, ids, loss, len(ids))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kinds[0])] + [pa.array(c, pa.int64()) for c in columns[1:]], names=[name, *_FACTS])

        first = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        for number, sequence in enumerate(pack_pieces(pieces(), limits)):
            offset = 0
            for p in sequence:
                crc = zlib.crc32(np.ascontiguousarray(p.ids, "<u4").tobytes())
                rows.append((p.key, p.start, len(p.ids), crc, p.total, first + number, offset, int(p.loss.sum())))
                offset += len(p.ids)
            if len(rows) >= 8192:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    return frame.mapInArrow(pack, ", ".join([f"`{name}` {kind}", *(f"{c} bigint" for c in _FACTS)]))


def pack_documents(docs: DataFrame, tokenizer: str, limits: Limits = Limits(), end_id: int = END_ID) -> DataFrame:
    """The pieces of all rows of ``docs`` (doc_id, text): doc_id and ``_FACTS``.

    The first token of a document has no context and bears no loss; all others do.
    """

    def examples(batch: pa.RecordBatch) -> Iterator[tuple[object, np.ndarray, np.ndarray]]:
        owners = iter(batch.column(0).to_pylist())
        for counts, ids in encoded(tokenizer, batch.column(1), True):
            for n, end in zip(counts, np.cumsum(counts), strict=True):
                own = np.append(ids[end - n : end], np.uint32(end_id))
                loss = np.ones(len(own), bool)
                loss[0] = False
                yield next(owners), own, loss

    return _packed(docs.select("doc_id", "text"), examples, limits)


def pack_conversations(rows: DataFrame, tokenizer: str, limits: Limits = CHAT_LIMITS, end_id: int = END_ID) -> DataFrame:
    """The pieces of all conversations of ``rows`` (conv_id, turn, role, text), as they are formatted: conv_id and ``_FACTS``.

    A token bears loss if it begins under the loss mask; so does the id that closes a conversation.
    """

    def examples(batch: pa.RecordBatch) -> Iterator[tuple[object, np.ndarray, np.ndarray]]:
        encode = memo(tokenizer, True).tokenizer.encode
        for key, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = encode(text, add_special_tokens=False)
            edges = np.array([x for s in spans for x in (s["begin"], s["end"])], np.int64)
            begins = np.array([o[0] for o in found.offsets], np.int64)
            # between an odd edge and the next: under the mask
            loss = np.append(np.searchsorted(edges, begins, "right") % 2 == 1, True)
            yield key, np.array([*found.ids, end_id], np.uint32), loss

    return _packed(masked_conversations(rows).select("conv_id", "formatted", "loss_mask"), examples, limits)
