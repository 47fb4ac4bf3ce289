"""Token counts of whole texts with a public tokenizer, as lengths only.

Rows arrive in Arrow batches and are taken in groups of about equal bytes.  Texts are cut into pieces at
boundaries that byte-level BPE with the usual pre-token pattern can never join: before a single space that
a visible character follows, around other white space, and between an ASCII letter and ASCII punctuation
other than the apostrophe.  A place is used only if the bytes around it prove it safe.  The
distinct pieces of a group are looked up by hash in a bounded memo of the worker; those it lacks are encoded in
batches of balanced bytes.  Every piece of a text is then compared byte for byte with what the memo answered
for, and encoded by itself where they differ, so no collision can change a count.  Only lengths are kept (ids where
a caller asks).  Texts that hold a special string are encoded whole; the other texts of their group in pieces.

``counter`` chooses the library by the file: tokenizers for ``.json``, sentencepiece for ``.model``
(whole texts there: its normaliser knows no safe cut).  Begin, end and other added tokens are left out;
special strings inside a text count as the library's default has them.  No truncation, no padding.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); null ids and repeated rows give one
result row each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.llm._arrays import U64, row_slices, span_hashes, utf8
from glyphloom.llm._storage import small_batches

#: Bytes of text taken together, and bytes of distinct pieces that one call of the library gets.
GROUP_BYTES = 1 << 21
BATCH_BYTES = 1 << 18
#: Pieces in a worker's memo; beyond that it starts again.
MEMO_PIECES = 2_000_000

_table = lambda *ranges: np.isin(np.arange(256), [b for r in ranges for b in r])
_WHITE = _table(range(9, 14), [32])
_BREAK = _table(range(9, 14))
#: Bytes that neither are white space nor begin, or end, a character that is.
_OPENS = _table(range(33, 127), [b for b in range(0xC3, 0xF5) if b not in (0xE1, 0xE2, 0xE3)])
_CLOSES = _table(range(33, 127), [b for b in range(0x80, 0xC0) if b not in (*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF)])
_LETTER = _table(range(65, 91), range(97, 123))
_POINT = _table(range(33, 39), range(40, 48), range(58, 65), range(91, 97), range(123, 127))


def piece_starts(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where the pieces of a group of texts start; ``rows``: where its non-empty texts start."""
    n = len(data)
    cut = np.zeros(n, bool)
    if n > 1:
        last, here = data[:-1], data[1:]
        opens = _OPENS[here]
        cut[1:] = (_CLOSES[last] & _BREAK[here]) | (_LETTER[last] & _POINT[here])
        cut[2:] |= _CLOSES[data[:-2]] & _BREAK[data[1:-1]] & opens[1:]  # a run of one: a longer one ends a character early
        cut[:-1] |= (data[:-1] == 32) & opens
        # a space that stands for itself is a piece of the text before it, so nothing starts behind it
    cut[rows[rows < n]] = True
    return np.flatnonzero(cut)


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.array, self.used = np.zeros(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        while len(self.array) < self.used + len(more):
            self.array = np.concatenate([self.array, np.zeros_like(self.array)])
        self.array[self.used : self.used + len(more)] = more
        self.used += len(more)


class Memo:
    """Piece lengths, or ids, by hash and bytes, for one tokenizer file; shared by the tasks of a worker."""

    def __init__(self, path: str, ids: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.ids = Tokenizer.from_file(path), ids
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.key, self.slot = np.zeros(0, U64), np.zeros(0, np.int32)
        # by slot: how many ids and where, how many bytes and where
        self.length, self.start, self.size, self.at = (Growing(np.int64) for _ in range(4))
        self.flat, self.bytes = Growing(np.uint32), Growing(np.uint8)

    def encode(self, texts: list[str]) -> list:
        out, batch, size = [], [], 0
        for k, text in enumerate(texts):
            batch.append(text)
            size += len(text)
            if size >= BATCH_BYTES or k == len(texts) - 1:
                out += [np.array(e.ids, np.uint32) if self.ids else len(e.ids) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
                batch, size = [], 0
        return out

    def learn(self, pieces: list[bytes]) -> np.ndarray:
        """New slots for ``pieces``, encoded."""
        found = self.encode([p.decode() for p in pieces])
        length = np.array([len(x) for x in found] if self.ids else found, np.int64)
        size = np.array([len(p) for p in pieces], np.int64)
        first = self.length.used
        self.start.add(np.cumsum(length) - length + self.flat.used)
        self.at.add(np.cumsum(size) - size + self.bytes.used)
        self.length.add(length)
        self.size.add(size)
        self.bytes.add(np.frombuffer(b"".join(pieces), np.uint8))
        if self.ids and found:
            self.flat.add(np.concatenate(found))
        return np.arange(first, first + len(pieces), dtype=np.int32)

    def find(self, keys: np.ndarray, piece: Callable[[np.ndarray], list[bytes]]) -> np.ndarray:
        """Slots of sorted distinct ``keys``; ``piece(which)`` are the bytes of some of them."""
        if self.length.used > MEMO_PIECES:
            self.clear()
        at = np.searchsorted(self.key, keys)
        known = self.key[np.minimum(at, len(self.key) - 1)] == keys if len(self.key) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~known)
        if len(new):
            slots = self.learn(piece(new))
            self.key, self.slot = np.insert(self.key, at[new], keys[new]), np.insert(self.slot, at[new], slots)
            at = np.searchsorted(self.key, keys)
        return self.slot[at]

    def group(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Tokens by row of a group of texts, and all their ids in order."""
        raw = data.tobytes()
        if any(s in raw for s in self.special):
            texts = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            whole = [k for k, t in enumerate(texts) if any(s in t for s in self.special)]
            found = dict(zip(whole, self.encode([texts[k].decode() for k in whole]), strict=True))
            # the runs of texts between them go on in pieces
            counts, ids = np.zeros(len(texts), np.int64), []
            for a, b in zip([0, *(k + 1 for k in whole)], [*whole, len(texts)], strict=True):
                if a < b:
                    counts[a:b], own = self._pieces(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    ids.append(own)
                if b < len(texts):
                    counts[b] = len(found[b]) if self.ids else found[b]
                    ids.append(found[b])
            return counts, np.concatenate([*ids, np.zeros(0, np.uint32)]) if self.ids else None
        return self._pieces(data, offsets)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        rows = offsets[:-1][np.diff(offsets) > 0]
        if not len(rows):
            return np.zeros(len(offsets) - 1, np.int64), np.zeros(0, np.uint32)
        raw = data.tobytes()
        starts = piece_starts(data, rows)
        size = np.diff(starts, append=len(data))
        cut = lambda which: [raw[a : a + n] for a, n in zip(starts[which].tolist(), size[which].tolist(), strict=True)]
        keys, first, inverse = np.unique(span_hashes(data, starts), return_index=True, return_inverse=True)
        slot = self.find(keys, lambda which: cut(first[which]))[inverse]
        # are the bytes those that the slot was learned from?
        held = self.bytes.array[: self.bytes.used]
        place = np.arange(len(data)) + np.repeat(self.at.array[slot] - starts, size)
        differ = held[np.minimum(place, len(held) - 1)] != data
        other = self.size.array[slot] != size
        other[np.searchsorted(starts, np.flatnonzero(differ), "right") - 1] = True
        if other.any():
            slot = slot.copy()
            slot[other] = self.learn(cut(np.flatnonzero(other)))
        length = self.length.array[slot]
        upto = np.concatenate([[0], np.cumsum(length)])
        counts = np.diff(upto[np.searchsorted(starts, offsets)])
        if not self.ids:
            return counts, None
        return counts, self.flat.array[np.repeat(self.start.array[slot] - upto[:-1], length) + np.arange(upto[-1])]


_memos: dict[tuple[str, bool], Memo] = {}


def memo(path: str, ids: bool) -> Memo:
    if (path, ids) not in _memos:
        _memos[path, ids] = Memo(path, ids)
    return _memos[path, ids]


def encoded(path: str, column: pa.Array, ids: bool) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """For groups of the rows of a string column, in order: tokens by row, and the ids of all."""
    m = memo(path, ids)
    data, offsets = utf8(column)
    for a, b in row_slices(offsets, GROUP_BYTES):
        yield m.group(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def counter(path: str) -> Callable[[pa.Array], np.ndarray]:
    """Token counts of a string column, by the library that the file is for."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda column: np.array([len(x) for x in model.encode(pc.fill_null(column, "").to_pylist(), num_threads=1)], np.int64)
    return lambda column: np.concatenate([np.zeros(0, np.int64), *(n for n, _ in encoded(path, column, False))])


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every row."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(tokenizer)
        for batch in batches:
            size = pc.cast(pc.binary_length(pc.fill_null(batch.column(1), "")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(tokens(batch.column(1)), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_column].dataType.simpleString()
    slim = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    counted = slim.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
