"""Language identification with language-bitmask n-gram filters.

Training counts byte 4-grams of the normalised labelled texts by language over the whole table and keeps, for
each language, those whose share of its n-grams is at least ``MIN_SHARE`` and at least ``MIN_RATIO``
of the largest share that any language gives them.  Shares add up to one, so a language keeps at most
``1 / MIN_SHARE`` n-grams whatever the input's size: the model is bounded.  All go into one bit-sliced Bloom
filter: every slot holds one bit for each language, and the AND of an n-gram's slots gives all the
languages that contain it at once.  A text's n-grams are counted by language; each language's count
is corrected for the rate at which its own filter answers for n-grams it lacks, and the largest
corrected share decides (ties: first in code-point order).  The score is that share times its part of the two
largest together: near 1 for a text all of whose n-grams are known in one language alone, small for a text in none and
for an even mixture.  A text without any known n-gram gets the language with most training n-grams, at score 0.

Texts are lower-cased and everything but letters is one blank.  Neither lang nor source nor doc_id is used for a
prediction.  Defined cases: a null text, or one without a letter, is ``und`` with score 0; without
any labelled text everything is ``und``; null ids and repeated rows are predicted row by row; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphloom.llm._arrays import U64, mix
from glyphloom.llm._storage import small_batches, stored

MIN_SHARE = 1 / 20_000
MIN_RATIO = 0.25
SLOTS_PER_GRAM = 16
HASHES = 3
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_GROUP_CHARS = 1 << 20


def normalised(text: str) -> bytes:
    return f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} ".encode()


def grams(raw: bytes) -> np.ndarray:
    """The 4-byte windows of a normalised text, as numbers."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) < 4:
        b = np.concatenate([b, np.full(4 - len(b), 32, np.uint32)])
    return b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)


def _slots(gram: np.ndarray, size: int) -> list[np.ndarray]:
    h = mix(gram.astype(U64) + U64(0x1234567))
    return [(mix(h + U64(k * 0x9E3779B9)) % U64(size)).astype(np.int64) for k in range(HASHES)]


@dataclass
class Model:
    languages: list[str]
    #: words x slots: bit l % 64 of word l // 64 stands for language l
    filter: np.ndarray
    #: how often each language's filter says yes to an n-gram it lacks
    false_rate: np.ndarray
    #: each language's part of all training n-grams: what decides where a text gives no evidence
    prior: np.ndarray

    def hits(self, gram: np.ndarray) -> np.ndarray:
        """Languages x n-grams: does the filter hold it?"""
        at = _slots(gram, self.filter.shape[1])
        out = []
        for first, word in zip(range(0, len(self.languages), 64), self.filter, strict=True):
            both = word[at[0]]
            for k in range(1, HASHES):
                both = both & word[at[k]]
            out += [both >> word.dtype.type(b) & word.dtype.type(1) != 0 for b in range(min(64, len(self.languages) - first))]
        return np.array(out)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score by text."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known, parts = [], []
        for k, text in enumerate(texts):
            if text is not None and self.languages and has_letter(text):
                known.append(k)
                parts.append(grams(normalised(text)))
        if not known:
            return names, scores
        sizes = np.array([len(p) for p in parts])
        begins = np.cumsum(sizes) - sizes
        counts = np.add.reduceat(self.hits(np.concatenate(parts)).astype(np.int64), begins, axis=1)
        share = np.clip((counts / sizes - self.false_rate[:, None]) / (1 - self.false_rate[:, None]), 0, 1)
        best = share.argmax(axis=0)
        top = share[best, np.arange(len(known))]
        share[best, np.arange(len(known))] = -1
        second = np.maximum(0, share.max(axis=0)) if len(share) > 1 else np.zeros(len(known))
        score = np.where(top > 0, top * top / np.maximum(top + second, 1e-12), 0.0)
        best = np.where(top > 0, best, self.prior.argmax())
        for k, b, s in zip(known, best, score, strict=True):
            names[k], scores[k] = self.languages[b], float(s)
        return names, scores


def has_letter(text: str) -> bool:
    return next(filter(str.isalpha, text), None) is not None


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text); each task adds up its own rows first."""
    small_batches(labelled.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}

        def fold(lang: str) -> None:
            value, n = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
            size[lang] = 0
            if lang in totals:
                v = np.concatenate([totals[lang][0], value])
                value, place = np.unique(v, return_inverse=True)
                n = np.bincount(place, weights=np.concatenate([totals[lang][1], n])).astype(np.int64)
            totals[lang] = (value, n)

        def rows(lang: str) -> pa.RecordBatch:
            value, n = totals.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(value)), pa.array(value.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text is None or not has_letter(text):
                    continue
                g = grams(normalised(text))
                waiting.setdefault(lang, []).append(g)
                size[lang] = size.get(lang, 0) + len(g)
                if size[lang] > 4 * _GROUP_CHARS:
                    fold(lang)
                    if sum(len(v) for v, _ in totals.values()) > 1 << 21:
                        yield from [rows(x) for x in list(totals)]
        for lang in list(waiting):
            fold(lang)
        yield from [rows(x) for x in list(totals)]

    partial = labelled.select("lang", "text").mapInArrow(count, "lang string, gram bigint, n bigint")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame) -> Model:
    """``labelled``: rows (lang, text); null langs and texts are left out."""
    counts = gram_counts(labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    # one row of totals for each language, then n-grams by share; what is collected is bounded by both cuts
    counts = stored(counts, "langid")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], np.zeros((1, 1), np.uint8), np.zeros(0), np.zeros(0))
    share = F.col("n") / F.create_map(*[x for lang, n in totals.items() for x in (F.lit(lang), F.lit(float(n)))])[F.col("lang")]
    shared = counts.withColumn("share", share).where(F.col("share") >= MIN_SHARE * MIN_RATIO)
    tops = shared.groupBy("gram").agg(F.max("share").alias("top"), F.collect_list(F.struct("lang", "share")).alias("all"))
    kept = tops.select("gram", F.transform(F.filter("all", lambda x: (x["share"] >= MIN_SHARE) & (x["share"] >= F.col("top") * MIN_RATIO)), lambda x: x["lang"]).alias("langs")).where(F.size("langs") > 0)
    table = kept.toArrow()
    gram = table.column("gram").to_numpy().astype(np.uint32)
    place = {lang: k for k, lang in enumerate(languages)}
    words = -(-len(languages) // 64)
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    size = max(1024, SLOTS_PER_GRAM * len(gram))
    bits = np.zeros((words, size), kind)
    lists = table.column("langs").to_pylist()
    for lang, k in place.items():
        own = gram[[lang in x for x in lists]]
        for at in _slots(own, size):
            bits[k // 64, at] |= kind(1 << k % 64)
    sizes = np.array([totals[lang] for lang in languages], float)
    model = Model(languages, bits, np.zeros(len(languages)), sizes / sizes.sum())
    # false positives: n-grams that no text gave (their top byte can't occur in UTF-8)
    probe = np.arange(1 << 16, dtype=np.uint32) | np.uint32(0xFF000000)
    model.false_rate = model.hits(probe).mean(axis=1)
    return model


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def predict(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id",), prefix: str = "") -> DataFrame:
    """``columns`` of every row with lang_pred and score, named with ``prefix``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in columns)
    told = (f"{prefix}lang_pred", f"{prefix}score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            names: list[str] = []
            scores: list[float] = []
            a = 0
            while a < len(texts):
                b, chars = a, 0
                while b < len(texts) and (b == a or chars + len(texts[b] or "") <= _GROUP_CHARS):
                    chars += len(texts[b] or "")
                    b += 1
                found = m.predict(texts[a:b])
                names += found[0]
                scores += found[1]
                a = b
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*columns, *told])

    return docs.select(*columns, F.col("text").alias("_language_text")).mapInArrow(run, f"{schema}{told[0]} string, {told[1]} double")


def identify(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), prefix: str = "") -> DataFrame:
    """Train on the rows that aren't held out, predict all of them."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    return predict(docs, model, columns, prefix)
