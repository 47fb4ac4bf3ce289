"""Quality classification by co-training two views of a document.

The text view sees the content alone (shares of byte classes, word and line repetition, word lengths): a logistic
regression.  The metadata view sees source, lang and n_chars alone, and their pairs: log odds of its slots, from
counts.  They start from the labelled documents; in every round each view labels the unlabelled documents
it is confident of, and the other view learns from them too: good and bad in the proportion of the labelled rows,
and with no more weight in all than the labelled rows, or ``PSEUDO_MOST`` rows.  At the end each view is
calibrated, and a small logistic model combines the calibrated views, both on labelled documents that no
view was fitted on, each on its own part.  Every document of the table is scored; ``keep`` is ``score >= KEEP``.

Only the labelled rows that are fitted on are bounded: at most ``max_labels`` rows (a parameter) by a hash of id and
place; they come to the driver.  All other rows of the table take part in every round: a pass over the table
of features adds up, in each task, what a Newton step of the text view and the counts of the metadata view need,
some two thousand numbers, and Spark sums these by key.  Features are computed once and stored without texts
where the caller doesn't carry them.

Defined cases: a null text counts as empty; null source, lang or n_chars are values of their own; labels without
a document or with a null are left out, several labels of a document vote and a tie is left out; without
labels of both kinds every document is kept with the share of good labels (1 without any) as its score; where
a part of the labelled rows lacks a kind, all labelled rows stand in for it; repeated rows are scored row
by row; rows of a null id are unlabelled; extra columns pass through.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.llm._arrays import U64, row_slices, span_hashes, utf8, words_of
from glyphloom.llm._storage import small_batches, stored

MAX_LABELS = 20_000
ROUNDS = 3
#: Newton steps of a round, from weights of 0, where they do not overshoot.
STEPS = 4
#: Calibrated probability from which a view passes its label on; the weight of such a label, and of all of them.
CONFIDENT = 0.9
PSEUDO_WEIGHT = 0.3
PSEUDO_MOST = 5_000
KEEP = 0.5

_CLASSES = np.full(256, 7, np.uint8)  # letters beyond ASCII
_CLASSES[:128] = 5  # other signs
for _k, _set in enumerate((range(65, 91), range(97, 123), range(48, 58), (32, 9), (10, 13))):
    _CLASSES[list(_set)] = _k
_CLASSES[list(b".,;:'\"?()-")] = 6
_BANG, _PIPE = 33, 124
TEXT_FEATURES = 20
#: Slots of the metadata view: source, lang, size, source with lang, source with size.
SLOTS = (256, 64, 32, 1024, 1024)
_FIRST = np.concatenate([[0], np.cumsum(SLOTS)])


def text_features(column: pa.Array) -> np.ndarray:
    """One row of TEXT_FEATURES numbers for each text, from its content alone."""
    data, offsets = utf8(column)
    out = np.zeros((len(offsets) - 1, TEXT_FEATURES))
    for a, b in row_slices(offsets):
        part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        n = b - a
        size = np.maximum(np.diff(own), 1)
        row = np.repeat(np.arange(n), np.diff(own))
        classes = np.bincount(row * 8 + _CLASSES[part], minlength=n * 8).reshape(n, 8)
        out[a:b, :8] = classes / size[:, None]
        letters = np.maximum(classes[:, 0] + classes[:, 1], 1)
        out[a:b, 8] = classes[:, 0] / letters
        for k, sign in ((9, _BANG), (10, _PIPE)):
            out[a:b, k] = np.bincount(row[part == sign], minlength=n) / size
        # lines: their number, and the share of those seen before in the text
        lines = np.flatnonzero((np.concatenate([[True], (part[:-1] == 10)]) if len(part) else np.zeros(0, bool)) | np.isin(np.arange(len(part)), own[:-1]))
        if len(lines):
            owner = row[lines]
            named = span_hashes(part, lines)
            order = np.lexsort((named, owner))
            again = (named[order][1:] == named[order][:-1]) & (owner[order][1:] == owner[order][:-1])
            count = np.maximum(np.bincount(owner, minlength=n), 1)
            out[a:b, 11] = np.bincount(owner[order][1:][again], minlength=n) / count
            out[a:b, 12] = np.log1p(size / count)
    for a, b, words, counts in words_of(column):
        n = b - a
        row = np.repeat(np.arange(n), counts)
        many = np.maximum(counts, 1)
        order = np.lexsort((words, row))
        w, r = words[order], row[order]
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (r[1:] != r[:-1])
        kinds = np.bincount(r[new], minlength=n)
        out[a:b, 13] = kinds / many
        out[a:b, 14] = np.log1p(kinds) / np.log1p(many)
        if len(w):
            begin = np.flatnonzero(new)
            run = np.diff(np.append(begin, len(w)))
            top = np.zeros(n)
            np.maximum.at(top, r[begin], run)
            out[a:b, 15] = top / many
            same = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
            out[a:b, 16] = np.bincount(row[1:][same], minlength=n) / many
            pair = words[1:] * U64(3) + words[:-1]
            inside = row[1:] == row[:-1]
            o = np.lexsort((pair[inside], row[1:][inside]))
            p, q = pair[inside][o], row[1:][inside][o]
            fresh = np.ones(len(p), bool)
            fresh[1:] = (p[1:] != p[:-1]) | (q[1:] != q[:-1])
            out[a:b, 17] = np.bincount(q[fresh], minlength=n) / many
        bytes_ = np.diff(offsets[a : b + 1])
        out[a:b, 18] = np.log1p(bytes_ / many)
        out[a:b, 19] = np.log1p(counts)
    return out


def _slot(value: str | None, slots: int) -> int:
    return 0 if value is None else 1 + zlib.crc32(value.encode()) % (slots - 1)


def meta_slots(source: pa.Array, lang: pa.Array, chars: pa.Array) -> np.ndarray:
    """The slot of each document in each of SLOTS, from its metadata alone."""

    def coded(column: pa.Array, slots: int) -> np.ndarray:
        names = pc.cast(column, pa.string()).to_pylist()
        slot = {v: _slot(v, slots) for v in set(names)}
        return np.array([slot[v] for v in names], np.int64)

    a, b = coded(source, SLOTS[0]), coded(lang, SLOTS[1])
    n = pc.fill_null(pc.cast(chars, pa.int64()), -1).to_numpy(zero_copy_only=False)
    size = np.where(n < 0, 0, 1 + np.minimum(SLOTS[2] - 2, np.log2(np.maximum(n, 1)).astype(np.int64)))
    pair = lambda x, y, slots: (x * 0x9E3779B1 + y * 0x85EBCA77) % slots
    return (np.stack([a, b, size, pair(a, b, SLOTS[3]), pair(a, size, SLOTS[4])], axis=1) + _FIRST[:-1]).astype(np.int64)


@dataclass
class Odds:
    """Log odds of good, added up over the slots of a row, each shrunk to the share of good in all."""

    table: np.ndarray = field(default_factory=lambda: np.zeros(_FIRST[-1]))
    prior: float = 0.0
    shrink: float = 4.0

    def fit(self, counts: np.ndarray) -> Odds:
        """``counts``: 2 x slots, of bad and of good."""
        bad, good = counts
        share = (good[: SLOTS[0]].sum() + 0.5) / (counts[:, : SLOTS[0]].sum() + 1)
        odds = np.log(good + self.shrink * share) - np.log(bad + self.shrink * (1 - share))
        prior = float(np.log(share / (1 - share)))
        return replace(self, table=odds - prior, prior=prior)

    def logit(self, slots: np.ndarray) -> np.ndarray:
        return np.clip(self.prior + self.table[slots].sum(axis=1), -30, 30)


def slot_counts(slots: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """2 x slots: weights of bad and good rows."""
    out = np.zeros((2, _FIRST[-1]))
    for column in slots.T:
        np.add.at(out, (label.astype(np.int64), column), weight)
    return out


@dataclass
class Logistic:
    """L2-regularised logistic regression on standardised features and their squares, by Newton steps."""

    squares: bool = True
    ridge: float = 1.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([z, z**2, np.ones((len(z), 1))] if self.squares else [z, np.ones((len(z), 1))])

    def begin(self, x: np.ndarray) -> Logistic:
        """Standardised by ``x``, all weights 0."""
        start = replace(self, mean=x.mean(axis=0), scale=x.std(axis=0) + 1e-6)
        return replace(start, weights=np.zeros(start._inputs(x[:1]).shape[1]))

    def sums(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What a step needs of some rows: their gradient and curvature."""
        z = self._inputs(x)
        p = _sigmoid(np.clip(z @ self.weights, -30, 30))
        return z.T @ (w * (y - p)), (z * (w * np.maximum(p * (1 - p), 1e-5))[:, None]).T @ z

    def step(self, gradient: np.ndarray, curve: np.ndarray) -> Logistic:
        penalty = np.full(len(self.weights), self.ridge)
        penalty[-1] = 1e-3
        move = np.linalg.solve(curve + np.diag(penalty), gradient - penalty * self.weights)
        return replace(self, weights=self.weights + move * min(1.0, 4 / max(1e-9, np.abs(move).max())))

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        now, ones = self.begin(x), np.ones(len(x))
        for _ in range(30):
            new = now.step(*now.sums(x, y, ones))
            done, now = np.abs(new.weights - now.weights).max() < 1e-6, new
            if done:
                break
        return now

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._inputs(x) @ self.weights, -30, 30)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class CoTrained:
    """Both views, their calibration and their combination; ``base`` alone where labels were too few."""

    base: float = 1.0
    views: tuple[Logistic, Odds] | None = None
    calibration: tuple[Logistic, Logistic] | None = None
    combination: Logistic | None = None

    def view_logits(self, text: np.ndarray, slots: np.ndarray) -> list[np.ndarray]:
        return [c.logit(v.logit(x)[:, None]) for v, c, x in zip(self.views, self.calibration, (text, slots), strict=True)]

    def score(self, text: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.views is None:
            same = np.full(len(text), self.base)
            return same, same, same
        logits = self.view_logits(text, slots)
        return _sigmoid(logits[0]), _sigmoid(logits[1]), _sigmoid(self.combination.logit(np.stack(logits, axis=1)))

    def pseudo_labels(self, text: np.ndarray, slots: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each view the label that it is given by the other, and its weight: 0 where the other isn't confident."""
        out = []
        for logit in reversed(self.view_logits(text, slots)):
            p = _sigmoid(logit)
            out.append(((p >= 0.5).astype(float), np.where((p >= CONFIDENT) | (p <= 1 - CONFIDENT), PSEUDO_WEIGHT, 0.0)))
        return out


@dataclass
class Labelled:
    """The bounded labelled rows on the driver: features, slots, labels, and the part of each row."""

    text: np.ndarray
    slots: np.ndarray
    label: np.ndarray
    part: np.ndarray

    def of(self, parts: tuple[int, ...]) -> np.ndarray:
        """Rows of ``parts``, or all if a kind of label is missing there."""
        own = np.isin(self.part, parts)
        return np.flatnonzero(own) if len(set(self.label[own])) == 2 else np.arange(len(self.label))


#: Of eight parts by hash of the id: those that calibrate the views, and those that fit their combination.
CALIBRATING, COMBINING = (0, 1), (2, 3)
FITTING = (4, 5, 6, 7)
#: Columns of a table of features, besides those carried.
OWN = ("_quality_id", "_quality_text", "_quality_slots")


def _columns(docs: DataFrame) -> list:
    return [F.col("text").alias("_text"), F.col("source").alias("_source"), F.col("lang").alias("_lang"), F.col("n_chars").cast("long").alias("_chars")]


def featured(docs: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """``columns`` of every row, with the columns OWN: id and the features of both views, as a scratch table."""
    small_batches(docs.sparkSession)
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in columns)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, source, lang, chars = b.columns[-4:]
            x, s = text_features(text).astype(np.float32), meta_slots(source, lang, chars).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns[:-4], *(pa.array([r.tobytes() for r in m], pa.binary()) for m in (x, s))], names=[*columns, *OWN])

    slim = docs.select(*columns, F.col("doc_id").alias(OWN[0]), *_columns(docs))
    return stored(slim.mapInArrow(run, f"{schema}{OWN[0]} {kind}, {OWN[1]} binary, {OWN[2]} binary"), "quality-features")


def _matrices(x: pa.Array, slots: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    of = lambda c, kind, width: np.frombuffer(b"".join(c.to_pylist()), kind).reshape(-1, width)
    return of(x, np.float32, TEXT_FEATURES).astype(float), of(slots, np.int32, len(SLOTS)).astype(np.int64)


def _votes(labels: DataFrame, max_labels: int) -> DataFrame:
    """(_labelled, _label): the labelled ids with the smallest hashes."""
    votes = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("q"))
    votes = votes.where(F.col("q") != 0.5).select(F.col("doc_id").alias("_labelled"), F.when(F.col("q") > 0.5, 1).otherwise(0).alias("_label"))
    return stored(votes.orderBy(F.xxhash64("_labelled"), "_labelled").limit(max_labels), "quality-labels")


def labelled_rows(features: DataFrame, votes: DataFrame, max_labels: int) -> Labelled:
    """At most ``max_labels`` labelled rows, whatever the number of rows of an id."""
    rows = features.select(*OWN).join(F.broadcast(votes), F.col(OWN[0]) == F.col("_labelled"))
    part = F.pmod(F.xxhash64(OWN[0], F.lit(5)), F.lit(8)).cast("int").alias("part")
    own = rows.select(F.col("_label").alias("label"), part, F.col(OWN[1]).alias("x"), F.col(OWN[2]).alias("slots"), F.pmod(F.xxhash64(OWN[0], F.monotonically_increasing_id()), F.lit(1 << 30)).alias("place"))
    n = own.count()
    if n > max_labels:
        own = own.where(F.col("place") < int((1 << 30) * 0.95 * max_labels / n)).limit(max_labels)
    table = own.drop("place").toArrow()
    text, slots = _matrices(table.column("x"), table.column("slots"))
    label, part = table.column("label").to_numpy(), table.column("part").to_numpy()
    # rows come in any order: a fixed one gives the same model each time
    order = np.lexsort((*text.T, *slots.T, part, label))
    return Labelled(text[order], slots[order], label[order].astype(float), part[order])


@dataclass
class Sums:
    """What the rows of one pseudo-label, bad or good, add up to: weight, gradient and curvature; and slot counts."""

    weight: np.ndarray
    gradient: np.ndarray
    curve: np.ndarray
    counts: np.ndarray

    @staticmethod
    def empty(size: int) -> Sums:
        return Sums(np.zeros(2), np.zeros((2, size)), np.zeros((2, size, size)), np.zeros((2, _FIRST[-1])))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.weight, self.gradient, self.curve, self.counts)])

    @staticmethod
    def of(flat: np.ndarray, size: int) -> Sums:
        out, at = Sums.empty(size), 0
        for x in (out.weight, out.gradient, out.curve, out.counts):
            x[...] = flat[at : at + x.size].reshape(x.shape)
            at += x.size
        return out


def _scale(weight: np.ndarray, share: float, most: float) -> np.ndarray:
    """Factors of bad and good that give them the labelled proportion and at most ``most`` in all; 0 where one is missing."""
    if not weight.all():
        return np.zeros(2)
    return np.array([1 - share, share]) * min(weight.sum(), most) / weight


def _summed(rows: DataFrame, model: CoTrained, now: Logistic) -> Sums:
    """Over all rows with pseudo-labels: what a step of the text view from ``now`` needs, and the other's counts."""
    size = len(now.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Sums.empty(size)
        for b in batches:
            if not b.num_rows:
                continue
            text, slots = _matrices(*b.columns)
            (y, w), (z, v) = model.pseudo_labels(text, slots)
            for kind in (0, 1):
                some = (w > 0) & (y == kind)
                total.weight[kind] += w[some].sum()
                gradient, curve = now.sums(text[some], y[some], w[some])
                total.gradient[kind] += gradient
                total.curve[kind] += curve
            total.counts += slot_counts(slots[v > 0], z[v > 0], v[v > 0])
        flat = total.flat()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at])], names=["k", "v"])

    found = rows.mapInArrow(run, "k bigint, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    flat = Sums.empty(size).flat()
    flat[found.column("k").to_numpy()] = found.column("v").to_numpy()
    return Sums.of(flat, size)


def co_train(known: Labelled, unlabelled: DataFrame, rounds: int = ROUNDS) -> CoTrained:
    """``unlabelled``: rows of the features of both views."""
    base = float(known.label.mean()) if len(known.label) else 1.0
    if len(set(known.label)) < 2:
        return CoTrained(base)
    fit, scale, joint = (known.of(parts) for parts in (FITTING, CALIBRATING, COMBINING))
    text, slots, label = known.text[fit], known.slots[fit], known.label[fit]
    most = max(len(fit), PSEUDO_MOST)
    ones, own_counts = np.ones(len(fit)), slot_counts(known.slots[fit], known.label[fit], np.ones(len(fit)))

    def calibrated(view: Logistic, odds: Odds) -> CoTrained:
        inputs = (view.logit(known.text[scale]), odds.logit(known.slots[scale]))
        return CoTrained(base, (view, odds), tuple(Logistic(squares=False, ridge=0.1).fit(x[:, None], known.label[scale]) for x in inputs))

    model = calibrated(Logistic().fit(text, label), Odds().fit(own_counts))
    for _ in range(rounds):
        now, odds = Logistic().begin(text), model.views[1]
        for turn in range(STEPS):
            found = _summed(unlabelled, model, now)
            factor = _scale(found.weight, base, most)
            gradient, curve = now.sums(text, label, ones)
            now = now.step(gradient + factor @ found.gradient, curve + np.tensordot(factor, found.curve, 1))
            if turn == 0:
                factor = _scale(found.counts[:, : SLOTS[0]].sum(axis=1), base, most)
                odds = Odds().fit(own_counts + factor[:, None] * found.counts)
        model = calibrated(now, odds)
    logits = model.view_logits(known.text[joint], known.slots[joint])
    return replace(model, combination=Logistic(squares=False, ridge=0.1).fit(np.stack(logits, axis=1), known.label[joint]))


def fitted(features: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, rounds: int = ROUNDS) -> CoTrained:
    """The model of a table of features (``featured``) and labels (doc_id, quality)."""
    votes = _votes(labels, max_labels)
    known = labelled_rows(features, votes, max_labels)
    others = features.select(*OWN).join(F.broadcast(votes), F.col(OWN[0]) == F.col("_labelled"), "left_anti")
    return co_train(known, others.select(*OWN[1:]), rounds)


def scored(features: DataFrame, model: CoTrained, columns: tuple[str, ...], prefix: str = "") -> DataFrame:
    """``columns`` of a table of features, with text_score, meta_score, quality_score and keep, named with ``prefix``."""
    shared = features.sparkSession.sparkContext.broadcast(model)
    schema = "".join(f"`{c}` {features.schema[c].dataType.simpleString()}, " for c in columns)
    told = [f"{prefix}{c}" for c in ("text_score", "meta_score", "quality_score", "keep")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = shared.value.score(*_matrices(*b.columns[-2:]))
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], *(pa.array(f, pa.float64()) for f in found), pa.array(found[2] >= KEEP)], names=[*columns, *told])

    return features.select(*columns, *OWN[1:]).mapInArrow(run, f"{schema}{told[0]} double, {told[1]} double, {told[2]} double, {told[3]} boolean")


def classify(docs: DataFrame, labels: DataFrame, columns: tuple[str, ...] = ("doc_id",), max_labels: int = MAX_LABELS, rounds: int = ROUNDS, prefix: str = "") -> DataFrame:
    """``columns`` of every row of ``docs``, with text_score, meta_score, quality_score and keep, named with ``prefix``."""
    features = featured(docs, columns)
    return scored(features, fitted(features, labels, max_labels, rounds), columns, prefix)
