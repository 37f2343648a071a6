"""Quality classifier: regularised quadratic discriminant over statistics of whole texts.

Each text becomes ``STATISTICS``: sizes as logarithms, shares as arcsines of their roots. They depend on the
text alone. Per class, Spark sums the moments of the labelled texts; a class's covariance is
shrunk towards the pooled one (``TO_POOLED``) and then towards a diagonal of equal variances
(``TO_SPHERE``). The score is the posterior of the good class: the difference of the two Gaussian log
densities (Mahalanobis distance and log determinant, both from the class's Cholesky factor, which is
computed once and travels with the tasks) plus the log odds of the classes, divided by a temperature.

Shrinkage and temperature are chosen by cross-validation. Moments add up, so the model of all folds but one
is a difference of sums, and one more pass over the labelled statistics gives the log loss of all choices.

All labels of the training part are used; no sample is drawn. Statistics are integers of ``1 / SCALE``, so
every sum is exact, and reruns agree whatever the order of tasks. Equal statistics count once per class:
copies of one text, a third of all rows perhaps, do not move the model.

Defined results: a null text counts as empty, and empty texts are scored by their statistics, too; rows with a
null id are scored and never learnt from; an id whose labels disagree is not learnt from, and rows that repeat
an id are each judged by their own text; without labelled texts of both classes every score is the share
of good ones, ``(good + 1) / (all + 2)``; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerstar.llm import words as W
from ledgerstar.llm.tables import Tables

GOOD_FROM = 0.7  # least score of a text predicted good
SCALE = 1 << 16
FOLDS = 4
TO_POOLED = (0.01, 0.05, 0.2, 0.5)
TO_SPHERE = (0.001, 0.01, 0.05, 0.2)
TEMPERATURES = (1.0, 2.0, 4.0, 8.0)
LOSS_SCALE = 1 << 20
FAR = 500.0  # log odds beyond this are as certain
WINDOW = 5

STATISTICS = (
    "log_words", "log_word_length", "word_length_spread", "letters", "capitals", "digits", "stops",
    "other_marks", "quotes", "pipes", "distinct_words", "top_word", "repeated_windows", "short_words",
    "marked_ends", "entropy", "log_line", "compression",
)
SIZE = len(STATISTICS)

STATED = "doc_id long, stats binary"
MOMENTS = "fold int, good int, entry int, value long"
LOSSES = "choice int, loss long"


# Statistics --------------------------------------------------------------------------------


def _members(characters: str) -> np.ndarray:
    found = np.zeros(256)
    found[list(characters.encode())] = 1
    return found


# Kinds of bytes; a character beyond ASCII is counted at its first byte, as a letter
CAPITALS = _members("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
SMALL = _members("abcdefghijklmnopqrstuvwxyz")
BEYOND = np.concatenate([np.zeros(192), np.ones(64)])
DIGITS = _members("0123456789")
STOPS = _members(".,;:!?")
QUOTES = _members("'\"()-")
PIPES = _members("|")
WHITE = _members(" \t\n\x0b\x0c\r")
VISIBLE = np.concatenate([np.ones(128), np.zeros(64), np.ones(64)]) - WHITE
KINDS = np.stack([VISIBLE, CAPITALS + SMALL + BEYOND, CAPITALS, DIGITS, STOPS, QUOTES, PIPES])
NOT_MARK = CAPITALS + SMALL + DIGITS + np.concatenate([np.zeros(128), np.ones(128)])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _per(owner: np.ndarray, values, size: int) -> np.ndarray:
    return np.bincount(owner, values, size)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Arcsine of the root of a share, which evens out the variance of counts."""
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def _in_repeats(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether each word lies in a window of ``WINDOW`` words that its text has twice."""
    marked = np.zeros(len(codes) + 1, np.int64)
    n = len(codes) - WINDOW + 1
    if n > 0:
        keys = W.mixed(owner[:n].astype(np.uint64) + np.uint64(1))
        for i in range(WINDOW):
            keys = W.chained(keys, W.mixed(codes[i : n + i].astype(np.uint64)))
        whole = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
        order = whole[np.argsort(keys[whole])]
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
        np.add.at(marked, twice, 1)
        np.add.at(marked, twice + WINDOW, -1)
    return np.cumsum(marked[:-1]) > 0


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of whole numbers per text: ``STATISTICS`` times ``SCALE``."""
    n = len(texts)
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    cells = np.repeat(np.arange(n), sizes) * 256 + data
    counts = np.bincount(cells, minlength=256 * n).reshape(n, 256)
    visible, letters, capitals, digits, stops, quotes, pipes = KINDS @ counts.T
    marks = visible - letters - digits - stops - quotes - pipes
    shares = counts / np.maximum(sizes, 1)[:, None]
    entropy = -(shares * np.log2(np.where(shares > 0, shares, 1))).sum(1)
    lines = counts[:, 10] + 1

    words, n_words = W.split_all(texts)
    owner = np.repeat(np.arange(n), n_words)
    codes = np.fromiter(map(_Numbers().__getitem__, words), np.int64, len(words))
    # code points of each word, from the number of bytes that begin one
    blank = WHITE[data].astype(bool)
    first = np.ones(len(data), bool)
    first[1:] = blank[:-1]
    edges = np.cumsum(sizes) - sizes
    first[edges[sizes > 0]] = True
    starts = np.flatnonzero(first & ~blank)
    begun = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    ends = starts + np.fromiter(map(len, words), np.int64, len(words))
    lengths = (begun[ends] - begun[starts]).astype(float)
    total, squares = _per(owner, lengths, n), _per(owner, lengths * lengths, n)
    mean = total / np.maximum(n_words, 1)
    spread = np.sqrt(np.maximum(squares / np.maximum(n_words, 1) - mean * mean, 0))
    short = _per(owner, lengths <= 3, n)
    marked = _per(owner, NOT_MARK[data[ends - 1]] == 0 if len(words) else [], n)

    pairs, times = np.unique(owner * (int(codes.max(initial=0)) + 1) + codes, return_counts=True)
    of = pairs // (int(codes.max(initial=0)) + 1)
    distinct = np.bincount(of, minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, of, times)
    repeated = _per(owner, _in_repeats(codes, owner), n)
    # how few bytes hold the text, a plain sign of repetition at any distance
    squeezed = np.fromiter((len(zlib.compress(x, 1)) for x in texts), np.int64, n)

    columns = [
        np.log1p(n_words),
        np.log1p(mean),
        np.log1p(spread),
        _share(letters, visible),
        _share(capitals, letters),
        _share(digits, visible),
        _share(stops, visible),
        _share(marks, visible),
        _share(quotes, visible),
        _share(pipes, visible),
        np.log1p(distinct) / np.log1p(np.maximum(n_words, 1)),
        _share(top, n_words),
        _share(repeated, n_words),
        _share(short, n_words),
        _share(marked, n_words),
        entropy / 8,
        np.log1p(visible / lines),
        np.log1p(sizes) - np.log1p(squeezed),
    ]
    return np.rint(np.stack(columns, 1) * SCALE).astype(np.int32)


def _state(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in W.groups(batches):
        found = statistics(W.texts(part.column("text")))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([x.tobytes() for x in found], pa.binary())],
            names=["doc_id", "stats"],
        )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, SIZE)


# Moments and models --------------------------------------------------------------------------


@dataclass(frozen=True)
class Moments:
    """Number, sum and sum of products of the rows of one class."""

    n: int
    first: np.ndarray
    second: np.ndarray

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.first - other.first, self.second - other.second)

    def mean(self) -> np.ndarray:
        return (self.first / self.n).astype(float) / SCALE

    def scatter(self) -> np.ndarray:
        """Sum of squared deviations; whole numbers until the last step."""
        return ((self.n * self.second - np.outer(self.first, self.first)) / self.n).astype(float) / SCALE**2


@dataclass(frozen=True)
class Model:
    """Means and inverted Cholesky factors of both classes."""

    means: np.ndarray
    factors: np.ndarray
    offset: float  # log odds of the classes, with the determinants

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        values = rows / SCALE
        bad, good = (
            (((values - mean) @ factor.T) ** 2).sum(1) for mean, factor in zip(self.means, self.factors)
        )
        return np.clip(self.offset + (bad - good) / 2, -FAR, FAR)


def fitted(classes: list[Moments], to_pooled: float, to_sphere: float) -> Model:
    """The discriminant of the moments of bad and of good texts."""
    scatters = [x.scatter() for x in classes]
    pooled = sum(scatters) / sum(x.n for x in classes)
    spread = np.sqrt(np.diag(pooled))
    spread[spread < 1 / SCALE] = 1 / SCALE
    factors, offset = [], np.log(classes[1].n / classes[0].n)
    for sign, scatter, held in zip((1, -1), scatters, classes):
        # in units of the pooled deviations
        own = scatter / held.n / np.outer(spread, spread)
        shrunk = (1 - to_pooled) * own + to_pooled * pooled / np.outer(spread, spread)
        sphere = np.eye(SIZE) * np.trace(shrunk) / SIZE
        lower = np.linalg.cholesky((1 - to_sphere) * shrunk + to_sphere * sphere)
        factors.append(np.linalg.inv(lower) / spread)
        offset += sign * np.log(np.diag(lower)).sum()
    return Model(np.stack([x.mean() for x in classes]), np.stack(factors), float(offset))


UPPER = np.triu_indices(SIZE + 1)


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of each row, with a 1 before it, summed over a batch."""
    for batch in batches:
        rows = _matrix(batch.column("stats")).astype(np.int64)
        rows = np.concatenate([np.ones((len(rows), 1), np.int64), rows], 1)
        folds, good = (batch.column(x).to_numpy(False) for x in ("fold", "good"))
        for fold, kind in sorted(set(zip(folds.tolist(), good.tolist()))):
            part = rows[(folds == fold) & (good == kind)]
            sums = (part.T @ part)[UPPER]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([fold] * len(sums), pa.int32()),
                    pa.array([kind] * len(sums), pa.int32()),
                    pa.array(range(len(sums)), pa.int32()),
                    pa.array(sums, pa.int64()),
                ],
                names=["fold", "good", "entry", "value"],
            )


def moments(learnt: DataFrame) -> dict[tuple[int, int], Moments]:
    """By fold and class. ``2 * FOLDS`` symmetric matrices come to the driver, whatever the input."""
    summed = (
        learnt.mapInArrow(_moments, MOMENTS)
        .groupBy("fold", "good", "entry")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    )
    found = {
        (fold, good): np.zeros((SIZE + 1, SIZE + 1), object) for fold in range(FOLDS) for good in (0, 1)
    }
    for row in summed.collect():
        i, j = UPPER[0][row["entry"]], UPPER[1][row["entry"]]
        found[row["fold"], row["good"]][i, j] = found[row["fold"], row["good"]][j, i] = int(row["value"])
    return {key: Moments(x[0, 0], x[0, 1:], x[1:, 1:]) for key, x in found.items()}


def _losses(batches: Iterable[pa.RecordBatch], models: list[list[Model | None]]) -> Iterator[pa.RecordBatch]:
    """Log loss of every choice, each row judged by the model that has not seen its fold."""
    for batch in batches:
        rows = _matrix(batch.column("stats"))
        folds, good = (batch.column(x).to_numpy(False) for x in ("fold", "good"))
        losses = np.zeros((len(models), len(TEMPERATURES)), np.int64)
        for fold in set(folds.tolist()):
            part = folds == fold
            signs = 2 * good[part] - 1
            for i, model in enumerate(models):
                if model[fold] is not None:
                    odds = model[fold].log_odds(rows[part]) * signs
                    for j, heat in enumerate(TEMPERATURES):
                        losses[i, j] += np.rint(np.logaddexp(0, -odds / heat) * LOSS_SCALE).astype(np.int64).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(losses.size), pa.int32()), pa.array(losses.ravel(), pa.int64())],
            names=["choice", "loss"],
        )


@dataclass(frozen=True)
class Classifier:
    model: Model | None
    temperature: float
    share: float  # of good ones, where there is no model

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.model is None:
            return np.full(len(rows), self.share)
        return 1 / (1 + np.exp(-self.model.log_odds(rows) / self.temperature))


def train(learnt: DataFrame) -> Classifier:
    """From rows of ``stats, good, fold``."""
    parts = moments(learnt)
    whole = []
    for good in (0, 1):
        kind = [parts[fold, good] for fold in range(FOLDS)]
        whole.append(Moments(*(sum(getattr(x, name) for x in kind) for name in ("n", "first", "second"))))
    share = (whole[1].n + 1) / (whole[0].n + whole[1].n + 2)
    if min(x.n for x in whole) == 0:
        return Classifier(None, 1.0, share)
    shrinkage = [(p, s) for p in TO_POOLED for s in TO_SPHERE]
    others = [[whole[good] - parts[fold, good] for good in (0, 1)] for fold in range(FOLDS)]
    models = [[fitted(x, *choice) if min(y.n for y in x) else None for x in others] for choice in shrinkage]
    losses = learnt.mapInArrow(lambda batches: _losses(batches, models), LOSSES)
    summed = losses.groupBy("choice").agg(F.sum(F.col("loss").cast("decimal(38,0)")).alias("loss"))
    best = min(summed.collect(), key=lambda row: (row["loss"], row["choice"]))["choice"]
    shrunk, heat = divmod(best, len(TEMPERATURES))
    return Classifier(fitted(whole, *shrinkage[shrunk]), TEMPERATURES[heat], share)


# The operator ----------------------------------------------------------------------------------


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether the CRC of an id, as text, leaves ``part``; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def _score(batches: Iterable[pa.RecordBatch], classifier: Classifier) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            scores = classifier.scores(_matrix(batch.column("stats")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )


def scored(documents: DataFrame, labels: DataFrame, tables: Tables) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    stated = tables.save(texts.mapInArrow(_state, STATED), "stats")
    marked = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .filter(~held_out(F.col("doc_id").cast("long")))
        .groupBy(F.col("doc_id").cast("long").alias("of"))
        .agg(F.min("quality").alias("good"), F.max("quality").alias("high"))
        .filter("good = high")
    )
    learnt = (
        stated.join(marked, F.expr("doc_id = of"))
        .select("stats", F.col("good").cast("int").alias("good"))
        .distinct()
        .withColumn("fold", F.expr(f"CAST(pmod(xxhash64(stats), {FOLDS}) AS INT)"))
    )
    classifier = train(tables.save(learnt, "learnt"))
    return stated.mapInArrow(lambda batches: _score(batches, classifier), "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.expr(f"CAST(score >= {GOOD_FROM}D AS INT) AS predicted"),
    )
