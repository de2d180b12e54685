"""Quality classifier by Bradley-Terry pairwise ranking.

Every document labelled 1 is preferred to every one labelled 0: weights are fitted by logistic loss on the feature differences of all these pairs. A document's
score is the weights' product with its features: counts of the text's surface, and its words in hashed buckets. The threshold is a quantile of training scores: the share of labels 0.

All labelled rows are learned from, none is drawn and no pair is written down. A pair's loss depends on its two scores alone, so a pass over the rows counts each class's scores on a
fine grid, a row between two points counting at both by its nearness; from the counts follows how strongly all rows of the other class pull at a row of any score, and a second pass
sums rows times pulls. Both passes make one Newton step. The driver gets counts by grid point and one row of sums a task, whose sizes depend on the features and the grid.

Defined results: null and empty texts have all-zero features and still get a score; null labels are not learned from; with
no labelled row, or one class only, every score is the threshold's own value; repeated rows give equal rows; an empty
table gives an empty table; labels, languages, sources and ids never enter a score.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fieldseries.llm.common import by_text, cut, drop_cuts
from fieldseries.operators.ranks import percentiles

#: Words are counted in so many buckets by their checksum; a bucket's feature is its share of the words.
BUCKETS = 48
FEATURES = ("log_words", "word_length", "upper", "digits", "symbols", "bars", "exclamations", "stops", "commas", "distinct_words", "repeated_neighbours", "distinct_pairs", "dup_lines", "log_lines", "short_words", "other_marks", *(f"words_{i}" for i in range(BUCKETS)))

#: Grid points lie STEP apart for scores near 0 and further apart beyond SPREAD, so that their number stays bounded; curvature is taken on a grid of COARSE points in one.
STEP, SPREAD, COARSE = 1 / 128, 8.0, 64
#: More distinct training scores than this are sorted over many tasks for the threshold.
SORTED_IN_ONE = 10_000


def features(text: str | None) -> list[float]:
    """Every value is bounded, and finite for any text."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    low = text.lower()
    chars = len(text)
    same = len(low) == chars
    upper = int(np.count_nonzero(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32) != np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32))) if same else 0
    bucket = np.bincount([zlib.crc32(w.encode("utf-8", "replace")) % BUCKETS for w in low.split()], minlength=BUCKETS) / n
    count = text.count
    digits = sum(map(count, "0123456789"))
    symbols = sum(map(count, "#*$%&<>@^~_=+"))
    marks = sum(map(count, "?;:\"'()[]{}/\\-"))
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = list(zip(words, words[1:], strict=False))
    return [
        math.log1p(n), min(20.0, sum(map(len, words)) / n), upper / chars, digits / chars, min(4.0, symbols / n), min(2.0, count("|") / n), min(4.0, count("!") / n), min(1.0, count(".") / n), min(1.0, count(",") / n), len(set(words)) / n,
        sum(a == b for a, b in pairs) / n, len(set(pairs)) / max(1, n - 1), 1 - len(set(lines)) / max(1, len(lines)), math.log1p(len(lines)), sum(len(w) <= 3 for w in words) / n, min(2.0, marks / n), *bucket.tolist(),
    ]


@dataclass
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def product(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray, at_threshold: float) -> np.ndarray:
        """In (0, 1); the training quantile gets at_threshold."""
        s = self.product(x) - self.threshold
        return 1 / (1 + np.exp(-np.clip(s + math.log(at_threshold / (1 - at_threshold)), -500, 500)))


def newton(loss: Callable[[np.ndarray], float], slopes: Callable[[], tuple[np.ndarray, np.ndarray]], width: int, rounds: int = 30) -> np.ndarray:
    """Weights from 0 by Newton steps, halved while they raise the loss by more than its rounding. slopes gives slope and curvature where loss was asked for last."""
    w = np.zeros(width)
    now = loss(w)
    for _ in range(rounds):
        slope, curve = slopes()
        step = np.linalg.solve(curve, slope)
        then = loss(w - step)
        while then > 1.001 * now and abs(step).max() > 1e-6:
            step /= 2
            then = loss(w - step)
        w, now = w - step, then
        if abs(step).max() < 1e-6:
            break
    return w


def fit_pairs(better: np.ndarray, worse: np.ndarray, ridge: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Bradley-Terry weights of given preference pairs: the least mean log(1 + exp(-w(better - worse))) + ridge |w|^2."""
    d = better - worse
    last = np.zeros(d.shape[1])

    def loss(w: np.ndarray) -> float:
        last[:] = w
        return float(np.logaddexp(0, -d @ w).mean() + ridge * w @ w)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = np.exp(-np.logaddexp(0, d @ last))
        return -(d * p[:, None]).mean(0) + 2 * ridge * last, (d * (p * (1 - p))[:, None]).T @ d / len(d) + 2 * ridge * np.eye(d.shape[1])

    return newton(loss, slopes, d.shape[1], rounds)


def point(k: np.ndarray) -> np.ndarray:
    """The score at a grid point."""
    return SPREAD * np.sinh(np.asarray(k, float) * (STEP / SPREAD))


def on_grid(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The grid point below each score, and how near the score is to the point above it (0 to 1)."""
    k = np.floor(np.arcsinh(s / SPREAD) * (SPREAD / STEP)).astype(np.int64)
    low, high = point(k), point(k + 1)
    return k, np.clip((s - low) / (high - low), 0, 1)


def matrix(batch: pa.RecordBatch, name: str = "__x") -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _sums(rows: DataFrame, add: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """add(features, labels) summed over each task's rows; a task without rows gives nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                made = add(matrix(b), b.column("__y").to_numpy())
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["v"])

    return [np.array(r["v"]) for r in rows.mapInArrow(run, "v array<double>").collect()]


@dataclass
class AllPairs:
    """Loss, slope and curvature over all pairs of a row labelled 1 and one labelled 0, of rows(__x, __y) less mean over scale."""

    rows: DataFrame
    mean: np.ndarray
    scale: np.ndarray
    n: tuple[int, int]
    ridge: float = 1e-3

    def loss(self, w: np.ndarray) -> float:
        mean, scale = self.mean, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                y = b.column("__y").to_numpy()
                k, up = on_grid(((matrix(b) - mean) / scale) @ w)
                keys, to = np.unique(2 * k + y, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.bincount(to, 1 - up, len(keys))), pa.array(np.bincount(to, up, len(keys)))], names=["k", "low", "up"])

        found = self.rows.mapInArrow(run, "k long, low double, up double").groupBy("k").agg(F.sum("low").alias("low"), F.sum("up").alias("up")).orderBy("k").toPandas()
        keys, low, up = (found[c].to_numpy() for c in ("k", "low", "up"))
        self.w, self.first = w.copy(), int(keys.min() // 2)
        size = int(keys.max() // 2) - self.first + 2
        counts, coarse = np.zeros((2, size)), np.zeros((2, (self.first + size - 1) // COARSE - self.first // COARSE + 1))
        at, y = keys // 2 - self.first, keys % 2
        np.add.at(counts, (y, at), low)
        np.add.at(counts, (y, at + 1), up)
        np.add.at(coarse, (y, keys // 2 // COARSE - self.first // COARSE), low + up)
        self.coarse = coarse
        grid = point(self.first + np.arange(size))
        total, self.pulls = 0.0, np.zeros((2, size))
        for i in range(0, size, 1000):  # pulls[1]: of all rows of 0 at a row of 1, pulls[0] the other way round
            d = grid[i : i + 1000, None] - grid  # scores of 1 less scores of 0
            p = np.exp(-np.logaddexp(0, d))
            self.pulls[1, i : i + 1000] = p @ counts[0]
            self.pulls[0] += counts[1, i : i + 1000] @ p
            total += float(counts[1, i : i + 1000] @ np.logaddexp(0, -d) @ counts[0])
        return total / (self.n[0] * self.n[1]) + self.ridge * float(w @ w)

    def slopes(self) -> tuple[np.ndarray, np.ndarray]:
        mean, scale, w, first, pulls, width = self.mean, self.scale, self.w, self.first, self.pulls, len(self.w)
        cells = self.coarse.shape[1]
        middle = point((first // COARSE + np.arange(cells) + 0.5) * COARSE)
        p = np.exp(-np.logaddexp(0, middle[:, None] - middle))
        bend = p * (1 - p)  # of a pair, by the cells of its scores
        bends = np.array([self.coarse[1] @ bend, bend @ self.coarse[0]])

        def add(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = (x - mean) / scale
            k, up = on_grid(z @ w)
            k = np.clip(k, first, first + pulls.shape[1] - 2)  # another batch may round a product otherwise
            pull = pulls[y, k - first] * (1 - up) + pulls[y, k - first + 1] * up
            cell = k // COARSE - first // COARSE
            by = np.zeros((2 * cells, width))
            np.add.at(by, y * cells + cell, z)
            return np.concatenate([np.where(y == 1, -pull, pull) @ z, ((z * bends[y, cell][:, None]).T @ z).ravel(), by.ravel()])

        total = np.sum(_sums(self.rows, add), axis=0)
        pairs = self.n[0] * self.n[1]
        curve, by = total[width : width + width * width].reshape(width, width), total[width + width * width :].reshape(2, cells, width)
        crossed = by[1].T @ bend @ by[0]
        return total[:width] / pairs + 2 * self.ridge * w, (curve - crossed - crossed.T) / pairs + 2 * self.ridge * np.eye(width)


def fit(rows: DataFrame) -> Ranker:
    """rows: __x (features) and __y (labels 0 and 1) of all training rows, kept (cut), as every pass reads them."""
    none = np.zeros(len(FEATURES))

    def moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(y), y.sum()], x.sum(0)])

    total = np.sum([np.zeros(2 + len(none)), *_sums(rows, moments)], axis=0)
    n, ones = int(total[0]), int(total[1])
    mean = total[2:] / max(1, n)
    spread = np.sum([none, *_sums(rows, lambda x, y: ((x - mean) ** 2).sum(0))], axis=0)
    scale = np.sqrt(spread / max(1, n))
    scale = np.where(scale > 1e-9, scale, 1.0)
    if not 0 < ones < n:
        return Ranker(mean, scale, none, 0.0)
    pairs = AllPairs(rows, mean, scale, (n - ones, ones))
    w = newton(pairs.loss, pairs.slopes, len(none))
    scores = scored(rows, Ranker(mean, scale, w, 0.0), [], raw=True)
    # Half-way between the last of as many lowest scores as there are labels 0, and the next.
    found = percentiles(scores, [], "score", [(n - ones - 0.5) / (n - 1)], SORTED_IN_ONE).first()
    return Ranker(mean, scale, w, float(found["p"][0]))


def measured(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Key columns and __x, the features of every row."""
    return by_text(docs, lambda ts: pd.DataFrame({"__x": [features(t) for t in ts]}), "__x array<double>", keys, text)


def learn(rows: DataFrame, labels: DataFrame, label: str, usable: Column, id: str = "doc_id") -> Ranker:
    """rows: measured() with the id among its keys. All usable rows of labels(id, label) with a label 0 or 1 are learned from."""
    known = labels.where(usable).select(F.col(id), F.col(label).cast("int").alias("__y")).where(F.col("__y").isin(0, 1) & F.col(id).isNotNull())
    training = cut(rows.select(id, "__x").join(known, id).select("__x", F.col("__y").cast("long").alias("__y")), "training-rows")
    made = fit(training)
    drop_cuts(training)
    return made


def train(docs: DataFrame, labels: DataFrame, label: str, usable: Column, id: str = "doc_id", text: str = "text") -> Ranker:
    """A ranker of all labelled rows of docs(id, text)."""
    return learn(measured(docs, [id], text), labels, label, usable, id)


def classify(docs: DataFrame, labels: DataFrame, label: str, usable: Column, keys: list[str], at_threshold: float = 0.5, id: str = "doc_id", text: str = "text") -> DataFrame:
    """train() and score() in one: every text is measured once, and its features are kept for both."""
    rows = cut(measured(docs, [*dict.fromkeys([*keys, id])], text), "features")
    return scored(rows, learn(rows, labels, label, usable, id), keys, at_threshold)


def scored(rows: DataFrame, ranker: Ranker, keys: list[str], at_threshold: float = 0.5, raw: bool = False) -> DataFrame:
    """Key columns and score of measured() rows; raw: the weights' product itself."""
    picked = rows.select("__x", *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
    held = [f"__k{i}" for i in range(len(keys))]
    kinds = {f.name: to_arrow_type(f.dataType) for f in picked.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b)
                s = ranker.product(x) if raw else ranker.score(x, at_threshold)
                yield pa.RecordBatch.from_arrays([*[b.column(h).cast(kinds[h]) for h in held], pa.array(s, pa.float64())], names=[*held, "__score"])

    types = dict(picked.dtypes)
    out = picked.mapInArrow(run, ", ".join([*(f"{h} {types[h]}" for h in held), "__score double"]))
    return out.select(*[F.col(h).alias(k) for h, k in zip(held, keys, strict=True)], F.col("__score").alias("score"))


def score(docs: DataFrame, ranker: Ranker, keys: list[str], at_threshold: float = 0.5, text: str = "text") -> DataFrame:
    """Key columns and score; scores of at least at_threshold lie above the quantile."""
    make = lambda ts: pd.DataFrame({"score": ranker.score(np.array([features(t) for t in ts]), at_threshold)})
    return by_text(docs, make, "score double", keys, text)
