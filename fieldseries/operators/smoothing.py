"""Regular series from dated observations, and Whittaker smoothing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseries.functions.session import ship


def weighted_bins(obs: DataFrame, id: str, date: str = "date", value: str = "ndvi", weight: str = "n_pixels", step: int = 5) -> DataFrame:
    """Observations on the next point of a grid from the first date of all, the last point taking what lies beyond; weighted means."""
    bounds = obs.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    days = F.datediff(date, "lo")
    last = F.floor(F.datediff("hi", "lo") / step)
    placed = obs.crossJoin(F.broadcast(bounds)).withColumn("idx", F.least(F.ceil(days / step), last).cast("int"))  # one row
    sums = placed.groupBy(id, "idx").agg(F.sum(F.col(value) * F.col(weight)).alias("s"), F.sum(weight).alias("w"))
    return sums.select(id, "idx", F.try_divide("s", "w").alias("v"), F.col("w").cast("double").alias("w"))


def dense_series(bins: DataFrame, ids: DataFrame, id: str, n: int) -> DataFrame:
    """Per id of the reference set the arrays y and w over 0..n-1, 0 where nothing was seen."""
    packed = bins.groupBy(id).agg(F.map_from_entries(F.collect_list(F.struct("idx", F.struct("v", "w")))).alias("m"))  # at most n entries
    at = lambda part: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.try_element_at(F.col("m"), i)[part], F.lit(0.0)))
    return ids.select(id).distinct().join(packed, id, "left").select(id, at("v").alias("y"), at("w").alias("w"))


def smooth_rows(y: np.ndarray, w: np.ndarray, penalty: float = 800.0, ridge: float = 1e-6, least: int = 2) -> np.ndarray:
    """(W + penalty D'D + ridge I) z = W y for every row at once, D being second differences: a banded LDL' factorization. Rows of fewer than `least` weighted points are NaN."""
    rows, n = y.shape
    if n < 3:
        raise ValueError("second differences need three points")
    d2 = np.diff(np.eye(n), 2, axis=0)
    full = penalty * d2.T @ d2
    diag, one, two = w + np.diag(full) + ridge, np.r_[np.diag(full, 1), 0.0], np.r_[np.diag(full, 2), 0.0, 0.0]
    d, e, f = np.zeros((rows, n)), np.zeros((rows, n)), np.zeros((rows, n))
    z = w * y
    for i in range(n):
        d[:, i] = diag[:, i]
        if i:
            d[:, i] -= e[:, i - 1] ** 2 * d[:, i - 1]
            z[:, i] -= e[:, i - 1] * z[:, i - 1]
        if i > 1:
            d[:, i] -= f[:, i - 2] ** 2 * d[:, i - 2]
            z[:, i] -= f[:, i - 2] * z[:, i - 2]
        cross = e[:, i - 1] * f[:, i - 1] * d[:, i - 1] if i else 0.0
        e[:, i] = (one[i] - cross) / d[:, i]
        f[:, i] = two[i] / d[:, i]
    z /= d
    for i in range(n - 2, -1, -1):
        z[:, i] -= e[:, i] * z[:, i + 1] + (f[:, i] * z[:, i + 2] if i + 2 < n else 0.0)
    z[(w > 0).sum(1) < least] = np.nan
    return z


#: Fixed value: the weight of the second differences.
PENALTY = 800.0


def whittaker(series: DataFrame, id: str, penalty: float = PENALTY) -> DataFrame:
    """Id, z (null if fewer than two points have weight): every batch of rows is solved at once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                z = smooth_rows(np.stack(pdf["y"].tolist()).astype(float), np.stack(pdf["w"].tolist()).astype(float), penalty)
                yield pd.DataFrame({id: pdf[id], "z": [None if np.isnan(r[0]) else r for r in z]})

    ship(series.sparkSession)
    return series.select(id, "y", "w").mapInPandas(run, f"{id} {dict(series.dtypes)[id]}, z array<double>")
