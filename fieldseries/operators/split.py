"""Spatial block split of parcels into train and test."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseries.functions.columns import half_even


def block_ids(parcels: DataFrame, size: float = 10_000.0, x: str = "cx", y: str = "cy") -> DataFrame:
    """"bx_by" by floor((c - min c) / size)."""
    low = parcels.agg(F.min(x).alias("x0"), F.min(y).alias("y0"))
    at = lambda c, lo: F.floor((F.col(c) - F.col(lo)) / size).cast("int")
    return parcels.crossJoin(F.broadcast(low)).withColumn("block_id", F.concat_ws("_", at(x, "x0"), at(y, "y0"))).drop("x0", "y0")  # one row


def block_split(blocked: DataFrame, id: str, ratio: float = 0.2, seed: int = 42) -> DataFrame:
    """Test blocks are drawn without replacement from the blocks in order of their first id.

    Blocks are bounded by the covered area (10 km squares), not by parcels: their list fits the driver.
    """
    blocks = [r["block_id"] for r in blocked.groupBy("block_id").agg(F.min(id).alias("first")).orderBy("first").collect()]
    chosen = np.random.default_rng(seed).choice(np.array(blocks, dtype=object), size=max(1, int(len(blocks) * ratio)), replace=False) if blocks else []
    test = blocked.sparkSession.createDataFrame([(str(b),) for b in chosen], "block_id string").withColumn("split", F.lit("test"))
    return blocked.join(F.broadcast(test), "block_id", "left").withColumn("split", F.coalesce("split", F.lit("train")))


def split_table(rows: DataFrame, classe: str = "classe") -> DataFrame:
    """Rows per class and split, total and share of test in percent."""
    made = rows.groupBy(classe).pivot("split", ["train", "test"]).count().na.fill(0, ["train", "test"])
    total = F.col("train") + F.col("test")
    return made.withColumn("total", total).withColumn("pct_test", half_even(100 * F.col("test") / total, 1)).orderBy(F.desc("total"), classe)
