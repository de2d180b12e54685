"""Coverage-aware imputation of monthly features, by windows over each series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def qc_action(pct: Column, threshold: float = 0.50) -> Column:
    """Exclure at 0, imputer below the threshold (on the scale of the percentage), else conserver; a missing share is conserver."""
    return F.when(pct == 0, "exclure").when(pct < threshold, "imputer").otherwise("conserver")


def on_calendar(cells: DataFrame, id: str, months: list[str] | None = None) -> DataFrame:
    """Every id with every month (default: those of the table, at most a calendar's) and its position; a cell that is not there has nulls.

    An id's cells come together in one map, so one shuffle serves this and the windows behind it; a repeated month of an id raises.
    """
    if months is None:
        months = sorted(r["mois"] for r in cells.select("mois").distinct().collect())
    rest = [c for c in cells.columns if c not in (id, "mois")]
    held = cells.groupBy(id).agg(F.map_from_entries(F.collect_list(F.struct("mois", F.struct(*rest).alias("c")))).alias("__m"))
    every = held.select(id, "__m", F.posexplode(F.array(*map(F.lit, months)).cast("array<string>")).alias("pos", "mois"))
    return every.select(id, "mois", "pos", *[F.try_element_at("__m", F.col("mois"))[c].alias(c) for c in rest])


def anchors(actions: DataFrame, id: str, months: list[str] | None = None) -> DataFrame:
    """For cells to impute, the distance in months to the nearest cell on either side that is not exclure (a missing cell is none).

    Those with no such neighbour within one month become exclure. Other columns than the action pass through.
    """
    full = on_calendar(actions, id, months)
    usable = F.when(F.col("action").isNull() | (F.col("action") != "exclure"), F.col("pos"))
    w = Window.partitionBy(id).orderBy("pos")
    left = F.col("pos") - F.last(usable, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    right = F.first(usable, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)) - F.col("pos")
    made = full.withColumn("gauche", left).withColumn("droite", right).withColumn("dist_min", F.least("gauche", "droite"))
    far = (F.col("action") == "imputer") & (F.col("dist_min").isNull() | (F.col("dist_min") > 1))
    return made.withColumn("action", F.when(far, "exclure").otherwise(F.col("action")))


def interpolate(cells: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Linear between the neighbours by position, constant beyond the ends; adds `filled`."""
    w = Window.partitionBy(*keys).orderBy("pos")
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("pos").alias("p"), F.col(value).alias("v")))
    before = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    line = F.col("b.v") + (F.col("a.v") - F.col("b.v")) * (F.col("pos") - F.col("b.p")) / F.nullif(F.col("a.p") - F.col("b.p"), F.lit(0))
    made = cells.withColumn("b", before).withColumn("a", after)
    return made.withColumn("filled", F.coalesce(F.col(value), line, F.col("b.v"), F.col("a.v"))).drop("a", "b")


def impute(cells: DataFrame, id: str, variables: list[str], months: list[str] | None = None, force: bool = False) -> DataFrame:
    """cells(id, mois, action, one column for each variable) -> id, variable, mois, action, value. Missing values of cells whose action stays imputer
    are interpolated from all values of their series; others stay. force also replaces values that are there, from the others."""
    out = anchors(cells, id, months).select(id, "mois", "pos", "action", *variables)
    for v in variables:
        own = f"__own_{v}"
        donor = F.when(F.lit(not force) | (F.coalesce(F.col("action"), F.lit("")) != "imputer"), F.col(v))
        out = interpolate(out.withColumn(own, F.col(v)).withColumn(v, donor), [id], v)
        out = out.withColumn(v, F.when(F.col("action") == "imputer", F.col("filled")).otherwise(F.col(own))).drop("filled", own)
    return out.select(id, "mois", "action", F.inline(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("value")) for v in variables])))
