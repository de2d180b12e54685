"""Season dates from smoothed series, by higher-order functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# First and last day of a class's season, counted from the grid's start; other classes have no window.
WINDOWS = {"cereales_hiver": (40, 400), "colza": (5, 380), "mais": (230, 470), "betterave": (170, 475), "lin": (180, 380), "legumes_fleurs": (200, 450)}


def seasons(series: DataFrame, start: str, classe: str = "classe", y: str = "z", step: int = 5, fraction: float = 0.20) -> DataFrame:
    """Sos, pos and eos dates, length, flags of dates at the edge, and fiable (no flag set).

    The peak is the first maximum inside the class's window; start and end are the last point before it, and the first after it, at or below
    a fraction of the rise on that side. Without a season all dates are null and the flags false.
    """
    case = " ".join(f"when {classe} = '{c}' then day between {lo} and {hi}" for c, (lo, hi) in WINDOWS.items())
    points = f"filter(transform({y}, (v, i) -> named_struct('i', i, 'day', i * {step}, 'v', v)), p -> p.v is not null and not isnan(p.v) and (case {case.replace('day', 'p.day')} else true end))"
    work = series.withColumn("pts", F.expr(points)).withColumn("top", F.expr("array_max(transform(pts, p -> p.v))"))
    work = work.withColumn("pos", F.expr("get(filter(pts, p -> p.v = top), 0)"))
    work = work.withColumn("left", F.expr("filter(pts, p -> p.i <= pos.i)")).withColumn("right", F.expr("filter(pts, p -> p.i >= pos.i)"))
    work = work.withColumn("lo_l", F.expr("array_min(transform(left, p -> p.v))")).withColumn("lo_r", F.expr("array_min(transform(right, p -> p.v))"))
    work = work.withColumn("thr_l", F.expr(f"if(top > lo_l, lo_l + {fraction} * (top - lo_l), top)")).withColumn("thr_r", F.expr(f"if(top > lo_r, lo_r + {fraction} * (top - lo_r), top)"))
    work = work.withColumn("has", F.expr("coalesce(top > lo_l or top > lo_r, false)"))
    work = work.withColumn("sos", F.expr("coalesce(get(reverse(filter(left, p -> p.v <= thr_l)), 0), get(pts, 0))")).withColumn("eos", F.expr("coalesce(get(filter(right, p -> p.v <= thr_r), 0), get(reverse(pts), 0))"))
    date = lambda p: F.when(F.col("has"), F.date_add(F.lit(start).cast("date"), F.col(f"{p}.day"))).alias(f"{p}_date")
    edge = {"sos": "sos.i <= get(pts, 0).i + 1", "eos": "eos.i >= get(reverse(pts), 0).i - 1", "pos": "pos.i <= get(pts, 0).i + 1 or pos.i >= get(reverse(pts), 0).i - 1"}
    flag = {k: F.coalesce(F.col("has") & F.expr(e), F.lit(False)) for k, e in edge.items()}
    keep = [c for c in series.columns if c != y]
    return work.select(*keep, date("sos"), date("pos"), date("eos"), F.expr("if(has, eos.day - sos.day, null)").alias("los_jours"), *[v.alias(f"{k}_en_bord") for k, v in flag.items()], (~(flag["sos"] | flag["eos"] | flag["pos"])).alias("fiable"))


def class_summary(seasons_: DataFrame, classe: str = "classe") -> DataFrame:
    """Medians of dates (as days of the epoch) and length, and shares of all flags, per class."""
    days = {c: F.median(F.unix_date(f"{c}_date")).alias(f"{c}_mediane") for c in ("sos", "pos", "eos")}
    return seasons_.groupBy(classe).agg(*days.values(), F.median("los_jours").alias("los_mediane"), *[F.avg(F.col(c).cast("int")).alias(f"taux_{c}") for c in ("sos_en_bord", "pos_en_bord", "eos_en_bord", "fiable")])
