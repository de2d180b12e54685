"""Feature tables: wide and long forms, missing values, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseries.functions.columns import half_even
from fieldseries.operators import ranks


def wide(stats: DataFrame, id: str, columns: list[str], variables: list[str], months: list[str]) -> DataFrame:
    """One column {variable}_{stat}_{month} for every combination of an explicit list; a repeated key raises.

    Only the wanted cells are kept, and Spark's pivot puts each into its place of one buffer an id. A table that is partitioned by the id
    already is not shuffled again.
    """
    key = F.concat_ws("|", "variable", "mois")
    wanted = [f"{v}|{m}" for v in variables for m in months]
    cells = stats.where(F.col("variable").isin(variables) & F.col("mois").isin(months))
    single = cells.groupBy(id, key.alias("__key")).agg(*[F.first(c).alias(c) for c in columns], F.count("*").alias("__n"))
    single = single.where(F.assert_true(F.col("__n") == 1, F.lit("two rows have one key")).isNull())
    made = single.groupBy(id).pivot("__key", wanted).agg(*[F.first(c, ignorenulls=True).alias(f"__{c}") for c in columns])
    name = (lambda v, s, m: f"{v}|{m}___{s}") if len(columns) > 1 else (lambda v, s, m: f"{v}|{m}")
    return made.select(id, *[F.col(f"`{name(v, s, m)}`").alias(f"{v}_{s}_{m}") for v in variables for s in columns for m in months])


def wide_by_month(stats: DataFrame, id: str, columns: list[str], variables: list[str]) -> DataFrame:
    """One row per id and month with a column {variable}_{stat} for each combination: the form that imputation works on."""
    made = {f"{v}_{s}": F.first(F.when(F.col("variable") == v, F.col(s)), ignorenulls=True) for v in variables for s in columns}
    return stats.groupBy(id, "mois").agg(*[c.alias(n) for n, c in made.items()])


def long(table: DataFrame, id: str, features: list[str]) -> DataFrame:
    """One row per id and feature."""
    return table.unpivot([id], features, "feature", "value")


def missing_by_month(features: DataFrame) -> DataFrame:
    """Missing values per month suffix of the feature name: count, and percent of the month's cells."""
    gone = F.col("value").isNull()
    return features.groupBy(F.substring_index("feature", "_", -1).alias("mois")).agg(F.count_if(gone).alias("n_nan"), half_even(100 * F.avg(gone.cast("int")), 2).alias("pct_nan"))


def missing_total(features: DataFrame) -> DataFrame:
    """Missing cells of the whole table and their share in percent, in one row."""
    gone = F.col("value").isNull()
    return features.agg(F.count("*").alias("n"), F.count_if(gone).alias("n_nan"), half_even(100 * F.avg(gone.cast("int")), 2).alias("pct_nan"))


def action_table(actions: DataFrame) -> DataFrame:
    """Months by action."""
    return actions.groupBy("mois").pivot("action", ["conserver", "imputer", "exclure"]).count().na.fill(0, ["conserver", "imputer", "exclure"])


def describe(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, sample std, minimum, quartiles and maximum, rounded to 3 digits, in one row."""
    one = df.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    one = one.join(ranks.percentiles(df, [], value, [0.25, 0.5, 0.75]).select(F.col("p").alias("q")), how="left")  # a row each, or none
    return one.select("n", *[half_even(F.col(c), 3).alias(c) for c in ("mean", "std", "min", "max")], *[half_even(F.get("q", F.lit(i)), 3).alias(f"q{p}") for i, p in enumerate((25, 50, 75))])


def top_shares(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The most frequent values with their share of all rows in percent."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return counts.orderBy(F.desc("n"), column).limit(n).crossJoin(F.broadcast(total)).select(column, "n", half_even(100 * F.col("n") / F.col("total"), 1).alias("pct"))  # one row


def season_shape(obs: DataFrame, id: str, date: str, value: str) -> DataFrame:
    """Amplitude and the first date of the maximum."""
    known = obs.where(F.col(value).isNotNull())
    return known.groupBy(id).agg((F.max(value) - F.min(value)).alias("amplitude"), F.min_by(date, F.struct(-F.col(value), F.col(date))).alias("date_max"))


def season_slope(obs: DataFrame, id: str, date: str, value: str, first: str, last: str) -> DataFrame:
    """The rise of the value from the month of `first` to that of `last`, by day between the two dates; null where a month is missing."""
    in_month = lambda d: F.avg(F.when(F.trunc(date, "month") == F.trunc(F.lit(d).cast("date"), "month"), F.col(value)))
    days = F.datediff(F.lit(last).cast("date"), F.lit(first).cast("date"))
    return obs.groupBy(id).agg(((in_month(last) - in_month(first)) / days).alias("pente"))


def season_table(obs: DataFrame, id: str, date: str, value: str, first: str, last: str) -> DataFrame:
    """Amplitude, first date of the maximum and slope of every id."""
    return season_shape(obs, id, date, value).join(season_slope(obs, id, date, value, first, last), id, "left")
