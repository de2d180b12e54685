"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source's rate is its share of the output over its share of the input. A row's count inverts the Poisson distribution
of that rate at a uniform number hashed from the seed and the row's id; the row is exploded by its count, and the copies are
shuffled globally by a hash of seed, id and copy. Equal seeds give equal results on any cluster, also after lost tasks.

Defined results: a null source is a source of its own; rows with one id get one count; a null text is a text without
bytes; texts of any length only count by their bytes; an empty table gives an empty table; all input columns are kept under their names, and
the added ones take the first free name of copy, _copy, ... and of shuffle_key, _shuffle_key, ... Names that begin with __mix are the library's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseries.llm.common import free_name

#: A rate is drawn as a sum of draws of rates up to this one, which keeps exp(-rate) far from zero.
PIECE = 16.0
#: Terms of a piece's distribution; beyond them lies less than 1e-16 of it.
TERMS = 80
#: Up to so many sources are broadcast (a few hundred bytes each); more are joined by a shuffle with salted keys.
BROADCAST_SOURCES = 10_000


def uniform(*parts: Column) -> Column:
    """In [0, 1), from the top 53 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


def poisson_cdf(rate: Column) -> Column:
    """The cumulative distribution at 0 .. TERMS-1 for a rate up to PIECE."""
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), (acc["sum"] + p).alias("sum"), F.concat(acc["all"], F.array(acc["sum"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), start, step, lambda acc: acc["all"])


def source_rates(df: DataFrame, weights: dict[str, float] | None, power: float, epochs: float, source: str, size: Column) -> DataFrame:
    """source, rate: target bytes over present bytes. weights names target shares; None takes sizes to a power below 1 (temperature)."""
    sizes = df.groupBy(F.col(f"`{source}`").alias("__mix_source")).agg(F.sum(size.cast("double")).alias("__mix_size"))
    if weights is None:
        target = F.pow("__mix_size", F.lit(power))
    else:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.create_map().cast("map<string,double>")
        target = F.coalesce(F.try_element_at(named, F.col("__mix_source")), F.lit(0.0))
    sizes = sizes.withColumn("__mix_target", target)
    every, wanted = sizes.agg(F.sum("__mix_size"), F.sum("__mix_target")).first()  # two numbers
    rate = F.lit(epochs * every / wanted if wanted else 0.0) * F.col("__mix_target") / F.col("__mix_size")
    return sizes.select("__mix_source", rate.alias("__mix_rate"))


def replicate(df: DataFrame, weights: dict[str, float] | None = None, power: float = 0.7, epochs: float = 1.0, seed: int = 42, id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """All columns plus copy (int, from 0) and shuffle_key (long): each row as often as its Poisson count says, in a global random order."""
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1
    rates = source_rates(df, weights, power, epochs, source, size)
    pieces = F.greatest(F.lit(1), F.ceil(F.col("__mix_rate") / PIECE).cast("int"))
    rates = rates.withColumn("__mix_pieces", pieces).withColumn("__mix_cdf", poisson_cdf(F.col("__mix_rate") / F.col("__mix_pieces")))
    key = F.col(f"`{source}`")
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        joined = df.join(F.broadcast(rates), key.eqNullSafe(F.col("__mix_source")))
    else:  # a hot source is spread over salted keys, its rate repeated for each
        salts = 64
        salted = rates.withColumn("__mix_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = df.withColumn("__mix_row_salt", F.pmod(F.xxhash64(F.col(f"`{id}`")), F.lit(salts)).cast("int")).join(salted, key.eqNullSafe(F.col("__mix_source")) & (F.col("__mix_row_salt") == F.col("__mix_salt"))).drop("__mix_row_salt", "__mix_salt")
    ident = F.col(f"`{id}`")
    draw = lambda piece: F.size(F.filter(F.col("__mix_cdf"), lambda c: c <= uniform(F.lit(seed), ident, piece)))
    count = F.aggregate(F.sequence(F.lit(1), F.col("__mix_pieces")), F.lit(0), lambda acc, piece: acc + draw(piece))
    counted = joined.withColumn("__mix_count", count).where("__mix_count > 0").drop("__mix_source", "__mix_rate", "__mix_pieces", "__mix_cdf")
    copy, order = free_name(df, "copy"), free_name(df, "shuffle_key")
    copies = counted.withColumn(copy, F.explode(F.sequence(F.lit(0), F.col("__mix_count") - 1))).drop("__mix_count")
    keyed = copies.withColumn(order, F.xxhash64(F.lit(seed + 1), ident, F.col(copy)))
    return keyed.repartition(F.col(order)).sortWithinPartitions(order)
