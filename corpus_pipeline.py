"""The training-data pipeline: STAGES applied to documents in turn, each stage's rows written as Parquet and read again by the next.

ORACLE_SQL is None: the near-duplicate, surrogate and BPE stages are not expressible in SQL; tests/llm hold each stage against a
plain version or its own operator's brute-force tests.

Defined results: null and empty texts fail the quality rules and go; a row with a null id is never a duplicate of another; of equal rows one
stays; a text of any length is read as a whole; extra columns, whatever their names, pass through all stages but the last; an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseries.functions.session import ship
from fieldseries.llm import bpe, mixing, pii, repetition, simhash
from fieldseries.llm.common import cut, set_aside, table
from fieldseries.llm.queries import TOKENIZER, pii_key


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the repetition rule keep."""
    ship(spark)
    return repetition.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    ship(spark)
    return simhash.one_of_each(docs).select(docs.columns)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; n_chars follows the new text."""
    own, names = set_aside(docs)
    made = pii.replace(own, pii_key(spark), names["text"])
    changed = F.when(F.col(made.columns[-1]) > 0, F.length(names["text"]).cast("long")).otherwise(F.col(names["n_chars"]))
    return made.withColumn(names["n_chars"], changed).select(own.columns).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate draws it, in a global random order."""
    own, names = set_aside(docs)
    return mixing.replicate(own, id=names["doc_id"], source=names["source"], text=names["text"]).select(own.columns).toDF(*docs.columns)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the text they decode to, of every document."""
    ship(spark)
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER), ["doc_id", "source"])


STAGES = [("quality rules", quality_rules), ("simhash near-dedup", near_duplicates), ("pii", surrogates), ("mixing sources", mix_sources), ("bpe encoding", bpe_encode)]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
