"""The registered queries of this subpackage, each over its whole table, and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseries.functions.session import ship
from fieldseries.llm import bpe, importance, mixing, packing, passages, pii, ranking, repetition, sharding, simhash, sketches, spelling, toxicity
from fieldseries.llm.common import table

SHARDS = 8
#: The setting that holds the surrogates' key, and what tests use where it is unset.
PII_KEY, DEMO_KEY = "fieldseries.pii.key", "fieldseries-demo-key"
TOKENIZER, PACKED_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"


def op1_quality_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = repetition.quality(table(spark, sf_dir, "documents"), ["doc_id"])
    return made.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words")


def op2_best_fit_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return made.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def pii_key(spark: SparkSession) -> str:
    return spark.conf.get(PII_KEY, DEMO_KEY)


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents"), pii_key(spark)).select("doc_id", "text", "n_entities")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_invertible_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprint_versions(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), ["doc_id"], digests=True)


def op7_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = mixing.replicate(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "source", "copy", "shuffle_key", F.octet_length("text").alias("n_bytes"))


def _fold(parts: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))


def op8_toxicity_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", _fold(5) != 0)
    made = toxicity.score(docs, machine, ["doc_id"])
    return made.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_quality_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = ranking.classify(docs, table(spark, sf_dir, "labels"), "quality", _fold(4) != 2, ["doc_id"], at_threshold=0.7)
    return made.select("doc_id", (_fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_sparse_suffix_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKED_TOKENIZER), ["doc_id"], digests=True)
    return made.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return wraps(f)(lambda spark, sf_dir: f(ship(spark), sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: shipped(f) for f in (op1_quality_repetition, op2_best_fit_sharding, op3_surrogates, op4_simhash, op5_invertible_sketch, op6_bpe, op7_poisson_mixing, op8_toxicity_string_kernel, op9_quality_bradley_terry, op10_sparse_suffix_passages, op11_spelling_variants, op12_best_two_fit, op13_importance_resampling)}


def _windows(k: int, name: str) -> str:
    """The positions covered by k-word windows that a document has twice or more."""
    return f"""
    {name}_w AS (SELECT doc_id, i, hash(list_slice(w, i, i + {k - 1})) AS h FROM words, unnest(range(1, len(w) - {k - 2})) AS u(i) WHERE len(w) >= {k}),
    {name}_r AS (SELECT doc_id, i FROM {name}_w QUALIFY count(*) OVER (PARTITION BY doc_id, h) > 1),
    {name} AS (SELECT doc_id, count(DISTINCT j) AS n FROM {name}_r, unnest(range(i, i + {k})) AS u(j) GROUP BY doc_id)"""


OP1_SQL = rf"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    {_windows(8, "eight")}, {_windows(5, "five")}, {_windows(101, "long")},
    lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM words) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    made AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
        coalesce(eight.n, 0)::BIGINT AS n_repeat_words, coalesce(five.n, 0)::BIGINT AS covered_words, long.n IS NOT NULL AS too_long
        FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN eight USING (doc_id) LEFT JOIN five USING (doc_id) LEFT JOIN long USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND covered_words <= 0.3 * n_words AND NOT too_long AS kept, covered_words
FROM made"""


#: Windows of 50 words that stand at two or more places, united to spans.
OP10_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    win AS (SELECT doc_id, i, hash(list_slice(w, i, i + 49)) AS h FROM words, unnest(range(1, len(w) - 48)) AS u(i) WHERE len(w) >= 50),
    rep AS (SELECT doc_id, i - 1 AS a, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS earlier FROM win QUALIFY count(*) OVER (PARTITION BY h) > 1),
    seen AS (SELECT *, lag(a) OVER o AS last, max(CASE WHEN earlier THEN a + 50 END) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS past FROM rep WINDOW o AS (PARTITION BY doc_id ORDER BY a)),
    isl AS (SELECT *, sum(CASE WHEN last IS NULL OR a > last + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY a) AS island FROM seen)
SELECT doc_id, min(a)::BIGINT AS start_word, (max(a) + 50)::BIGINT AS end_word, sum(CASE WHEN earlier THEN a + 50 - greatest(a, coalesce(past, 0)) ELSE 0 END)::BIGINT AS earlier_words
FROM isl GROUP BY doc_id, island"""


#: The table of the byte-wise CRC-32, from its polynomial, and the checksum of a string of hexadecimal digits.
CRC = """crc_table AS (SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY b) AS steps FROM range(256) t(b))"""


def _crc(bytes_as_hex: str) -> str:
    octets = f"list_transform(range(0, length({bytes_as_hex}) // 2), lambda i: ('0x' || substr({bytes_as_hex}, 2 * i::BIGINT + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: One edit: a letter less in one word is the other word, or both agree but for one letter in the same place.
OP11_SQL = rf"""
WITH RECURSIVE {CRC},
    runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({LOWER.format('text')}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
    hashed AS (SELECT run, n, {_crc("hex(encode(doc_id || ':' || run))")} AS h FROM runs, crc_table),
    results AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
    words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
    cuts AS MATERIALIZED (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS less, substr(word, i + 1, 1) AS letter FROM words, unnest(range(0, length(word))) u(i)),
    pairs AS (SELECT DISTINCT c.word AS a, w.word AS b FROM cuts c JOIN words w ON w.word = c.less UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.less
        UNION SELECT c.word, d.word FROM cuts c JOIN cuts d ON c.less = d.less AND c.i = d.i AND c.letter <> d.letter),
    best AS (SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, b) AS b, max(n) AS b_n FROM pairs JOIN words ON word = b GROUP BY a),
    placed AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN b_n >= 5 * n THEN b END AS form, CASE WHEN b_n >= 5 * n THEN b_n END AS form_n FROM words LEFT JOIN best ON a = word),
    chain AS (SELECT word, word AS root, form FROM placed UNION ALL SELECT c.word, p.word, p.form FROM chain c JOIN placed p ON p.word = c.form)
SELECT word, form, root, n, n_near, form_n FROM placed JOIN (SELECT word, root FROM chain WHERE form IS NULL) USING (word)"""

OP13_SQL = rf"""
WITH {CRC},
    source AS (SELECT doc_id, unnest(regexp_extract_all({LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
    target AS (SELECT unnest(regexp_extract_all({LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
    buckets AS MATERIALIZED (SELECT w, {_crc("hex(encode(w))")} % 10000 AS b FROM (SELECT w FROM source UNION SELECT w FROM target), crc_table),
    counted AS (SELECT b, (SELECT count(*) FROM source) AS all_s, (SELECT count(*) FROM target) AS all_t, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM (SELECT DISTINCT b FROM buckets)
        LEFT JOIN (SELECT b, count(*) AS s FROM source JOIN buckets USING (w) GROUP BY b) USING (b) LEFT JOIN (SELECT b, count(*) AS t FROM target JOIN buckets USING (w) GROUP BY b) USING (b)),
    gain AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS g FROM counted),
    weighed AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight FROM (SELECT doc_id FROM documents) LEFT JOIN
        (SELECT doc_id, count(*) AS n_features, floor(sum(g) / count(*))::BIGINT AS weight FROM source JOIN buckets USING (w) JOIN gain USING (b) GROUP BY doc_id) USING (doc_id)),
    scored AS (SELECT *, weight + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM weighed),
    drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN drawn USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op11_spelling_variants": OP11_SQL, "op13_importance_resampling": OP13_SQL, "op1_quality_repetition": OP1_SQL, "op10_sparse_suffix_passages": OP10_SQL}
