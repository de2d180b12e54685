"""Importance resampling towards a target distribution, on hashed runs of words.

Each chunk of texts inside a task becomes one sequence of word ids, a separator after every text, and its suffixes are sorted as far as
the longest run asked for. Neighbours in that order give the longest common prefixes; a stretch of neighbours that share k words or more
is one distinct run of k words, so its text is hashed once and the bucket goes to all of its places. The source's and the target's bucket counts
give each bucket a gain, a document weighs the floored mean of its runs' gains, and the highest weights with seeded Gumbel noise are drawn.

Defined results: a null text has no words; documents without runs weigh 0; a null id gets no noise and is never drawn; repeated rows are drawn as rows of
their own, in adjoining ranks; texts of any length are read whole; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseries.llm.common import chunks, cut
from fieldseries.operators.ranks import ranked

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SEPARATOR = 0


def suffixes(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared) of the suffixes of a sequence, compared by at most depth words: order sorts them, shared[i] counts the words that suffix order[i] has in
    common with the one before, up to depth. Prefixes double in each round, as rank pairs."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    sorted_ids = ids[order]
    rank[order] = np.cumsum(np.r_[0, sorted_ids[1:] != sorted_ids[:-1]])
    known = 1
    while known < depth:
        step = min(known, depth - known)
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        order = np.lexsort((after, rank))
        a, b = rank[order], after[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.r_[0, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        rank, known = fresh, known + step
    shared = np.zeros(n, np.int64)
    alive = np.arange(1, n)
    for k in range(depth):  # the common prefix of neighbours, word by word
        p, q = order[alive - 1] + k, order[alive] + k
        inside = (p < n) & (q < n)
        alive, p, q = alive[inside], p[inside], q[inside]
        alive = alive[ids[p] == ids[q]]
        shared[alive] = k + 1
    return order, shared


def run_buckets(texts: list[str | None], longest: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every run, runs of each text, words of each text) of a chunk of texts. A text's runs lie together."""
    find = re.compile(WORDS).findall
    index: dict[str, int] = {}
    number = index.setdefault
    lists = [find(t.translate(LOWER)) if t else [] for t in texts]
    n_words = np.array([len(x) for x in lists], np.int64)
    ids = np.zeros(int(n_words.sum()) + len(lists), np.int64)
    at = 0
    for x in lists:
        ids[at : at + len(x)] = [number(w, len(index) + 1) for w in x]
        at += len(x) + 1  # the separator stays
    names = ["", *index]
    text_of = np.repeat(np.arange(len(lists)), n_words + 1)
    order, shared = suffixes(ids, longest)
    to_separator = np.flatnonzero(ids == SEPARATOR)[text_of] - np.arange(len(ids)) if len(ids) else ids  # words from a place to its text's end
    found, owner = [], []
    for k in range(1, longest + 1):
        whole = to_separator[order] >= k  # places where a run of k words fits; equal runs fit alike
        starts = shared < k
        heads = order[starts & whole]
        hashed = np.fromiter((zlib.crc32(" ".join([names[i] for i in ids[p : p + k]]).encode()) % buckets for p in heads.tolist()), np.int64, len(heads))
        group = np.cumsum((starts & whole)[whole]) - 1
        places = order[whole]
        scattered = np.empty(len(ids), np.int64)
        scattered[places] = hashed[group] if len(places) else 0
        fits = np.flatnonzero(to_separator >= k)
        found.append(scattered[fits])
        owner.append(text_of[fits])
    owner_all, found_all = np.concatenate(owner), np.concatenate(found)
    if longest > 1:
        by = np.argsort(owner_all, kind="stable")
        owner_all, found_all = owner_all[by], found_all[by]
    return found_all, np.bincount(owner_all, minlength=len(lists)), n_words


def bucket_counts(df: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts: each task adds up its own, so no more than buckets rows leave it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for start, n in chunks(texts):
                total += np.bincount(run_buckets(texts.slice(start, n).to_pylist(), longest, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return df.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t+1) (S+B)) / ((s+1) (T+B)))) of each of the B buckets."""
    b = len(source)
    big_s, big_t = float(source.sum()) + b, float(target.sum()) + b
    return np.array([math.floor(1000 * math.log((float(t) + 1) * big_s / ((float(s) + 1) * big_t))) for s, t in zip(source, target, strict=True)], np.int64)


def occurrences(df: DataFrame, id: str = "doc_id", text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """id, n_words, runs: the bucket of every run of a document, as 16-bit numbers end to end where buckets allow, else 32-bit ones."""
    kind = "<u2" if buckets <= 2**16 else "<u4"
    picked = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for start, n in chunks(texts):
                found, counts, n_words = run_buckets(texts.slice(start, n).to_pylist(), longest, buckets)
                ends = np.cumsum(counts)
                rows = [found[a:b].astype(kind).tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(start, n), pa.array(n_words), pa.array(rows, pa.binary())], names=["id", "n_words", "runs"])

    return picked.mapInArrow(run, f"id {dict(picked.dtypes)['id']}, n_words long, runs binary")


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """id, n_words, n_features, weight from occurrences(): the floored mean of the gains, 0 without any."""
    kind = "<u2" if len(gain) <= 2**16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [np.frombuffer(x, kind) for x in batch.column("runs").to_pylist()]
            made = [(len(r), int(gain[r].sum()) // len(r) if len(r) else 0) for r in runs]
            n, w = zip(*made, strict=True) if made else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), pa.array(n, pa.int64()), pa.array(w, pa.int64())], names=["id", "n_words", "n_features", "weight"])

    return found.mapInArrow(run, f"id {dict(found.dtypes)['id']}, n_words long, n_features long, weight long")


def _count_sum(found: DataFrame, buckets: int) -> np.ndarray:
    """The bucket counts of occurrences(), added up a task at a time."""
    kind = "<u2" if buckets <= 2**16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(x, kind), minlength=buckets) if len(x) > 20_000 else 0
            total += np.bincount(np.frombuffer(b"".join(x for x in batch.column(0).to_pylist() if len(x) <= 20_000), kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return _dense(found.select("runs").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")), buckets)


def _dense(counts: DataFrame, buckets: int) -> np.ndarray:
    """At most one row a bucket comes to the driver."""
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():
        out[r["bucket"]] = r["n"]
    return out


def resample(df: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """id, n_features, weight, score, rank of every document; rank is null for those not drawn. percent of the documents of least_words or more are drawn."""
    found = cut(occurrences(df, id, text, longest, buckets), "runs")
    gain = gains(_count_sum(found, buckets), _dense(bucket_counts(target, target_text, longest, buckets), buckets))
    made = weights(found, gain)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = cut(made.withColumn("score", F.col("weight") + noise), "scores")
    able = F.coalesce((F.col("n_words") >= least_words) & F.col("score").isNotNull(), F.lit(False))
    # Scores are whole numbers between bounds that the gains set, so their histogram is small at any size.
    levels = sorted(((r["score"], r["count"]) for r in scored.where(able).groupBy("score").count().collect()), reverse=True)
    wanted = percent * scored.where(F.col("n_words") >= least_words).count() // 100
    bar, have = math.inf, 0
    for score, n in levels:
        if have >= wanted:
            break
        bar, have = score, have + n
    inside = able & (F.col("score") >= F.lit(float(bar)))
    drawn = ranked(scored.where(inside), [F.desc("score"), F.asc("id")], "rank", lambda x: cut(x, "ranked"))
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = scored.where(~inside).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select(F.col("id").alias(id), "n_features", "weight", "score", "rank")
