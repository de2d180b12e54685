"""Repeated passages by sparse suffix arrays.

A passage is a run of `least` words (whole tokens, case and punctuation included) that stands at two or more places of the
corpus. Of all suffixes only those at minimisers are retained: in every window of `least` words the leftmost k-word
sequence with the least hash, which content alone selects, so equal windows retain equal suffixes. Each carries the run of windows
it stands for. The suffixes are sorted by their first k words and then by all words of their windows, and neighbours
compared: one without an equal neighbour stands for no repeat, one equal over all its words repeats as a whole (the first
stands for all such), and for the others the match is extended left and right word by word: every window that holds
the shared words is sorted and compared with its neighbours. Spans are the union of the repeated windows, so the result is exact
(up to collisions of 64-bit hashes) and no group of copies is expanded into pairs.

Both sorts deal rows out by ranges of all their columns, so a passage that many documents hold spreads over tasks; a
suffix at a task's edge is extended instead of being judged there, a window there is judged in a pass over all edges.

Defined results: null, empty and shorter texts have no passage; rows with one id and one text are one document; a
null id is an id of its own, before all others; an empty table gives an empty table; extra columns are not read by the search and kept by the removal.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldseries.llm.common import CHUNK_BYTES, WORD_CLASS, cut, drop_cut, set_aside

#: Words of the sequence whose hash selects a suffix; a passage of L words has L - K + 1 of them.
K = 24
#: An odd number to the powers of which words are multiplied.
BASE = 0x9E3779B97F4A7C15
#: A task forgets its words when it holds more than so many; this bounds memory, not results.
MOST_WORDS = 600_000
#: Stands for a null id.
NO_ID = -(2**63)
SUFFIX = "h long, c long, id long, t int, a int, n int"
WHOLE, FIRST, PART = 1, 2, 3


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sequences:
    """Hashes of word sequences of a chunk of texts, from prefix sums modulo 2^64."""

    def __init__(self) -> None:
        self.index: defaultdict[bytes, int] = defaultdict()
        self.values = np.zeros(0, np.uint64)
        self.powers = self.inverse = np.ones(1, np.uint64)
        self.clear()

    def clear(self) -> None:
        self.index = defaultdict()
        self.index.default_factory = self.index.__len__
        self.values = np.zeros(0, np.uint64)

    def read(self, texts: list[str | None]) -> None:
        if len(self.index) > MOST_WORDS:
            self.clear()
        docs = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        self.counts = np.array([len(d) for d in docs], np.int64)
        number = self.index.__getitem__
        words = np.fromiter((number(w) for d in docs for w in d), np.int64, self.counts.sum())
        new = list(self.index)[len(self.values) :]
        self.values = np.concatenate([self.values, np.array([xxhash.xxh64_intdigest(w, 7) for w in new], np.uint64)])
        if len(words) >= len(self.powers):
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(2 * len(words), BASE, np.uint64)])
            self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(2 * len(words), pow(BASE, -1, 2**64), np.uint64)])
        self.sums = np.r_[np.uint64(0), np.cumsum(self.values[words] * self.powers[: len(words)])]
        self.starts = np.cumsum(self.counts) - self.counts

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def suffixes(s: Sequences, least: int) -> tuple[np.ndarray, ...]:
    """(h, c, document, a, n) of each retained suffix: the hashes of its k words and of all words of its windows, which are the n from word a on."""
    doc = np.repeat(np.arange(len(s.counts)), s.counts)
    k, last = min(K, least), len(doc) - least + 1
    if last < 1:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    at = np.arange(len(doc) - k + 1)
    h = s.hash(at, at + k)
    best, place = h[:last].copy(), np.zeros(last, np.int64)
    for j in range(1, least - k + 1):
        other = h[j : j + last]
        less = other < best
        best[less] = other[less]
        place[less] = j
    window = np.flatnonzero(doc[:last] == doc[least - 1 :])
    place = window + place[window]
    new = np.r_[True, (window[1:] != window[:-1] + 1) | (place[1:] != place[:-1])] if len(window) else np.zeros(0, bool)
    first, n = window[new], np.diff(np.r_[np.flatnonzero(new), len(window)])
    place = place[new]
    c = mix(s.hash(first, first + n + least - 1) + (place - first).astype(np.uint64) * np.uint64(1024) + n.astype(np.uint64))
    d = doc[first]
    return h[place].view(np.int64), c.view(np.int64), d, first - s.starts[d], n


def chunks(pdf: pd.DataFrame) -> Iterator[slice]:
    """Rows of a batch in runs of a bounded number of characters."""
    start = size = 0
    for i, t in enumerate(pdf["text"]):
        size += len(t or "")
        if size >= CHUNK_BYTES or i + 1 == len(pdf):
            yield slice(start, i + 1)
            start, size = i + 1, 0


def with_neighbours(frames: Iterator[pd.DataFrame], names: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool, bool]]:
    """(rows, row before, row after, is first, is last) of sorted rows without repeats; at a task's ends the neighbour is the row itself."""
    held: np.ndarray | None = None
    before: np.ndarray | None = None
    for pdf in frames:
        if not len(pdf):
            continue
        rows = np.stack([pdf[c].to_numpy(np.int64) for c in names])
        if held is not None:
            rows = np.concatenate([held, rows], 1)
        fresh = np.r_[True, (rows[:, 1:] != rows[:, :-1]).any(0)]
        rows = rows[:, fresh]
        if rows.shape[1] > 1:
            yield rows[:, :-1], rows[:, :1] if before is None else before, rows[:, -1:], before is None, False
            before = rows[:, -2:-1]
        held = rows[:, -1:]
    if held is not None:
        yield held, held if before is None else before, held, before is None, True


def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted suffixes -> those that may repeat, with what their neighbours say: WHOLE, FIRST of such, or PART."""
    for rows, before, after, first, last in with_neighbours(frames, ["h", "c", "id", "t", "a", "n"]):
        h, c = np.c_[before, rows, after][:2]
        same_h = h[1:] == h[:-1]
        same = same_h & (c[1:] == c[:-1])
        if first:
            same_h[0], same[0] = True, False
        if last:
            same_h[-1], same[-1] = True, False
        state = np.where(same[:-1], WHOLE, np.where(same[1:], FIRST, np.where(same_h[:-1] | same_h[1:], PART, 0)))
        on = state > 0
        yield pd.DataFrame({"id": rows[2, on], "t": rows[3, on].astype(np.int32), "a": rows[4, on].astype(np.int32), "n": rows[5, on].astype(np.int32), "state": state[on].astype(np.int32)})


def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted windows -> the repeated ones; earlier: one before it in the order of documents is equal. Those at a task's ends have edge set."""
    for rows, before, after, first, last in with_neighbours(frames, ["h", "id", "t", "a", "known"]):
        h = np.c_[before, rows, after][0]
        same = h[1:] == h[:-1]
        if first:
            same[0] = False
        if last:
            same[-1] = False
        edge = np.zeros(rows.shape[1], bool)
        edge[0] |= first
        edge[-1] |= last
        on = same[:-1] | same[1:] | (rows[4] > 0) | edge
        yield pd.DataFrame({"id": rows[1, on], "t": rows[2, on].astype(np.int32), "a": rows[3, on].astype(np.int32), "repeated": (same[:-1] | same[1:] | (rows[4] > 0))[on], "earlier": same[:-1][on], "edge": pd.arrays.IntegerArray(rows[0, on], ~edge[on])})


def checksum(body: Column) -> Column:
    return (F.crc32(F.coalesce(body, F.lit("")).cast("binary")) - 2**31).cast("int")


def identified(df: DataFrame, id: str, text: str) -> DataFrame:
    body = F.col(f"`{text}`")
    return df.select(F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(NO_ID)).alias("id"), checksum(body).alias("t"), body.alias("text"))


def windows(df: DataFrame, id: str = "doc_id", text: str = "text", least: int = 50) -> DataFrame:
    """(id, t, a, n, earlier): runs of n repeated windows from word a of the document (id, checksum t of its text)."""
    if not 1 <= least <= K + 200:
        raise ValueError(f"passages of 1 to {K + 200} words are searched for")
    docs = identified(df, id, text)

    def retain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Sequences()
        for pdf in frames:
            for at in chunks(pdf):
                part = pdf.iloc[at]
                s.read(part["text"].tolist())
                h, c, d, a, n = suffixes(s, least)
                yield pd.DataFrame({"h": h, "c": c, "id": part["id"].to_numpy()[d], "t": part["t"].to_numpy()[d], "a": a.astype(np.int32), "n": n.astype(np.int32)})

    sparse = cut(docs.where(F.length("text") >= 2 * least - 1).mapInPandas(retain, SUFFIX), "suffixes")
    marked = cut(sparse.repartitionByRange("h", "c", "id", "t", "a").sortWithinPartitions("h", "c", "id", "t", "a").mapInPandas(compare, "id long, t int, a int, n int, state int"), "marked")
    drop_cut(sparse)
    packed = F.col("a").cast("long") * 1024 + F.col("n") * 4 + F.col("state")
    open = marked.where(F.col("state") != WHOLE).groupBy("id", "t").agg(F.collect_list(packed).alias("runs"))  # of one document

    def extend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Sequences()
        for pdf in frames:
            for at in chunks(pdf):
                part = pdf.iloc[at]
                s.read(part["text"].tolist())
                runs = part["runs"].tolist()
                d = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
                run = np.concatenate(runs).astype(np.int64)
                a, n, state = run // 1024, run // 4 % 256, run % 4
                each = np.repeat(np.arange(len(run)), n)
                inside = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                a, d, known = a[each] + inside, d[each], state[each] == FIRST
                start = s.starts[d] + a
                yield pd.DataFrame({"h": s.hash(start, start + least).view(np.int64), "id": part["id"].to_numpy()[d], "t": part["t"].to_numpy()[d], "a": a.astype(np.int32), "known": known.astype(np.int32)})

    dense = cut(docs.join(open, ["id", "t"]).select("id", "t", "text", "runs").mapInPandas(extend, "h long, id long, t int, a int, known int"), "windows")
    judged = cut(dense.repartitionByRange("h", "id", "t", "a", "known").sortWithinPartitions("h", "id", "t", "a", "known").mapInPandas(judge, "id long, t int, a int, repeated boolean, earlier boolean, edge long"), "judged")
    drop_cut(dense)
    edges = judged.where("edge IS NOT NULL")  # at most two a task
    order = Window.partitionBy("edge").orderBy("id", "t", "a")
    edges = edges.select("id", "t", "a", (F.col("repeated") | (F.count("*").over(Window.partitionBy("edge")) > 1)).alias("repeated"), (F.col("earlier") | (F.row_number().over(order) > 1)).alias("earlier"))
    found = judged.where("edge IS NULL").select("id", "t", "a", "repeated", "earlier").unionByName(edges).where("repeated").select("id", "t", "a", F.lit(1).alias("n"), "earlier")
    return found.unionByName(marked.where(F.col("state") == WHOLE).select("id", "t", "a", "n", F.lit(True).alias("earlier")))


def spans(runs: DataFrame, least: int) -> DataFrame:
    """(id, t, start_word, end_word, earlier_words): the union of runs of windows; end_word is behind the last; earlier_words are in windows of which an equal one stands before."""
    before = Window.partitionBy("id", "t").orderBy("a", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("a") + F.col("n") + (least - 1)
    work = runs.withColumn("end", end).withColumn("past", F.max("end").over(before)).withColumn("past_earlier", F.max(F.when(F.col("earlier"), F.col("end"))).over(before))
    work = work.withColumn("fresh", (F.col("past").isNull() | (F.col("a") > F.col("past"))).cast("int"))
    work = work.withColumn("island", F.sum("fresh").over(Window.partitionBy("id", "t").orderBy("a", "n").rowsBetween(Window.unboundedPreceding, 0)))
    more = F.when(F.col("earlier"), F.greatest(F.lit(0), F.col("end") - F.greatest("a", F.coalesce("past_earlier", F.lit(0))))).otherwise(0)
    out = work.groupBy("id", "t", "island").agg(F.min("a").cast("long").alias("start_word"), F.max("end").cast("long").alias("end_word"), F.sum(more).cast("long").alias("earlier_words"))
    return out.drop("island")


def _id(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))


def repeated_passages(df: DataFrame, id: str = "doc_id", text: str = "text", least: int = 50) -> DataFrame:
    """id, start_word, end_word, earlier_words: one row per span of words that repeat; documents without a repeated passage have no row."""
    made = spans(windows(df, id, text, least), least)
    return made.select(_id("id").alias(id), "start_word", "end_word", "earlier_words")


def without_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", least: int = 50) -> DataFrame:
    """df without the words of passages that stand earlier in the corpus (by id, then place); of every passage its first place stays. Columns may have any names."""
    columns = df.columns
    df, own = set_aside(df)
    id, text = own[id], own[text]
    later = spans(windows(df, id, text, least).where("earlier"), least)
    gone = later.groupBy(F.col("id").alias("__id"), F.col("t").alias("__t")).agg(F.sort_array(F.collect_list(F.array("start_word", "end_word"))).alias("__gone"))
    body = F.col(f"`{text}`")
    keyed = df.withColumn("__id", F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(NO_ID))).withColumn("__t", checksum(body))
    joined = keyed.join(gone, ["__id", "__t"], "left")

    @F.pandas_udf("string")
    def strip(texts: pd.Series, spans: pd.Series) -> pd.Series:
        find = re.compile(WORD_CLASS).finditer
        out = []
        for t, pairs in zip(texts, spans, strict=True):
            if t is None or pairs is None:
                out.append(t)
                continue
            places = [m.span() for m in find(t)]
            parts, at = [], 0
            for a, b in pairs:
                parts.append(t[at : places[a][0]])
                at = places[b - 1][1]
            out.append("".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    stripped = F.when(F.col("__gone").isNull(), body).otherwise(strip(body, F.col("__gone")))
    return joined.select(*[stripped.alias(c) if c == text else F.col(f"`{c}`") for c in df.columns]).toDF(*columns)
