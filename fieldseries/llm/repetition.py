"""Quality rules from suffix arrays: how much of a text is covered by repeated word sequences, and how long the longest is.

A chunk of texts becomes one sequence of word numbers, made distinct by document so that suffixes of different texts
never compare equal. Prefix doubling sorts its suffixes; the ranks kept at each doubling give the longest common
prefixes of neighbours. An LCP interval of value l is a maximal repeated substring of l words; the spans of all intervals
of at least `least` words are united by a difference array.

Defined results: a null or empty text has no words, so it has zeros everywhere and fails the base rule on its length;
repeated rows give equal rows; an empty table gives an empty table; columns beside the keys and the text are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseries.llm.common import WORD_CLASS, by_text, set_aside

SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long"
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Base: at least min_words words, at most base_percent % of them in repeated base_window-word windows.

    Verdict: repeats of at least `least` words cover at most max_covered of the words, and none is longer than max_longest.
    """

    min_words: int = 20
    base_window: int = 8
    base_percent: int = 30
    least: int = 5
    max_covered: float = 0.3
    max_longest: int = 100


def suffix_repeats(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each position, the length in words of the longest substring starting there that occurs elsewhere in its document."""
    n = len(words)
    if n < 2:
        return np.zeros(n, np.int64)
    key = doc.astype(np.int64) * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    ranks = [_group_starts(key[order], order, np.arange(n))]
    todo = _shared(ranks[0], order)
    h = 1
    while len(todo):  # suffixes that still share their first h words with another
        rank = ranks[-1]
        after = np.where(todo + h < n, rank[np.minimum(todo + h, n - 1)], -1)
        by = np.lexsort((after, rank[todo]))
        todo, after = todo[by], after[by]
        base = rank[todo]
        first = np.r_[True, base[1:] != base[:-1]]
        new = np.r_[True, first[1:] | (after[1:] != after[:-1])]
        index = np.arange(len(todo))
        within = np.maximum.accumulate(np.where(new, index, 0)) - np.maximum.accumulate(np.where(first, index, 0))
        rank = rank.copy()
        rank[todo] = base + within
        ranks.append(rank)
        same = np.r_[~new[1:], False]
        todo = todo[same | ~new]
        h *= 2
    array = np.empty(n, np.int64)
    array[ranks[-1]] = np.arange(n)
    a, b = array[:-1].copy(), array[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        rank = ranks[level]
        inside = (a < n) & (b < n)
        equal = inside.copy()
        equal[inside] = rank[a[inside]] == rank[b[inside]]
        step = equal * (1 << level)
        lcp, a, b = lcp + step, a + step, b + step
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, array[:-1], lcp)
    np.maximum.at(longest, array[1:], lcp)
    return longest


def _group_starts(key: np.ndarray, order: np.ndarray, index: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), np.int64)
    rank[order] = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], index, 0))
    return rank


def _shared(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    r = rank[order]
    same = r[1:] == r[:-1]
    return order[np.r_[same, False] | np.r_[False, same]]


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Positions inside the union of the spans of repeats of at least `least` words."""
    at = np.flatnonzero(longest >= least)
    change = np.zeros(len(longest) + 1, np.int64)
    change[at] += 1
    np.subtract.at(change, at + longest[at], 1)
    return np.cumsum(change[:-1]) > 0


def measure(texts: list[str | None], limits: Limits) -> pd.DataFrame:
    find, index = re.compile(WORD_CLASS).findall, defaultdict()
    index.default_factory = index.__len__
    docs = [find(t) if t else [] for t in texts]
    counts = np.array([len(d) for d in docs], np.int64)
    words = np.fromiter((index[w] for d in docs for w in d), np.int64, counts.sum())
    doc = np.repeat(np.arange(len(docs)), counts)
    longest = suffix_repeats(words, doc)
    sums = lambda mask: np.bincount(doc, mask, minlength=len(docs)).astype(np.int64)
    most = np.zeros(len(docs), np.int64)
    np.maximum.at(most, doc, longest)
    dup_lines = []
    for t in texts:
        lines = [x for x in t.split("\n") if find(x)] if t else []
        dup_lines.append(len(lines) - len(set(lines)))
    return pd.DataFrame({
        "n_words": counts, "word_chars": [sum(map(len, d)) for d in docs], "n_symbols": [sum(map((t or "").count, SYMBOLS)) for t in texts], "n_dup_lines": dup_lines,
        "n_repeat_words": sums(covered(longest, limits.base_window)), "covered_words": sums(covered(longest, limits.least)), "longest_repeat": most,
    })


def quality(df: DataFrame, keys: list[str], text: str = "text", limits: Limits | None = None) -> DataFrame:
    """Key columns, the measures of SCHEMA, base_failed and kept. One pass, no shuffle: a text is judged by itself."""
    limits = limits or Limits()
    out = by_text(df, lambda texts: measure(texts, limits), SCHEMA, keys, text)
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.base_percent * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("covered_words") <= limits.max_covered * F.col("n_words")) & (F.col("longest_repeat") <= limits.max_longest))


def passing(df: DataFrame, text: str = "text", limits: Limits | None = None) -> DataFrame:
    """The rows whose text quality() keeps, with their columns as they are, whatever these are called."""
    own, names = set_aside(df)
    return quality(own, own.columns, names[text], limits).where("kept").select(own.columns).toDF(*df.columns)
