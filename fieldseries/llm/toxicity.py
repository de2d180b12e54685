"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel of two words sums, over their common subsequences of three letters, a decay to the power of the lengths they
span, so gaps and inserted characters weaken a match but do not end it. Words carry a mark at their start. Landmarks
are words and stems that toxic training documents favour. A sentence is described by its largest kernel value with each landmark (over
the landmark's own), taken over its words and its joins of two tokens, mapped by the inverse root of the landmarks' kernel matrix; a linear
machine with squared hinge loss is trained on the sentences of labelled documents. Labels belong to documents: in a toxic one the positive
sentences are those with a word next to a landmark and the worst by the machine, chosen again after every round; in a clean one all
sentences are negative. A document's score is a logistic function of its worst sentences' margins and of how many sentences, and words taken by
themselves, lie beyond the margin.

Kernel values are taken only where the longest common subsequence with a landmark reaches `least_common` of the landmark's
length, found for all words by bit-parallel steps; below that they count as 0. Runs of single letters (i d i o t) are read as one
word too, and so are two neighbouring tokens of which one has under three letters (id iot).

Training uses bounded samples of labelled rows (parameters of `train`); scoring is one pass without a shuffle.

Defined results: null and empty texts have no sentence and get the score of one without any match; null labels are not
learned from; without toxic labels every score is 0; repeated rows give equal rows; an empty table gives an empty table;
labels, languages, sources and ids never enter a score.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import defaultdict
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseries.llm.common import by_text, cut

LENGTH, DECAY = 3, 0.6
Matches = tuple[np.ndarray, np.ndarray, int]
#: Numbers that describe a document to the logistic function.
EVIDENCE = 8
#: Longer words are scored by their windows of so many letters, at half-window steps: every letter counts.
WINDOW = 24
#: A task forgets its words when it holds more than so many words and joins, or vectors; this bounds memory, not results.
MOST_WORDS = 800_000
MOST_VECTORS = 150_000
#: Marks the start of a word.
START = "^"
#: Punctuation stripped from the ends of a word.
EDGES = ".,;:!?\"'()[]{}<>#*$%&|+-_=/\\~^@`"
SPACED = re.compile(r"(?:(?<=\s)|^)\S(?:\s\S){2,}(?=\s|$)")


def letters(words: list[str], width: int) -> np.ndarray:
    """Code points, padded with 0."""
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width).astype(np.int64) if words else np.zeros((0, width), np.int64)


def kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The subsequence kernel of each row of s with the same row of t (padded with 0)."""
    s, t = np.ascontiguousarray(s.T), np.ascontiguousarray(t.T)  # rows last: every step below runs over all of them
    match = ((s[:, None] == t[None]) & (s[:, None] > 0)) * DECAY**2
    inner = match.copy()
    for _ in range(LENGTH - 1):
        for j in range(1, inner.shape[1]):
            inner[:, j] += DECAY * inner[:, j - 1]
        for i in range(1, len(inner)):
            inner[i] += DECAY * inner[i - 1]
        before, inner = inner, np.zeros_like(match)  # K' of the prefixes that end before each pair of positions
        inner[1:, 1:] = match[1:, 1:] * before[:-1, :-1]
    return inner.sum((0, 1))


def self_kernel(s: np.ndarray) -> np.ndarray:
    return np.concatenate([kernel(s[i : i + 4096], s[i : i + 4096]) for i in range(0, len(s), 4096)]) if len(s) else np.zeros(0)


@dataclass
class Landmarks:
    words: list[str]
    least_common: float = 0.75

    def __post_init__(self) -> None:
        self.width = max(map(len, self.words), default=1)
        self.t = letters(self.words, self.width)
        self.own = np.maximum(self_kernel(self.t), 1e-300)
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.least = np.maximum(LENGTH, np.ceil(self.least_common * self.lengths)).astype(np.int64)
        self.alphabet = np.unique(self.t[self.t > 0])
        self.masks = np.zeros((len(self.alphabet) + 1, len(self.words)), np.uint32)  # the last row: letters no landmark has
        for m, w in enumerate(self.t):
            for j, c in enumerate(w):
                if c:
                    self.masks[np.searchsorted(self.alphabet, c), m] |= np.uint32(1 << j)
        counts = (self.t[:, None] == self.alphabet[:, None]).sum(2)  # landmarks by letters
        self.letter, self.times = np.array([(c, k) for c, most in enumerate(counts.max(0, initial=0).tolist()) for k in range(1, most + 1)], np.int64).reshape(-1, 2).T
        self.has = (counts[:, self.letter] >= self.times).T.astype(np.float32)  # whether a landmark has a letter so many times
        self.full = np.uint32(0xFFFFFFFF) >> (32 - self.lengths).astype(np.uint32)

    def codes(self, s: np.ndarray) -> np.ndarray:
        """Each letter's place in the alphabet; its length for letters that no landmark has."""
        at = np.minimum(np.searchsorted(self.alphabet, s), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == s, at, len(self.alphabet))

    def possible(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, landmark) that share enough letters, in whatever order: no other pair has a common subsequence of the least length."""
        n, k = len(code), len(self.alphabet) + 1
        counts = np.bincount((np.arange(n)[:, None] * k + code).ravel(), minlength=n * k).reshape(n, k)
        shared = (counts[:, self.letter] >= self.times).astype(np.float32) @ self.has
        return np.nonzero(shared >= self.least)

    def common(self, code: np.ndarray, w: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Lengths of the longest common subsequences of words w with landmarks m; bit j of a state is 0 where letter j adds one."""
        state = np.full(len(w), 0xFFFFFFFF, np.uint32)
        for column in code.T:
            hit = state & self.masks[column[w], m]
            state = (state + hit) | (state - hit)
        return np.bitwise_count(~state & self.full[m]).astype(np.int64)

    def values(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, landmark, kernel value over the landmark's own) of the pairs that count. Words of like length are taken together, and so are landmarks."""
        out = []
        if not self.words:
            words = []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        for i in range(0, len(words), 8192):
            part = order[i : i + 8192]
            s = letters([words[x] for x in part.tolist()], min(WINDOW + 1, max(1, int(sizes[part[-1]]))))
            code = self.codes(s)
            w, m = self.possible(code)
            near = np.concatenate([np.zeros(0, bool), *(self.common(code, w[j : j + 32768], m[j : j + 32768]) >= self.least[m[j : j + 32768]] for j in range(0, len(w), 32768))])
            w, m = w[near], m[near]
            by = np.argsort(self.lengths[m], kind="stable")
            w, m = w[by], m[by]
            for j in range(0, len(w), 2048):
                at = slice(j, j + 2048)
                width = self.lengths[m[at][-1]]
                out.append((part[w[at]], m[at], kernel(s[w[at]], self.t[m[at], :width]) / self.own[m[at]]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def pieces(word: str) -> list[str]:
    """What a word (without punctuation at its ends) offers the kernel: itself, or windows of it if it is long."""
    if len(word) < LENGTH:
        return []
    return [START + word] if len(word) <= WINDOW else [START * (not i) + word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


class Reader:
    """Turns texts into the vectors of their sentences: of each landmark the largest kernel value with a word of the sentence, or with two
    neighbouring tokens read as one where one of them is shorter than the kernel's letters. With a machine, also the margins of those words
    and joins by themselves. Keeps the vectors of the words a task has seen."""

    def __init__(self, marks: Landmarks, machine: Machine | None = None):
        self.marks, self.machine = marks, machine
        self.clear()

    def clear(self) -> None:
        self.index: defaultdict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.known: dict[str, int] = {}  # of each word and join read: its row in vectors, or -1
        self.row = np.zeros(0, np.int32)  # of each token: its row in vectors, or -1
        self.bare: list[str] = []  # tokens without punctuation at their ends
        self.size = np.zeros(0, np.int32)  # and their lengths
        self.stop = np.zeros(0, bool)  # tokens that end a sentence
        self.vectors = np.zeros((0, len(self.marks.words)), np.float32)
        self.margins = np.zeros(0)  # of the vectors, with a machine

    def rows(self, words: list[str]) -> np.ndarray:
        """The rows of the vectors of words, -1 for no match. What is new is stored (its pieces taken together); a word behind START is one piece."""
        seen = list(map(self.known.get, words))
        if None not in seen:
            return np.array(seen, np.int32)
        new = list(dict.fromkeys(x for x, r in zip(words, seen, strict=True) if r is None))
        size = np.fromiter(map(len, new), np.int64, len(new))
        owner = np.flatnonzero((size >= LENGTH) & (size <= WINDOW))
        parts = [START + new[i] for i in owner.tolist()]  # as pieces() gives them
        for i in np.flatnonzero(size > WINDOW).tolist():
            more = [new[i]] if new[i][0] == START else pieces(new[i])
            owner = np.r_[owner, np.full(len(more), i)]
            parts += more
        w, m, k = self.marks.values(parts)
        row = np.full(len(new), -1, np.int32)
        if len(w):
            found, at = np.unique(owner[w], return_inverse=True)
            made = np.zeros((len(found), len(self.marks.words)), np.float32)
            np.maximum.at(made, (at, m), k.astype(np.float32))
            row[found] = len(self.vectors) + np.arange(len(found))
            self.vectors = np.concatenate([self.vectors, made])
            if self.machine:
                self.margins = np.concatenate([self.margins, self.machine.margins(made)])
        self.known.update(zip(new, row.tolist(), strict=True))
        return np.array(list(map(self.known.get, words)), np.int32)

    def learn(self, new: list[str]) -> None:
        bare = [t.strip(EDGES) for t in new]
        self.bare += bare
        self.row = np.concatenate([self.row, self.rows(bare)])
        self.size = np.concatenate([self.size, np.fromiter(map(len, bare), np.int32, len(bare))])
        self.stop = np.concatenate([self.stop, np.array([t[-1] in ".!?" for t in new], bool)])

    def joins(self, tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, row) of the neighbouring tokens of a sentence that match when read as one. Joins longer than every landmark are not read: their words are."""
        size = self.size[tokens]
        a, b = size[:-1], size[1:]
        at = np.flatnonzero((a > 0) & (b > 0) & (np.minimum(a, b) < LENGTH) & (a + b > LENGTH) & (a + b < self.marks.width) & ~ends[:-1])
        pair, back = np.unique(tokens[at].astype(np.int64) << 32 | tokens[at + 1], return_inverse=True)
        bare = self.bare
        both = [bare[p] + bare[q] for p, q in zip((pair >> 32).tolist(), (pair & 0xFFFFFFFF).tolist(), strict=True)]
        row = self.rows([x if len(x) <= WINDOW else START + x for x in both])[back]
        return at[row >= 0], row[row >= 0]

    def read(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of each text's tokens; runs of single letters follow as sentences of their own. Each distinct token of these texts is looked up once."""
        lows = [(t or "").lower().replace("\n", " . ") for t in texts]
        split = [low.split() for low in lows]
        coded = pa.array(list(chain.from_iterable(split)), pa.large_string()).dictionary_encode()
        distinct, number = coded.dictionary.to_pylist(), self.index.__getitem__
        at = coded.indices.to_numpy()
        one = np.fromiter(map(len, distinct), np.int64, len(distinct))[at] == 1
        cuts = np.cumsum([len(tokens) for tokens in split])
        docs = np.split(np.fromiter(map(number, distinct), np.int32, len(distinct))[at], cuts[:-1])
        for i in np.unique(np.searchsorted(cuts, np.flatnonzero(one[:-2] & one[1:-1] & one[2:]), side="right")).tolist():
            runs = [x for run in SPACED.findall(lows[i]) for x in (".", "".join(run.split()))]
            docs[i] = np.r_[docs[i], np.fromiter(map(number, runs), np.int32, len(runs))]
        return docs

    def matches(self, texts: list[str | None]) -> list[Matches]:
        """For each text, the vectors of its sentences that match a landmark, the margins of its words and joins that do (none without a machine), and the number of words."""
        if len(self.row) + len(self.known) > MOST_WORDS or len(self.vectors) > MOST_VECTORS:
            self.clear()
        docs = self.read(texts)
        self.learn(list(self.index)[len(self.row) :])
        sizes = np.array([len(d) for d in docs], np.int64)
        tokens = np.concatenate([np.zeros(0, np.int32), *docs])
        ends = self.stop[tokens]
        ends[np.cumsum(sizes)[sizes > 0] - 1] = True
        words = np.flatnonzero(self.row[tokens] >= 0)
        at, row = self.joins(tokens, ends)
        at, row = np.r_[words, at], np.r_[self.row[tokens[words]], row]
        sentence, of = np.unique((np.cumsum(ends) - ends)[at], return_inverse=True)
        order = np.argsort(of, kind="stable")
        out = np.zeros((len(sentence), len(self.marks.words)), np.float32)
        for i in range(0, len(order), 65536):  # a sentence may go on in the next block
            block = order[i : i + 65536]
            mine, start = np.unique(of[block], return_index=True)
            out[mine] = np.maximum(out[mine], np.maximum.reduceat(self.vectors[row[block]], start))
        last = np.flatnonzero(ends)[sentence]  # the last token of each sentence tells its text
        cuts = np.searchsorted(last, np.cumsum(sizes))
        owner = np.searchsorted(np.cumsum(sizes), at, side="right")
        margins = self.margins[row[np.argsort(owner, kind="stable")]] if self.machine else np.zeros(0)
        counts = np.cumsum(np.bincount(owner, minlength=len(sizes)))
        return [(out[a:b], margins[c:d], n) for a, b, c, d, n in zip(np.r_[0, cuts[:-1]], cuts, np.r_[0, counts[:-1]], counts, sizes.tolist(), strict=True)]


@dataclass
class Machine:
    marks: Landmarks
    weights: np.ndarray  # of kernel values: the Nystroem map is folded in
    bias: float
    logit: np.ndarray  # of the values that evidence() makes

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.weights + self.bias

    def evidence(self, docs: list[Matches]) -> np.ndarray:
        """The margins of the first, second, third and fifth worst sentence, the numbers of words and of sentences beyond the margin, such words in a hundred, and 1."""
        none = min(self.bias, 0.0)
        out = np.zeros((len(docs), EVIDENCE))
        out[:, :4] = none
        out[:, -1] = 1
        for i, (x, words, n) in enumerate(docs):
            if len(x):
                f = self.margins(x)
                worst = np.r_[np.sort(f)[::-1][:5], np.full(max(0, 5 - len(f)), none)]
                over = (words > 0.4).sum()
                out[i, :-1] = *worst[[0, 1, 2, 4]], math.log1p(over), math.log1p((f > 0.4).sum()), math.log1p(100 * over / max(20, n))
        return out

    def score(self, docs: list[Matches]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(docs) @ self.logit, -500, 500)))


def fit_hinge(x: list[np.ndarray], y: np.ndarray, weight: np.ndarray, root: np.ndarray, cost: float = 10.0, rounds: int = 50) -> np.ndarray:
    """Weights and bias of the linear machine over the rows of x (given in parts) times root: |w|^2 / 2 + cost * weighted mean of squared
    hinge losses, by Newton steps. Only a block of rows at a time is mapped."""
    ridge = np.r_[np.ones(root.shape[1]), 1e-6]
    weight = weight / weight.sum() * cost * 100
    w = np.zeros(len(ridge))
    blocks = [part[i : i + 8192] for part in x for i in range(0, len(part), 8192)]
    mapped = lambda b: np.c_[b @ root, np.ones(len(b))]
    margins = lambda w: np.concatenate([b @ (root @ w[:-1]) + w[-1] for b in blocks])
    loss = lambda w: (ridge * w * w).sum() / 2 + (weight * np.maximum(0, 1 - y * margins(w)) ** 2).sum()
    ends = np.cumsum([len(b) for b in blocks])
    for _ in range(rounds):
        slack = 1 - y * margins(w)
        slope, curve = ridge * w, np.diag(ridge)
        for b, end in zip(blocks, ends, strict=True):
            at = np.arange(end - len(b), end)
            on = slack[at] > 0
            a, at = mapped(b[on]), at[on]
            slope = slope - 2 * (weight * y * slack)[at] @ a
            curve = curve + 2 * (a * weight[at, None]).T @ a
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if abs(step).max() < 1e-7:
            break
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps that are halved until the loss falls; the last column is the constant."""
    penalty = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    loss = lambda w: np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ w)).sum() + (penalty * w * w).sum() / 2
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if abs(size * step).max() < 1e-7:
            break
    return w


def gapped(marks: Landmarks) -> np.ndarray:
    """Vectors of the landmarks with one character inserted at each place inside."""
    words = [w[:i] + "." + w[i:] for w in marks.words for i in range(3, len(w))]
    w, m, k = marks.values([x[: WINDOW + 1] for x in words])
    out = np.zeros((len(words), len(marks.words)))
    np.maximum.at(out, (w, m), k)
    return out


def fit(marks: Landmarks, toxic: list[tuple[np.ndarray, np.ndarray]], clean: np.ndarray, times: np.ndarray, rounds: int = 4) -> Machine:
    """toxic: distinct sentence vectors of each toxic document and how often each stands in it. clean: distinct sentence vectors, each in `times` clean documents. The logistic function is not fitted yet."""
    m = len(marks.words)
    own = np.eye(m)
    i, j = np.triu_indices(m, 1)
    if len(i):
        own[i, j] = own[j, i] = kernel(marks.t[i], marks.t[j]) / np.sqrt(marks.own[i] * marks.own[j])
    value, vector = np.linalg.eigh(own)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-2))) @ vector.T
    none, times = np.zeros((1, m)), np.r_[times, 1]  # a sentence without a match is clean
    toxic = [(x, n) for x, n in toxic if len(x)]
    disguised = gapped(marks)
    weights, bias = np.zeros(m), 0.0
    for i in range(rounds):
        # a toxic document's positive sentences: those with a word next to a landmark, and its worst by the machine so far
        on = [(x.max(1) >= 0.9) | (np.arange(len(x)) == np.argmax(x @ weights if i else x.max(1))) for x, _ in toxic]
        found = np.concatenate([x[o] for (x, _), o in zip(toxic, on, strict=True)] or [np.zeros((0, m))])
        share = np.concatenate([n[o] / n[o].sum() for (_, n), o in zip(toxic, on, strict=True)] or [np.zeros(0)])
        s = np.r_[np.ones(len(found) + len(disguised)), -np.ones(len(times))]
        each = np.r_[0.4 * share / max(1, share.sum()), np.full(len(disguised), 0.1 / max(1, len(disguised))), 0.5 * times / times.sum()]
        w = fit_hinge([found, disguised, clean, none], s, each, root)
        weights, bias = root @ w[:-1], float(w[-1])
    return Machine(marks, weights, bias, np.zeros(EVIDENCE))


def train(docs: DataFrame, labels: DataFrame, label: str, usable: Column, landmarks: int = 64, candidates: int = 2000, most_toxic: int = 3000, most_clean: int = 9000, id: str = "doc_id", text: str = "text") -> Machine:
    """Learn from labels(id, label): at most most_toxic + most_clean rows, chosen by the order of a hash of the id. Landmarks come
    from the candidates that Spark counts in those documents; the machine sees all their distinct sentences, the logistic function the evidence of whole texts, found in tasks."""
    known = labels.select(F.col(id), F.col(label).cast("int").alias("y")).where(usable & F.col("y").isin(0, 1) & F.col(id).isNotNull())
    sample = None
    for y, most in ((0, most_clean), (1, most_toxic)):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64(id), id).limit(most)
        sample = part if sample is None else sample.unionByName(part)
    rows = docs.select(F.col(id), F.col(text).alias("t")).where("t IS NOT NULL").join(F.broadcast(sample), id)  # at most most_toxic + most_clean rows
    rows = cut(rows.dropDuplicates(["t", "y"]), "labelled")
    per = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not per.get(1):
        return Machine(Landmarks([]), np.zeros(0), 0.0, np.array([0.0] * (EVIDENCE - 1) + [-500.0]))
    bare = F.regexp_replace(F.lower("t"), r"[^\p{L}\s]+", " ")
    words = rows.select("y", F.explode(F.array_distinct(F.split(bare, r"\s+"))).alias("w"), F.col(id)).where(F.length("w").between(LENGTH + 1, 20))
    stems = words.select("y", id, F.explode(F.expr(f"transform(sequence({LENGTH + 1}, length(w)), n -> substring(w, 1, n))")).alias("w")).distinct()
    counts = stems.groupBy("w").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))
    expected = (F.col("clean") + 0.5) * (per[1] / max(1, per.get(0, 0)))
    top = counts.where(F.col("toxic") >= 3).where(F.col("toxic") > 2 * expected).orderBy(F.desc((F.col("toxic") - expected) / F.sqrt(expected + 1)), F.desc(F.length("w")), "w").limit(candidates)
    marks = Landmarks(spread([START + r["w"] for r in top.select("w").collect()], landmarks))

    def vectors(ts: list[str | None]) -> pd.DataFrame:
        found = [np.unique(x, axis=0, return_counts=True) for x, *_ in Reader(marks).matches(ts)]
        return pd.DataFrame({"x": [[v.tobytes() for v in x] for x, _ in found], "n": [n for _, n in found]})

    def read(parts: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(parts), np.float32).reshape(len(parts), len(marks.words))

    got = cut(by_text(rows, vectors, "x array<binary>, n array<long>", [id, "y"], "t"), "vectors")
    toxic = [(read(r["x"]), np.array(r["n"], np.int64)) for r in got.where("y = 1").orderBy(id).toLocalIterator()]
    clean = got.where("y = 0").select(F.explode("x").alias("x")).groupBy("x").agg(F.count("*").alias("n")).orderBy("x")
    parts, times = bytearray(), array("q")  # one partition at a time is held besides
    for r in clean.toLocalIterator():
        parts += r["x"]
        times.append(r["n"])
    machine = fit(marks, toxic, np.frombuffer(parts, np.float32).reshape(len(times), len(marks.words)), np.array(times, np.int64))
    evidence = by_text(rows, lambda ts: pd.DataFrame({"e": list(machine.evidence(Reader(marks, machine).matches(ts)))}), "e array<double>", [id, "y"], "t").collect()
    evidence.sort(key=lambda r: (r[id], r["y"], r["e"]))  # here, as a sort by Spark reads the texts once more to find its ranges
    machine.logit = fit_logistic(np.array([r["e"] for r in evidence]), np.array([r["y"] for r in evidence]))
    return machine


def spread(words: list[str], most: int, alike: float = 0.8) -> list[str]:
    """The first words that no earlier choice resembles too closely."""
    chosen: list[str] = []
    s = letters(words, max(map(len, words), default=1))
    own = np.sqrt(np.maximum(self_kernel(s), 1e-300))
    at: list[int] = []
    for i, w in enumerate(words):
        if len(chosen) == most:
            break
        if at and (kernel(s[at], np.repeat(s[[i]], len(at), 0)) / (own[at] * own[i])).max() > alike:
            continue
        chosen.append(w)
        at.append(i)
    return chosen


def score(docs: DataFrame, machine: Machine, keys: list[str], text: str = "text") -> DataFrame:
    """Key columns and score."""
    readers: list[Reader] = []

    def make(ts: list[str | None]) -> pd.DataFrame:
        if not readers:
            readers.append(Reader(machine.marks, machine))
        return pd.DataFrame({"score": machine.score(readers[0].matches(ts)) if machine.marks.words else np.zeros(len(ts))})

    return by_text(docs, make, "score double", keys, text)
