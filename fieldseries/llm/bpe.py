"""BPE encoding and decoding with a pair occurrence index.

Each task turns its texts into indices of distinct words, then merges all its new words at once: an index maps
each rank's pair to every position where it occurs in the task's symbols, active ranks are applied in ascending order
from a heap, and only the lists of pairs beside a merge are updated. Results equal the public library's encode with
add_special_tokens=False and its decode with skip_special_tokens=False.

Defined results: a null text encodes as the empty text (no ids, empty decoded text); repeated rows give equal rows;
an empty table gives an empty table; of other columns only the named keys are kept, under their own names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections import defaultdict

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from fieldseries.llm.common import by_text

#: Unicode white space as the vocabulary's own patterns mean it.
SPACE = r"\t-\r \x85\xa0  -     　"
NO_RANK = np.int64(2**62)
#: A task forgets its words when it holds more than so many; this bounds memory, not results.
MOST_WORDS = 600_000


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 bytes stand for themselves, the others follow from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(other)) for b in range(256)]


class Vocabulary:
    """What a tokenizer file says, small enough to send to every task (its size is the file's, not the corpus's)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.size = max(self.tokens) + 1
        letters = byte_letters()
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        if len(set(self.made.tolist())) != len(merges):
            raise ValueError("two merges make the same token: ranks of new pairs may fall, which the ascending pass excludes")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NO_RANK)


def merge_words(v: Vocabulary, words: list[str]) -> list[np.ndarray]:
    """The ids of each word. Symbols of all words lie in one array; a word's last symbol carries the suffix, so no pair crosses words."""
    raw = [w.encode() for w in words]
    lengths = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    n = len(data)
    if not n:
        return [np.zeros(0, np.uint32) for _ in words]
    ends = np.cumsum(lengths)
    symbols = v.first[data]
    symbols[ends - 1] = v.last[data[ends - 1]]
    after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
    rank = np.full(n, NO_RANK)
    rank[:-1] = v.ranks(symbols[:-1], symbols[1:])
    rank[ends - 1] = NO_RANK
    occurs: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def put(positions: np.ndarray) -> None:
        r = rank[positions]
        positions, r = positions[r < NO_RANK], r[r < NO_RANK]
        if not len(r):
            return
        by = np.argsort(r, kind="stable")
        positions, r = positions[by], r[by]
        starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        for x, a, b in zip(r[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(r)], strict=True):
            if x in occurs:
                occurs[x].append(positions[a:b])
            else:
                occurs[x] = [positions[a:b]]
                heapq.heappush(active, x)

    put(np.arange(n))
    while active:
        now = heapq.heappop(active)
        lists = occurs.pop(now)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        at = at[alive[at] & (rank[at] == now)]
        if not len(at):
            continue
        if len(at) > 1:  # of overlapping occurrences (aaa) every other one counts, from the left
            joined = np.r_[False, after[at[:-1]] == at[1:]]
            if joined.any():
                index = np.arange(len(at))
                at = at[(index - np.maximum.accumulate(np.where(joined, 0, index))) % 2 == 0]
        gone = after[at]
        beyond = after[gone]
        symbols[at] = v.made[now]
        alive[gone] = False
        rank[gone] = NO_RANK
        after[at] = beyond
        inside = beyond < n
        before[beyond[inside]] = at[inside]
        left = before[at]
        touched = np.unique(np.concatenate([at, left[left >= 0]]))
        right = after[touched]
        ok = right < n
        rank[touched] = NO_RANK
        rank[touched[ok]] = v.ranks(symbols[touched[ok]], symbols[right[ok]])
        put(touched)
    kept = np.cumsum(alive)
    ids = symbols[alive].astype("<u4")
    return np.split(ids, kept[ends - 1][:-1])


class Encoder:
    """The words seen so far in a task, with their ids and tokens."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.find = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+").findall
        names = sorted(v.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.clear()

    def clear(self) -> None:
        self.index: defaultdict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.ids: list[bytes] = []
        self.texts: list[str] = []

    def words(self, text: str) -> list[str]:
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if i % 2:
                out.append("\0" + part)  # a special token; NUL marks it apart from words
            elif part:
                low = unicodedata.normalize("NFC", part)
                low = "".join(c.lower() for c in low) if "Σ" in low else low.lower()
                out += self.find(low)
        return out

    def batch(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """ids as little-endian 32-bit integers, and the decoded text, of each text."""
        if len(self.ids) > MOST_WORDS:
            self.clear()
        number = self.index.__getitem__
        docs = [np.fromiter(map(number, self.words(t)), np.int32) if t else np.zeros(0, np.int32) for t in texts]
        new = list(self.index)[len(self.ids) :]
        marked = {w: self.v.special[w[1:]] for w in new if w[0] == "\0" and w[1:] in self.v.special}
        plain = iter(merge_words(self.v, [w for w in new if w not in marked]))
        token = self.v.tokens
        for w in new:
            ids = np.array([marked[w]], "<u4") if w in marked else next(plain)
            self.ids.append(ids.tobytes())
            self.texts.append(" ".join([token[i] for i in ids.tolist()]))
        return [(b"".join([self.ids[i] for i in d]), " ".join([self.texts[i] for i in d])) for d in (d.tolist() for d in docs)]


def encode(df: DataFrame, tokenizer: str, keys: list[str], text: str = "text", digests: bool = False) -> DataFrame:
    """ids (array<int>) and decoded (string) of every text beside the key columns; with digests their SHA-256 and the count instead."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(tokenizer))  # bounded by the vocabulary file
    encoders: list[Encoder] = []

    def run(texts: list[str | None]) -> pd.DataFrame:
        if not encoders:  # one a task
            encoders.append(Encoder(shared.value))
        made = encoders[0].batch(texts)
        if digests:
            return pd.DataFrame({"n_tokens": [len(b) // 4 for b, _ in made], "ids_sha256": [hashlib.sha256(b).hexdigest() for b, _ in made], "decoded_sha256": [hashlib.sha256(s.encode()).hexdigest() for _, s in made]})
        return pd.DataFrame({"ids": [np.frombuffer(b, "<u4").astype(np.int32) for b, _ in made], "decoded": [s for _, s in made]})

    return by_text(df, run, "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string", keys, text)
