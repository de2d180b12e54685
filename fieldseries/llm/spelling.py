"""Spelling variants: words at one edit from each other, found with forward and backward minimal acyclic automata.

A query is cut in the middle. If its one error lies in the right half, the left half leads exactly through the automaton of the words, and the
rest is completed with one error; if it lies in the left half, the same holds in the automaton of the reversed words. Both automata number
their words without gaps (perfect hashing), so a match is a number and not a string. What both directions find is counted once.

Words meet their queries by the exact half: a word goes to the keys of the halves that queries of its length, one less or one more have. Keys
are hashed to buckets; a task builds the two automata of a bucket and streams the bucket's queries past them. A key of more than
`most` words is dealt over pieces, each with an automaton of its own, and its queries go to every piece: no automaton outgrows a task.

Defined results: a null text has no words; a null id deletes no letters; repeated rows count again; texts of any length are read whole; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseries.llm.common import chunks, cut, drop_cuts

RUNS = r"[A-Za-zÀ-ÿ]+"
#: A task hands on its word counts when it holds more than so many; this bounds memory, not results.
MOST_HELD = 300_000
#: Words of a key beyond which it is dealt over pieces.
MOST_WORDS = 20_000
#: Shorter words are left out: their halves say too little. With 6, halves have three letters or more.
SHORTEST = 6


def word_counts(df: DataFrame, id: str = "doc_id", text: str = "text", one_in: int = 199, least: int = 5) -> DataFrame:
    """(word, n): the lower-cased (A-Z only) runs of letters of all texts, of SHORTEST code points and more and at least so many occurrences.

    Of every run whose checksum with the document's id is a multiple of one_in, one letter is deleted first: planted misspellings, in every
    occurrence of the run in that document alike.
    """
    picked = df.select(F.col(f"`{id}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, crc, held = re.compile(RUNS).findall, zlib.crc32, Counter()

        def flush() -> pa.RecordBatch:
            long = {w: n for w, n in held.items() if n and len(w) >= SHORTEST}
            held.clear()
            made = pa.RecordBatch.from_arrays([pa.array(list(long), pa.string()), pa.array(list(long.values()), pa.int64())], names=["word", "n"])
            return made

        for batch in batches:
            low = pc.ascii_lower(batch.column("text"))
            for start, n in chunks(low):
                plain: list[str] = []
                for doc, body in zip(batch.column("id").slice(start, n).to_pylist(), low.slice(start, n).to_pylist(), strict=True):
                    if not body:
                        continue
                    words = find(body)
                    plain += words
                    if doc is None:
                        continue
                    begun = crc(f"{doc}:".encode())
                    for w in set(words):
                        if not (h := crc(w.encode(), begun)) % one_in:
                            times, at = words.count(w), h % len(w)
                            held[w] -= times
                            held[w[:at] + w[at + 1 :]] += times
                held.update(plain)
                if len(held) > MOST_HELD:
                    yield flush()
        if held:
            yield flush()

    return picked.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Automaton:
    """The minimal acyclic automaton of sorted words. A transition knows how many words come before those that it leads to, so a path's sum is the word's number.

    A state is (final, {letter: (state, words before)}); equal states are one object.
    """

    def __init__(self, words: list[str]):
        self.register: dict[tuple, list] = {}
        path: list[list] = [[False, {}, 0]]  # states still open, along the last word: final, transitions, words below
        last = ""
        for word in words:
            same = 0
            while same < len(last) and same < len(word) and last[same] == word[same]:
                same += 1
            self._close(path, last, same)
            for _ in word[same:]:
                path.append([False, {}, 0])
            path[-1][0] = True
            last = word
        self._close(path, last, 0)
        self.start = self._finish(path[0])
        del self.register

    def _close(self, path: list[list], last: str, down_to: int) -> None:
        while len(path) > down_to + 1:
            state = self._finish(path.pop())
            path[-1][1][last[len(path) - 1]] = state

    def _finish(self, open_state: list) -> list:
        final, to, _ = open_state
        key = (final, *((c, id(s)) for c, s in to.items()))
        known = self.register.get(key)
        if known is None:
            before, numbered = int(final), {}
            for c, s in to.items():  # in sorted order, as the words are
                numbered[c] = (s, before)
                before += s[2]
            known = self.register[key] = [final, numbered, before]
        return known

    def number(self, word: str) -> int | None:
        """The place of a word among the sorted words; None if it is not one."""
        at, n = self.start, 0
        for c in word:
            if c not in at[1]:
                return None
            at, before = at[1][c]
            n += before
        return n if at[0] else None

    def near(self, exact: str, rest: str) -> list[int]:
        """Numbers of the words exact + (rest with one letter inserted, deleted or replaced). A number may come twice."""
        at, n, found = self.start, 0, []
        for c in exact:
            step = at[1].get(c)
            if step is None:
                return found
            at, before = step
            n += before

        def finish(state: list, number: int, i: int) -> None:
            for c in rest[i:]:
                step = state[1].get(c)
                if step is None:
                    return
                state, number = step[0], number + step[1]
            if state[0]:
                found.append(number)

        for i, c in enumerate(rest):
            finish(at, n, i + 1)  # rest[i] is one too many
            for letter, (state, before) in at[1].items():
                if letter != c:
                    finish(state, n + before, i + 1)  # another letter in its place
                finish(state, n + before, i)  # a letter more before it
            step = at[1].get(c)
            if step is None:
                return found
            at, n = step[0], n + step[1]
        found += [n + before for state, before in at[1].values() if state[0]]  # a letter more at the end
        return found


def _keys(word: Column, lengths: list[Column]) -> Column:
    """The halves that a query of each length would match exactly: its left half in the words, its right half in the reversed ones."""
    left = [F.concat(F.lit(">"), F.substring(word, F.lit(1), F.floor(n / 2).cast("int"))) for n in lengths]
    right = [F.concat(F.lit("<"), F.substring(F.reverse(word), F.lit(1), F.ceil(n / 2).cast("int"))) for n in lengths]
    return F.array_distinct(F.flatten(F.array(*[F.when(n >= SHORTEST, F.array(a, b)).otherwise(F.array().cast("array<string>")) for n, a, b in zip(lengths, left, right, strict=True)])))


def near_words(words: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """words(word, n), distinct -> (word, near, near_n): all pairs at exactly one edit, in both orders; a pair may come more than once."""
    size = F.char_length("word")
    held = words.select("word", "n", F.explode(_keys(F.col("word"), [size - 1, size, size + 1])).alias("key"))
    asked = words.select("word", F.explode(_keys(F.col("word"), [size])).alias("key"))
    # At most (words * 4 / most) keys are crowded; they are broadcast only if few.
    crowded = cut(held.groupBy("key").agg(F.count("*").alias("__c")).where(F.col("__c") > most).select("key", F.ceil(F.col("__c") / most).cast("int").alias("pieces")), "crowded")
    several = crowded.count()
    buckets = max(256, 4 * words.count() // most)

    def dealt(rows: DataFrame, piece: Column) -> DataFrame:
        if several:
            rows = rows.join(F.broadcast(crowded) if several <= 10_000 else crowded, "key", "left")
        else:
            rows = rows.withColumn("pieces", F.lit(None).cast("int"))
        return rows.withColumn("piece", piece).withColumn("bucket", F.pmod(F.xxhash64("key", "piece"), F.lit(buckets)))

    last = F.coalesce(F.col("pieces"), F.lit(1)) - 1
    stored = dealt(held, F.pmod(F.xxhash64("word"), last + 1).cast("int")).select("bucket", F.lit(0).alias("role"), "word", "n", F.lit(None).cast("string").alias("key"))
    posed = dealt(asked, F.explode(F.sequence(F.lit(0), last))).select("bucket", F.lit(1).alias("role"), "word", F.lit(None).cast("long").alias("n"), "key")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts, machines = None, {}, None
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for bucket, role, word, n, key in zip(*[batch.column(c).to_pylist() for c in ("bucket", "role", "word", "n", "key")], strict=True):
                if bucket != now:
                    now, counts, machines = bucket, {}, None
                if not role:
                    counts[word] = n
                    continue
                if machines is None:
                    machines = {s: (Automaton(listed), listed) for s, listed in ((">", sorted(counts)), ("<", sorted(w[::-1] for w in counts)))}
                side, half = key[0], key[1:]
                machine, listed = machines[side]
                way = word if side == ">" else word[::-1]
                for k in set(machine.near(half, way[len(half) :])):
                    other = listed[k] if side == ">" else listed[k][::-1]
                    if other != word:
                        out[0].append(word)
                        out[1].append(other)
                        out[2].append(counts[other])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["word", "near", "near_n"])

    both = stored.unionByName(posed).repartition("bucket").sortWithinPartitions("bucket", "role", "word")
    return both.mapInArrow(search, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """forms(word, form) without null forms and without cycles -> (word, root): the last of the chain, found by doubling the steps in each round."""
    at = cut(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        made = cut(at.join(onward, "root", "left").select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "roots")
        moved = made.where("moved").limit(1).count()
        drop_cuts(at)
        at = made.drop("moved")
        at._cut_path = made._cut_path
        if not moved:
            return at


def group_variants(words: DataFrame, factor: int = 5, most: int = MOST_WORDS) -> DataFrame:
    """words(word, n) -> word, form, root, n, n_near, form_n. A word's form is its near word of most occurrences (the smallest among equals), where it
    has at least factor times the word's; n_near counts near words; root follows the forms to the end. A chain ends, as n grows in every step."""
    pairs = near_words(words, most)
    best = pairs.groupBy("word").agg(F.collect_set(F.struct((-F.col("near_n")).alias("a"), F.col("near").alias("b"))).alias("__set"))  # as many as one edit can make
    best = best.select("word", F.size("__set").cast("long").alias("n_near"), F.array_min("__set").alias("__best"))
    holds = -F.col("__best.a") >= factor * F.col("n")
    placed = words.join(best, "word", "left").select("word", F.when(holds, F.col("__best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(holds, -F.col("__best.a")).alias("form_n"))
    placed = cut(placed, "variants")
    ends = roots(placed.where("form IS NOT NULL").select("word", "form"))
    return placed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    return group_variants(cut(word_counts(df, id, text), "words"))
