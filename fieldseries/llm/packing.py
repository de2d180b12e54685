"""Packing tokenized documents into sequences of a fixed length by best two fit.

A bin is filled greedily: the largest unpacked piece that fits, again and again. If a gap stays, the bin's smallest piece gives way to the two
unpacked pieces that fill the gap so widened most tightly, where two such are larger than it together. Choices depend on the sizes alone, so one packing of
the whole corpus is made on the count of pieces of each size (no more counts than a sequence has tokens): the same bin comes again and again until a size of
it runs short, and is written down once with its number of repeats. Each piece then finds its place from its rank among the pieces of its size.

Texts are split at single spaces into segments that the vocabulary's own pattern never joins; the tokenizers library encodes every segment that a worker has not
met, and a text's ids are those of its segments end to end. A segment of letters is one piece of that pattern and goes to the library's model itself; with marks behind the letters it is two.

Defined results: a null text is an empty one: its only id is the end mark; repeated rows are packed as pieces of their own; a document of any length is cut into
full pieces but for a shorter first one; an empty table gives an empty table; extra columns are kept where named as keys, under their own names,
which must differ from those of the results.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from fieldseries.llm.bpe import byte_letters
from fieldseries.llm.common import chunks, cut

CAPACITY, END = 1024, 2
#: The white space of the vocabulary's pattern.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Latin letters, of which the vocabulary's pattern makes one piece with a space before them, and marks behind them, of which it makes another (an apostrophe may begin one with letters).
WORD = re.compile("( ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")
#: A worker forgets its segments when it holds more than so many, and never keeps longer ones; this bounds memory, not results.
MOST_SEGMENTS, LONGEST_KEPT = 1_000_000, 64
#: A table of part sizes of more rows is joined by a shuffle.
BROADCAST_ROWS = 200_000


class Known(dict[str, bytes]):
    """The ids of segments by segment; one that is not there is encoded when it is asked for. A segment behind a space has the space in front."""

    def __init__(self, model: Tokenizer):
        self.model, self.piece = model, model.model.tokenize
        self.letters = dict(enumerate(byte_letters()))

    def __missing__(self, segment: str) -> bytes:
        if found := WORD.fullmatch(segment):
            word, marks = found.groups()
            if marks:
                made = self[word] + self[marks]
            else:
                letters = segment.replace(" ", self.letters[32]) if segment.isascii() else segment.encode().decode("latin-1").translate(self.letters)
                ids = [t.id for t in self.piece(letters)]
                made = pack_ids(f"<{len(ids)}I", *ids)
        else:
            made = np.array(self.model.encode(segment, add_special_tokens=False).ids, "<u4").tobytes()
        if len(segment) <= LONGEST_KEPT:
            self[segment] = made
        return made


@dataclass
class Encoder:
    """The tokenizer with the segments met so far. Byte-level vocabularies with the usual pattern: a space joins the word behind it."""

    spec: str

    def __post_init__(self) -> None:
        spec = json.loads(self.spec)
        before, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec["normalizer"] or any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError("segments are independent for plain byte-level tokenizers only")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has its core
        self.model = Tokenizer.from_str(self.spec)
        self.model.no_truncation()
        self.model.no_padding()
        names = sorted((a["content"] for a in added), key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")").split if names else lambda text: [text]
        self.named = {a["content"]: np.array([a["id"]], "<u4").tobytes() for a in added}
        self.blanks = re.compile(f"([{SPACE}]+(?=[{SPACE}]))").split  # all of a run of white space but its last
        self.tail = re.compile(f"[{SPACE}]{{2,}}\\Z").search
        self.forget()

    def forget(self) -> None:
        self.known = Known(self.model)
        self.known.update(self.named)

    def segments(self, text: str) -> list[str]:
        """The text in segments, end to end."""
        out: list[str] = []
        end = self.tail(text) if text[-1:].isspace() else None
        body = text[: end.start()] if end else text
        for i, part in enumerate(self.blanks(body)):
            if i % 2:
                out.append(part)
                continue
            for j, line in enumerate(part.split("\n")):
                if j:
                    out.append("\n")
                first, *others = line.split(" ")
                if first:
                    out.append(first)
                out += [" " + x for x in others]
        if end:
            out.append(end[0])
        return out

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        if len(self.known) > MOST_SEGMENTS:
            self.forget()
        ids, made = self.known.__getitem__, []
        for t in texts:
            parts = self.cut(t) if t else []
            made.append(b"".join(map(ids, self.segments(t) if len(parts) == 1 else [s for i, p in enumerate(parts) if p for s in ([p] if i % 2 else self.segments(p))])))
        return made


#: A worker process runs many tasks one after the other; its encoder stays, with what it has learned.
_encoders: dict[str, Encoder] = {}


def encoder_of(spec: str) -> Encoder:
    if spec not in _encoders:
        _encoders.clear()
        _encoders[spec] = Encoder(spec)
    return _encoders[spec]


def pieces(df: DataFrame, tokenizer: str, keys: list[str], text: str = "text", capacity: int = CAPACITY, end: int = END, digests: bool = False) -> DataFrame:
    """The key columns, piece, start, length and ids (array<int>) of every piece; with digests ids_crc32 in place of ids. __part and __place number the pieces of
    one length within a task: keep the rows (cut) before they are used."""
    with open(tokenizer, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())  # bounded by the vocabulary file
    picked = df.select(F.col(f"`{text}`").alias("__text"), *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
    held = [f"__k{i}" for i in range(len(keys))]
    body = ("ids_crc32", pa.int64()) if digests else ("ids", pa.list_(pa.int32()))
    kinds = {f.name: to_arrow_type(f.dataType) for f in picked.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = encoder_of(shared.value), TaskContext.get().partitionId(), Counter()
        mark = np.array([end], "<u4").tobytes()
        for batch in batches:
            texts = batch.column("__text")
            for start, n in chunks(texts):
                row, piece, begin, length, place, content = [], [], [], [], [], []
                for i, made in enumerate(encoder.batch(texts.slice(start, n).to_pylist())):
                    made += mark
                    total = len(made) // 4
                    bounds = [0, *range(total % capacity or capacity, total + 1, capacity)] if total > capacity else [0, total]
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        row.append(start + i)
                        piece.append(k)
                        begin.append(a)
                        length.append(b - a)
                        place.append(seen[b - a])
                        seen[b - a] += 1
                        ids = made[4 * a : 4 * b]
                        content.append(zlib.crc32(ids) if digests else np.frombuffer(ids, "<u4").astype(np.int32))
                at = pa.array(row, pa.int64())
                columns = [batch.column(h).take(at).cast(kinds[h]) for h in held] + [pa.array(piece, pa.int32()), pa.array(begin, pa.int64()), pa.array(length, pa.int64()), pa.array(content, body[1]), pa.array([part] * len(row), pa.int64()), pa.array(place, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*held, "__piece", "__start", "__length", "__body", "__part", "__place"])

    types = dict(picked.dtypes)
    schema = [*(f"{h} {types[h]}" for h in held), "__piece int", "__start long", "__length long", f"__body {'long' if digests else 'array<int>'}", "__part long", "__place long"]
    out = picked.mapInArrow(run, ", ".join(schema))
    named = [F.col("__piece").alias("piece"), F.col("__start").alias("start"), F.col("__length").alias("length"), F.col("__body").alias(body[0])]
    return out.select(*[F.col(h).alias(k) for h, k in zip(held, keys, strict=True)], *named, "__part", "__place")


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for so many pieces of each size (1 to capacity) -> [(repeats, [(size, pieces in the bin)])]. A bin repeats as long as all its sizes last, which is
    as long as one-by-one packing would choose it again."""
    left = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        if not 1 <= size <= capacity:
            raise ValueError(f"no piece of {size} fits {capacity}")
        left[size] = n
    sizes = np.arange(capacity + 1)
    made: list[tuple[int, list[tuple[int, int]]]] = []
    below = np.maximum.accumulate(np.where(left > 0, sizes, 0))  # the largest size there is, up to each
    while below[-1]:
        used: dict[int, int] = {}
        gap = capacity
        largest = int(below[gap])
        while largest:
            k = min(gap // largest, int(left[largest]))
            used[largest] = k
            gap -= k * largest
            largest = int(below[min(gap, largest - 1)])
        if gap:
            used = _two_for_one(left, below, sizes, used, gap)
        repeats = min(int(left[s]) // k for s, k in used.items())
        for s, k in used.items():
            left[s] -= repeats * k
        made.append((repeats, sorted(used.items(), reverse=True)))
        below = np.maximum.accumulate(np.where(left > 0, sizes, 0))
    return made


def _two_for_one(left: np.ndarray, below: np.ndarray, sizes: np.ndarray, used: dict[int, int], gap: int) -> dict[int, int]:
    """The bin with its smallest piece replaced by the two unpacked ones that fill its place and the gap best; unchanged if none fill more than it did."""
    smallest = min(used)
    room = smallest + gap
    free = left.copy()
    for s, k in used.items():
        free[s] -= k
    held = free > 0
    largest = below if all(free[s] > 0 for s in used) else np.maximum.accumulate(np.where(held, sizes, 0))
    a = sizes[1:room][held[1:room]]  # the larger of the two
    if not len(a):
        return used
    b = largest[np.minimum(room - a, a)]
    alone = (b == a) & (free[a] < 2)
    b = np.where(alone, largest[np.maximum(b - 1, 0)], b)
    total = np.where(b > 0, a + b, 0)
    best = len(total) - 1 - int(total[::-1].argmax())  # of equal sums the one with the largest piece
    if total[best] <= smallest:
        return used
    out = Counter(used)
    out[smallest] -= 1
    out[int(a[best])] += 1
    out[int(b[best])] += 1
    return {s: k for s, k in out.items() if k}


def place(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Append sequence_id and offset (gapless from 0 in each sequence) to pieces() that were kept."""
    counts = found.groupBy("length", "__part").agg(F.count("*").alias("__n"))
    counts = cut(counts.withColumn("__before", F.sum("__n").over(Window.partitionBy("length").orderBy("__part")) - F.col("__n")), "piece-counts")
    of_size = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}  # at most capacity rows
    rows, first, taken = [], 0, Counter()
    for repeats, bin_ in best_two_fit(of_size, capacity):
        offset = 0
        for size, k in bin_:
            rows.append((size * 2**44 + taken[size], k, first, offset))
            taken[size] += k * repeats
            offset += k * size
        first += repeats
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)  # a row for each size of each kind of bin
    shared = found.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def seat(length, rank):  # noqa: ANN001, ANN202
        t, size = shared.value, length.to_numpy()
        key = size * 2**44 + rank.to_numpy()
        at = np.searchsorted(t[:, 0], key, "right") - 1
        nth = key - t[at, 0]
        return length.to_frame("sequence_id").assign(sequence_id=t[at, 2] + nth // t[at, 1], offset=t[at, 3] + nth % t[at, 1] * size)

    before = counts.drop("__n")
    near = F.broadcast(before) if counts.count() <= BROADCAST_ROWS else before
    seated = found.join(near, ["length", "__part"]).withColumn("__seat", seat(F.col("length"), F.col("__before") + F.col("__place")))
    return seated.select(*[c for c in found.columns if c not in ("__part", "__place")], F.col("__seat.sequence_id").alias("sequence_id"), F.col("__seat.offset").alias("offset"))


def pack(df: DataFrame, tokenizer: str, keys: list[str], text: str = "text", capacity: int = CAPACITY, end: int = END, digests: bool = False) -> DataFrame:
    """Every piece of every document with its ids (or their checksum) and its place."""
    return place(cut(pieces(df, tokenizer, keys, text, capacity, end, digests), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, lengths: the packed sequences themselves, no longer than the capacity, with the lengths of their pieces for attention masks."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.length").alias("lengths"))
