"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints are cut into segments, so few that two within the distance differ in some segment by at most one bit. A
segment is indexed under its variants with one bit wildcarded, the wildcard being written as a set bit: a segment's own value (all
variants whose wildcard is set in it) and, as a visitor, the value with each unset bit set. Segments that are equal or one
bit apart meet in exactly one variant, where one of them is at home. Rows are ordered by variant and compared with the rows
before them and with the first of their variant; candidates are verified. Variants with more rows than that covers give only the
closest of these to a row, as that connects most of them, and are finished by a salted join between the connected groups found so far, so no link between groups is lost, and no group of
copies is expanded into pairs. Equal fingerprints (or texts) are one row before anything is compared. Joins on a fingerprint or a
text that very many rows share are split at run time by adaptive execution.

Defined results: a null or empty text has no word and fingerprint zero; a text with fewer words than a shingle is one shingle, however long;
repeated rows share a component; rows with a null id get a fingerprint and take part in it, but no link names them; of
rows with one id and several texts each text counts on its own; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseries.llm.common import by_text, cut, drop_cuts, set_aside
from fieldseries.llm.components import components

#: Rows before it that a row is compared with.
LAGS = 4
#: Ids up to so many are broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: A crowded variant is joined in parts of about so many rows.
SALTED_ROWS = 20_000
#: A task that checks pairs keeps the shingles of texts it has met, and forgets all when it holds more than so many; this bounds memory, not results.
MOST_SHINGLES = 2_000_000


def shingle_hashes(text: str | None, k: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every k-word shingle (A-Z lowered, words joined by a space); of the whole sequence if it is shorter."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    hash = xxhash.xxh64_intdigest
    return np.array([hash(data[a:b], seed) for a, b in zip(starts, ends[min(k, len(words)) - 1 :], strict=False)], np.uint64)


def bit_majority(hashes: np.ndarray) -> np.ndarray:
    """hashes (n, w) -> w words whose bits are 1 where over half of the n have a 1. Bits are counted eight lanes at once."""
    n, w = hashes.shape
    total = np.zeros(w * 64, np.int64)
    for i in range(0, n, 255):
        bits = np.unpackbits(np.ascontiguousarray(hashes[i : i + 255]).view(np.uint8), axis=1, bitorder="little")
        total += np.add.reduce(bits.view(np.uint64), axis=0).view(np.uint8)
    return np.packbits(2 * total > n, bitorder="little").view(np.uint64)


def fingerprint(text: str | None, k: int) -> int:
    h = shingle_hashes(text, k)
    return int(bit_majority(h[:, None]).view(np.int64)[0]) if len(h) else 0


def wide_fingerprint(text: str | None, k: int, words: int) -> tuple[np.ndarray, int]:
    """words * 64 bits, each 64 from another mix of the distinct shingles' hashes (repeats count once, as in jaccard()), and their number."""
    h = np.unique(shingle_hashes(text, k))
    if not len(h):
        return np.zeros(words, np.int64), 0
    x = h[:, None] + (np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return bit_majority(x ^ (x >> np.uint64(31))).view(np.int64), len(h)


def differing(x: np.ndarray) -> np.ndarray:
    """Set bits of 64-bit words; the sign bit is a bit like others."""
    return np.bitwise_count(np.ascontiguousarray(x).view(np.uint64)).astype(np.int64)


def neighbours(rows: DataFrame, check_bits: int, most: int) -> DataFrame:
    """rows(key, id) -> (a, b, far, big): candidate links, or in big a variant that needs the join. far: for a row a of a crowded variant the bits to its closest b, else null.

    From its high bits down a key holds the variant, whether the row is a visitor, and check_bits bits of the fingerprint; without check bits
    the id is the fingerprint itself. Rows are dealt out by ranges of (key, id), so a hot variant spreads over tasks; variants at the edges of tasks count as big.
    """

    def parts(key: np.ndarray, id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bits = key & ((1 << check_bits) - 1) if check_bits else id
        return key >> (check_bits + 1), (key >> check_bits) & 1 == 0, bits

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, id, hub = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        first = last = None
        length = homes = 0
        for pdf in frames:
            if not len(pdf):
                continue
            old = len(key)
            key, id = np.concatenate([key, pdf["key"].to_numpy(np.int64)]), np.concatenate([id, pdf["id"].to_numpy(np.int64)])
            variant, home, bits = parts(key, id)
            at = np.arange(len(key))
            start = np.maximum.accumulate(np.where(np.r_[True, variant[1:] != variant[:-1]], at, 0))
            new = at[old:]
            runs, begin, counts = np.unique(variant[old:], return_index=True, return_counts=True)
            owners = np.add.reduceat(home[old:].astype(np.int64), begin)
            if last is not None and runs[0] == last:
                counts[0] += length
                owners[0] += homes
            crowded = (counts > LAGS + 1) & (owners > 1)  # those with one at home come first in their variant and were compared with all
            found = []
            for lag in range(1, LAGS + 1):
                j = at[max(lag, old) :]
                found.append((j, j - lag))
            found.append((new, start[new]))
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            ok = (variant[a] == variant[b]) & (home[a] | home[b]) & (id[a] != id[b])
            a, b = a[ok], b[ok]
            far = differing(bits[a] ^ bits[b])
            ok = far <= most
            a, b, far = a[ok], b[ok], far[ok]
            order = np.lexsort((b, far, a))  # a row of a crowded variant, which the join finishes, keeps its closest one only
            a, b, far = a[order], b[order], far[order]
            many = np.repeat(crowded, np.diff(np.r_[begin, len(new)]))[a - old]
            one = many & np.r_[True, a[1:] != a[:-1]][: len(a)]
            pair = [np.stack([id[a[~many]], id[b[~many]]], 1)]
            closest = [np.stack([id[a[one]], id[b[one]], far[one]], 1)]
            if hub is not None and old and start[old] == 0 and variant[old] == hub[0]:  # the variant began in an earlier batch
                run_on = new[start[new] == 0]
                far = differing(bits[run_on] ^ hub[2])
                ok = (far <= most) & (id[run_on] != hub[1]) & (home[run_on] | hub[3])
                near = np.stack([id[run_on[ok]], np.full(ok.sum(), hub[1]), far[ok]], 1)
                if crowded[0]:
                    closest.append(near)
                else:
                    pair.append(near[:, :2])
            pairs = np.unique(np.sort(np.concatenate(pair), 1), axis=0)
            nearest = np.concatenate(closest)
            nearest = nearest[np.lexsort((nearest[:, 1], nearest[:, 2], nearest[:, 0]))]
            nearest = nearest[np.r_[True, nearest[1:, 0] != nearest[:-1, 0]][: len(nearest)]]
            big = runs[crowded]
            if first is None:
                first = runs[0]
            length, homes, last = int(counts[-1]), int(owners[-1]), runs[-1]
            i = start[-1]
            if hub is None or hub[0] != variant[i]:
                hub = (variant[i], id[i], bits[i], home[i])
            key, id = key[-LAGS:], id[-LAGS:]
            zeros = np.zeros(len(big), np.int64)
            columns = {"a": np.r_[pairs[:, 0], nearest[:, 0], zeros], "b": np.r_[pairs[:, 1], nearest[:, 1], zeros]}
            far, variant = [None] * len(pairs) + nearest[:, 2].tolist() + [None] * len(big), [None] * (len(pairs) + len(nearest)) + big.tolist()
            yield pd.DataFrame(columns | {"far": pd.array(far, "Int64"), "big": pd.array(variant, "Int64")})
        if first is not None:
            edges = sorted({int(first), int(last)})
            yield pd.DataFrame({"a": 0, "b": 0, "far": pd.array([None] * len(edges), "Int64"), "big": pd.array(edges, "Int64")})

    return rows.repartitionByRange("key", "id").sortWithinPartitions("key", "id").mapInPandas(run, "a long, b long, far long, big long")


def across(rows: DataFrame, big: DataFrame, label: DataFrame, check_bits: int, most: int, wide: DataFrame | None, parts: list[Callable[[Column], Column]], bits_each: int, close: Callable[[str, str], Column] | None, apart: Callable[[str, str], Column] | None) -> DataFrame:
    """Candidate links (a, b; bits, if apart() is given), of wide fingerprints those that close() takes, inside big variants between different components: every member outside a variant's largest component against all its others.

    A pair is taken in its first segment of at most one differing bit. Were the variant of that one not big, or held by one component, the pair would have
    been compared, or linked, before. A variant of very many rows is dealt out by salts.
    """
    bits = F.col("key").bitwiseAND((1 << check_bits) - 1) if check_bits else F.col("id")
    members = only(rows.select(F.shiftright("key", check_bits + 1).alias("variant"), (F.shiftright("key", check_bits).bitwiseAND(1) == 0).alias("home"), "id", bits.alias("bits")), big.select(F.col("big").alias("variant")).distinct())
    # Kept, as it is read twice and follows from all keys of all rows.
    labelled = members = cut(members.join(label, "id", "left").select("variant", "home", "id", "bits", F.coalesce("component", "id").alias("component")), "labelled")
    sizes = members.groupBy("variant", "component").agg(F.count("*").alias("n"), F.count_if("home").alias("homes"))
    mixed = sizes.groupBy("variant").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("homes").alias("homes"), F.sum("n").alias("n")).where("parts > 1 AND homes > 0")
    salts = F.ceil(F.col("n") / SALTED_ROWS).cast("int")
    members = members.join(mixed.select("variant", "main", salts.alias("salts")), "variant")
    members = cut(members.withColumn("fp", F.col("id")) if wide is None else members.join(wide, "id"), "members")
    drop_cuts(labelled)
    few = members.where("component <> main").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("x")
    every = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")).alias("y")
    near = (F.col("x.component") != F.col("y.component")) & (F.col("x.home") | F.col("y.home")) & (F.bit_count(F.col("x.bits").bitwiseXOR(F.col("y.bits"))) <= most)
    differ = F.array(*[F.bit_count(part(F.col("x.fp")).bitwiseXOR(part(F.col("y.fp")))) for part in parts])
    if close is not None:
        near = near & close("x.", "y.")
    near = near & (F.array_position(F.transform(differ, lambda d: d <= 1), True) - 1 == F.shiftright("x.variant", bits_each))
    found = few.join(every, (F.col("x.variant") == F.col("y.variant")) & (F.col("x.salt") == F.col("y.salt")) & near)
    bits = [] if apart is None else [apart("x.", "y.").alias("bits")]
    return found.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"), *bits).distinct()


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """label(id, component) after further links (a, b): only the components that they touch are worked on."""
    of = lambda x: label.select(F.col("id").alias(x), F.col("component").alias(f"c{x}"))
    over = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    roots = components(over.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    new = over.where("ca IS NULL").select("a").union(over.where("cb IS NULL").select("b")).distinct()
    every = label.select("id", "component").union(new.select(F.col("a"), F.col("a")))
    return cut(every.join(roots.toDF("component", "least"), "component", "left").select("id", F.coalesce("least", "component").alias("component")), "merged")


def linked(rows: DataFrame, check_bits: int, most: int, parts: list[Callable[[Column], Column]], bits_each: int, wide: DataFrame | None = None, close: Callable[[str, str], Column] | None = None, apart: Callable[[str, str], Column] | None = None, verify: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None) -> DataFrame:
    """rows(key, id) -> (id, component) of all ids with a link. parts: the segments of a fingerprint (of wide(id, fp, n); None: of the id itself).
    close(x, y): whether two rows of wide, under these prefixes, may be a link; apart(x, y): their differing bits.
    verify(candidates, labels so far) gives the true links; None: all candidates are. With labels, candidates have passed close() and carry its bits."""
    verify = verify or (lambda pairs, _: pairs)
    near = cut(neighbours(rows, check_bits, most), "near")
    closest = near.where("far IS NOT NULL").groupBy("a").agg(F.min(F.struct("far", "b")).alias("x"))
    pairs = near.where("far IS NULL AND big IS NULL").select("a", "b").union(closest.select(F.least("a", "x.b"), F.greatest("a", "x.b"))).distinct()
    links = cut(verify(pairs, None), "found")
    label = components(links)
    more = cut(verify(across(rows, near.where("big IS NOT NULL"), label, check_bits, most, wide, parts, bits_each, close, apart), label), "found")
    if not more.isEmpty():
        label = merged(label, more)
    drop_cuts(near, links, more)
    return label


def variants(segment: Column, number: int, bits: int) -> Column:
    """The segment's own variant and those it visits: segment number, value, and a last bit that is set for visits."""
    own = F.lit(number).cast("long") * (1 << bits) + segment
    unset = F.filter(F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda j: F.call_function("shiftleft", F.lit(1).cast("long"), j)), lambda b: segment.bitwiseAND(b) == 0)
    return F.concat(F.array(own * 2), F.transform(unset, lambda b: (own + b) * 2 + 1))


def spread(nodes: DataFrame) -> DataFrame:
    """nodes in as many tasks as a shuffle has: each makes many keys of a row, so few files must not mean few tasks."""
    return nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", k: int = 3, most: int = 3) -> DataFrame:
    """id, fingerprint (16 hexadecimal digits), component_id: the smallest id reachable over fingerprints at most 3 bits apart."""
    if not 0 <= most <= 3:
        raise ValueError("two segments serve distances up to 3")
    make = lambda ts: pd.DataFrame({"fp": [fingerprint(t, k) for t in ts]})
    prints = cut(by_text(df, make, "fp long", [id], text), "prints")
    nodes = prints.groupBy(F.col("fp").alias("id")).agg(F.min(id).alias("least"))
    halves = [lambda fp: fp.bitwiseAND(0xFFFFFFFF), lambda fp: F.shiftrightunsigned(fp, 32)]
    keys = F.concat(*[variants(half(F.col("id")), i, 32) for i, half in enumerate(halves)])
    label = linked(spread(nodes).select(F.explode(keys).alias("key"), "id"), 0, most, halves, 32)
    named = nodes.join(label, "id", "left").select(F.col("id").alias("fp"), "least", F.coalesce("component", "id").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named.join(smallest, "component").select("fp", "component_id")
    return prints.join(classes, "fp").select(id, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: The wide fingerprint of similarity search: all WORDS * 64 bits are compared, segments of them are indexed, and up to CHECK further bits ride along.
WORDS, CHECK = 24, 34
#: A segment has BITS bits for up to TEXTS texts, and one more for each doubling up to MOST_BITS, where segments take up all bits that are not checked.
BITS, TEXTS, MOST_BITS = 20, 2**17, 28
#: Of two texts at a Jaccard similarity of 0.8 the share of bits that differ, and how often they may have no segment in common.
APART, MISSED = math.acos(8 / 9) / math.pi, 0.05
#: Differing bits of all that a candidate may have: 3 standard deviations above what a Jaccard similarity of 0.8 gives.
WIDE_MOST = 278
#: Texts of up to FEW shingles may differ in more bits: one shingle more or less tips many of their majorities.
FEW, FEW_MOST = 16, 350


def layout(texts: int) -> tuple[int, int, int, int]:
    """(bits of a segment, segments, check bits, differing check bits that a candidate may have) for so many texts.

    With the texts the bits grow, so a variant holds as few rows (under 2 on average, while bits grow) and few need the join, and with the bits the
    segments, so that a pair is found as often. Check bits are what a key of 63 bits has left; 3 standard deviations of differing ones are allowed."""
    bits = min(MOST_BITS, BITS + max(0, math.ceil(math.log2(max(texts, 1) / TEXTS))))
    meet = (1 - APART) ** bits + bits * APART * (1 - APART) ** (bits - 1)
    segments = math.ceil(math.log(MISSED) / math.log(1 - meet))
    check = min(CHECK, 62 - bits - (segments - 1).bit_length())
    return bits, segments, check, int(check * APART + 3 * math.sqrt(check * APART * (1 - APART)))


def segment(words: Column, i: int, bits: int = BITS) -> Column:
    """Bits i * bits to (i + 1) * bits of an array of 64-bit words."""
    at, shift = divmod(i * bits, 64)
    out = F.shiftrightunsigned(F.get(words, F.lit(at)), shift)
    if shift + bits > 64:
        out = out.bitwiseOR(F.shiftleft(F.get(words, F.lit(at + 1)), 64 - shift))
    return out.bitwiseAND((1 << bits) - 1)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, k))


def jaccard(a: str | None, b: str | None, k: int) -> float:
    return overlap(shingle_set(a, k), shingle_set(b, k))


def overlap(x: np.ndarray, y: np.ndarray) -> float:
    """Shared over all values of two sorted sets; 1 for two empty ones."""
    if not len(x) and not len(y):
        return 1.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def node(text: Column) -> Column:
    """What stands for a text: a hash, so that equal texts are one node whatever their ids."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def similar_groups(df: DataFrame, id: str = "doc_id", text: str = "text", k: int = 5, least: float = 0.8) -> DataFrame:
    """(id, node, component, first): for every row with an id its text's node, the smallest id of its group, and whether it is that id's row
    (with the least node, should it have several texts). Groups are linked by equal texts or a Jaccard similarity of k-word shingles of at least `least`.

    Candidates share a one-wildcard variant of one of the segments (layout()); a pair at similarity 0.8 does with probability 0.95, at 0.85 with 0.99,
    at 0.9 with 0.999. Each candidate is verified on whole texts, closest first; pairs whose groups have meanwhile been linked need no verifying.
    """
    known = df.where(F.col(f"`{id}`").isNotNull()).select(F.col(f"`{id}`").alias("id"), node(F.col(f"`{text}`")).alias("node"), F.col(f"`{text}`").alias("text"))
    make = lambda ts: pd.DataFrame([wide_fingerprint(t, k, WORDS) for t in ts], columns=["fp", "n"])
    prints = cut(by_text(known, make, "fp array<long>, n long", ["id", "node"]), "prints")
    nodes = cut(prints.groupBy(F.col("node").alias("id")).agg(F.any_value("fp").alias("fp"), F.any_value("n").alias("n")), "nodes")
    bits, segments, check_bits, most = layout(nodes.count())
    check = F.shiftrightunsigned(F.get("fp", F.lit(WORDS - 1)), 64 - check_bits)
    parts = [partial(segment, i=i, bits=bits) for i in range(segments)]
    keys = F.concat(*[variants(part(F.col("fp")), i, bits) for i, part in enumerate(parts)])
    rows = spread(nodes).select(F.explode(F.transform(keys, lambda x: F.shiftleft(x, check_bits).bitwiseOR(check))).alias("key"), "id")
    wide = nodes.select("id", "fp", "n")
    apart = lambda x, y: F.aggregate(F.zip_with(f"{x}fp", f"{y}fp", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda acc, x: acc + x)

    def close(x: str, y: str) -> Column:
        fewer, more = F.least(f"{x}n", f"{y}n"), F.greatest(f"{x}n", f"{y}n")
        return (fewer >= least * more - 1e-9) & (apart(x, y) <= F.when(fewer > FEW, WIDE_MOST).otherwise(FEW_MOST))

    held: list[DataFrame] = []

    def verify(pairs: DataFrame, label: DataFrame | None) -> DataFrame:
        if label is None:
            pairs = pairs.join(wide.toDF("a", "a_fp", "a_n"), "a").join(wide.toDF("b", "b_fp", "b_n"), "b").where(close("a_", "b_"))
            pairs = pairs.select("a", "b", apart("a_", "b_").alias("bits"))
        pairs = cut(pairs, "pairs")
        best = pairs.select("a", F.struct("bits", "b").alias("x"), "b").union(pairs.select(F.col("b"), F.struct("bits", "a"), F.col("a"))).toDF("a", "x", "b").groupBy("a").agg(F.min("x").alias("x"))
        chosen = best.select(F.least("a", "x.b").alias("a"), F.greatest("a", "x.b").alias("b")).distinct()
        one = cut(_similar(chosen, known, k, least), "similar")
        have = components(one) if label is None else merged(label, one)
        rest = pairs.join(chosen, ["a", "b"], "left_anti")
        side = lambda x: have.select(F.col("id").alias(x), F.col("component").alias(f"c{x}"))
        rest = rest.join(side("a"), "a", "left").join(side("b"), "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
        held.extend((pairs, one))
        return one.union(_similar(rest, known, k, least))

    label = linked(rows, check_bits, most, parts, bits, wide, close, apart, verify)
    drop_cuts(*held)
    named = prints.groupBy("node").agg(F.min("id").alias("least")).join(label.withColumnRenamed("id", "node"), "node", "left").select("node", "least", F.coalesce("component", "node").alias("group"))
    heads = named.groupBy("group").agg(F.min(F.struct("least", "node")).alias("head"))
    classes = named.join(heads, "group").select("node", "head")
    return prints.select("id", "node").join(classes, "node").select("id", "node", F.col("head.least").alias("component"), ((F.col("id") == F.col("head.least")) & (F.col("node") == F.col("head.node"))).alias("first"))


def _similar(pairs: DataFrame, known: DataFrame, k: int, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts reach the similarity."""
    pairs = cut(pairs, "verify")
    ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = only(known.select("node", "text"), ids).dropDuplicates(["node"])  # equal texts
    both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        held = 0

        def shingles(node: int, text: pa.Scalar) -> np.ndarray:
            nonlocal held
            if node not in seen:
                if held > MOST_SHINGLES:
                    seen.clear()
                    held = 0
                seen[node] = shingle_set(text.as_py(), k)
                held += len(seen[node])
            return seen[node]

        for batch in batches:
            a, b, ta, tb = (batch.column(c) for c in ("a", "b", "ta", "tb"))
            ok = [overlap(shingles(i, x), shingles(j, y)) >= least for i, j, x, y in zip(a.to_pylist(), b.to_pylist(), ta, tb, strict=True)]
            yield pa.RecordBatch.from_arrays([pc.filter(batch.column(c), pa.array(ok, pa.bool_())) for c in "ab"], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def only(df: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of df with (left_semi) or without (left_anti) one of the keys, by a broadcast of keys whose number is checked, else by a shuffle."""
    ids = cut(ids, "ids")
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, ids.columns, how)


def one_of_each(df: DataFrame, id: str = "doc_id", text: str = "text", k: int = 5, least: float = 0.8) -> DataFrame:
    """df with the row of the smallest id of every group; rows with a null id stay, and of equal rows of that id and text any one. Columns may have any names."""
    columns = df.columns
    df, own = set_aside(df)
    id, text = own[id], own[text]
    groups = cut(similar_groups(df, id, text, k, least), "groups")
    names = {"id": "__near_id", "node": "__near_node"}
    keys = lambda rows: rows.select(*[F.col(a).alias(b) for a, b in names.items()])
    keyed = df.withColumns({"__near_id": F.col(f"`{id}`"), "__near_node": node(F.col(f"`{text}`"))})
    kept = only(keyed, keys(groups.where("not first")).distinct(), "left_anti")
    repeated = cut(keys(groups.where("first").groupBy("id", "node").count().where("count > 1")), "repeated")
    if not repeated.isEmpty():
        twice = only(kept, repeated).dropDuplicates(list(names.values()))
        kept = only(kept, repeated, "left_anti").unionByName(twice)
    return kept.drop(*names.values()).toDF(*columns)
