"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions only.

A text is cut into paragraphs (lines, cut further at sentence ends) and each distinct paragraph hashed to 64 bits. A sketch
has three rows of WIDTH cells, whatever the length of the text: it is sized for what two versions differ in. A cell holds the number
of its digests, their exclusive-or and that of their check hashes; the fingerprint is these cells. Fingerprints of two versions subtract
cell by cell; peeling takes cells left with one digest, removes it from its other cells and goes on until every cell is empty: what
was taken are the digests only one version has. If cells remain, the pair is tried again with larger sketches: its digests are dealt out by
their hash to up to MOST_TABLES tables, each with cells of its own and other hashes, and tables that fail are dealt out again. A pair that still
fails after LEVELS levels (its digests share cells at every level) is settled by the exact difference of its few digests. The
work is proportional to the paragraphs times the levels, so it grows no faster than the text.

Defined results: a null text is an empty one; an empty text has no paragraph, and two such texts have likeness 1; repeated rows
give equal rows (ties of the id are ordered by a hash of the text); rows with a null id come last in the descending order; one
row alone is followed by itself; an empty table gives an empty table; other columns are not read. Ids are of any integer type.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a row, rounds of peeling; differing digests a larger sketch's table is made for, tables that a failed pair is dealt out to at most, and how often.
WIDTH, ROUNDS, LOAD, MOST_TABLES, LEVELS = 8, 16, 12, 64, 6
#: A paragraph ends at a line break or at white space behind a sentence's end.
BREAKS = r"\n+|(?<=[.!?])\s+"


def paragraphs(text: Column) -> Column:
    """Distinct 64-bit digests of the text's paragraphs."""
    return F.array_distinct(F.transform(F.filter(F.split(text, BREAKS), lambda p: p != ""), lambda p: F.xxhash64(p)))


def _let(value: Column, body) -> Column:  # noqa: ANN001
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _placed(digests: Column, level: Column, sign: int = 1) -> Column:
    """Each digest with its sign, its check hash and its cell in every row of cells."""

    def of(k: Column) -> Column:
        place = lambda h, r: F.shiftright(h, 20 * r).bitwiseAND(WIDTH - 1).cast("int").alias(f"p{r}")
        return _let(F.xxhash64(k, level), lambda h: F.struct(F.lit(sign).alias("n"), k.alias("k"), F.xxhash64(k).alias("c"), *[place(h, r) for r in range(3)]))

    return F.transform(digests, of)


def _add(cell: Column, d: Column, sign: int) -> Column:
    n = cell["n"] + d["n"] if sign > 0 else cell["n"] - d["n"]
    return F.struct(n.alias("n"), cell["k"].bitwiseXOR(d["k"]).alias("k"), cell["c"].bitwiseXOR(d["c"]).alias("c"))


def cells(digests: Column, level: Column) -> Column:
    """struct(r0, r1, r2): the three rows of cells."""
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c"))

    def row(placed: Column, r: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda i: F.aggregate(F.filter(placed, lambda d: d[f"p{r}"] == i), empty, lambda acc, d: _add(acc, d, 1)))

    return _let(_placed(digests, level), lambda placed: F.struct(*[row(placed, r).alias(f"r{r}") for r in range(3)]))


def subtract(left: Column, right: Column) -> Column:
    return F.struct(*[F.zip_with(left[f"r{r}"], right[f"r{r}"], lambda a, b: _add(a, b, -1)).alias(f"r{r}") for r in range(3)])


def differing(less: Column) -> Column:
    """About how many digests a pair differs in, from its subtracted cells: what both sides have cancels, and each of d others adds 1 or -1 to one cell of
    a row, so that the squares of a row's numbers sum to d + (s * s - d) / WIDTH on average, s being the sum of the numbers."""
    squares = F.aggregate(F.concat(*[less[f"r{r}"] for r in range(3)]), F.lit(0.0), lambda q, x: q + x["n"].cast("double") * x["n"])
    total = F.aggregate(less["r0"], F.lit(0.0), lambda n, x: n + x["n"])
    return F.ceil((squares * WIDTH / 3 - total * total) / (WIDTH - 1)).cast("int")


def peel(difference: Column, level: Column) -> Column:
    """struct(left, right): the digests recovered; null if cells remain."""
    none = F.array().cast("array<bigint>")
    names = ["r0", "r1", "r2"]
    start = F.struct(*[difference[n].alias(n) for n in names], none.alias("left"), none.alias("right"), F.lit(True).alias("going"))

    def pure(acc: Column) -> Column:
        single = F.filter(F.concat(*[acc[n] for n in names]), lambda x: (F.abs(x["n"]) == 1) & (F.xxhash64(x["k"]) == x["c"]))
        of = lambda found, sign: F.array_distinct(F.transform(F.filter(found, lambda x: x["n"] == sign), lambda x: x["k"]))  # noqa: E731 - numbers, told apart by their hash
        return _let(single, lambda x: F.when(F.size(x) > 0, F.concat(_placed(of(x, 1), level, 1), _placed(of(x, -1), level, -1))))

    def without(found: Column, place: str):  # noqa: ANN202
        return lambda x, i: F.aggregate(F.filter(found, lambda d: d[place] == i), x, lambda cell, d: _add(cell, d, -1))

    def step(acc: Column, _: Column) -> Column:
        def go(found: Column) -> Column:
            keys = lambda sign: F.transform(F.filter(found, lambda d: d["n"] == sign), lambda d: d["k"])
            less = [F.transform(acc[n], without(found, f"p{r}")).alias(n) for r, n in enumerate(names)]
            more = F.struct(*less, F.concat(acc["left"], keys(1)).alias("left"), F.concat(acc["right"], keys(-1)).alias("right"), F.lit(True).alias("going"))
            return F.when(found.isNotNull(), more).otherwise(F.struct(*[acc[n].alias(n) for n in [*names, "left", "right"]], F.lit(False).alias("going")))

        return F.when(acc["going"], _let(pure(acc), go)).otherwise(acc)

    def finish(acc: Column) -> Column:
        clear = F.forall(acc["r0"], lambda x: (x["n"] == 0) & (x["k"] == 0) & (x["c"] == 0))  # every digest is in each row
        return F.when(clear, F.struct(acc["left"].alias("left"), acc["right"].alias("right")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, finish)


def difference(left: Column, right: Column, known: Column | None = None) -> Column:
    """struct(left, right): digests that only one side has, recovered from subtracted sketches. known: the subtracted cells of the first level, if they are at hand."""
    none = F.array().cast("array<bigint>")
    pair = F.struct(left.alias("a"), right.alias("b"))

    def tried(p: Column, level: Column, less: Column | None = None) -> Column:
        """The pair, what its subtracted cells give, and how many digests its sides seem to differ in. Each sketch is computed once."""
        if less is None:
            less = _let(F.struct(cells(p["a"], level).alias("a"), cells(p["b"], level).alias("b")), lambda s: subtract(s["a"], s["b"]))
        return _let(less, lambda x: F.struct(p.alias("p"), peel(x, level).alias("d"), differing(x).alias("e")))

    def sum_up(acc: Column, found: Column) -> Column:
        """The state after a level: what was recovered, and the pairs that failed."""
        done = F.filter(found, lambda x: x["d"].isNotNull())
        gained = lambda side: F.concat(acc[side], F.flatten(F.transform(done, lambda x: x["d"][side]))).alias(side)
        return F.struct(gained("left"), gained("right"), F.transform(F.filter(found, lambda x: x["d"].isNull()), lambda x: F.struct(x["p"]["a"].alias("a"), x["p"]["b"].alias("b"), x["e"].alias("e"))).alias("open"))

    def dealt(pairs: Column, level: Column) -> Column:
        """Failed pairs by their digests' hash, into 2 to MOST_TABLES tables of about LOAD differing digests each, as the failed cells tell."""
        tables = lambda p: F.greatest(F.lit(2), F.least(F.lit(MOST_TABLES), F.ceil(F.least(p["e"], F.size(p["a"]) + F.size(p["b"])) / LOAD).cast("int")))
        numbered = lambda ks, t: F.transform(ks, lambda k: F.struct(F.pmod(F.xxhash64(F.lit(-1), level, k), t).cast("int").alias("t"), k.alias("k")))
        part = lambda ks, i: F.transform(F.filter(ks, lambda x: x["t"] == i), lambda x: x["k"])
        spread = lambda x: F.transform(F.sequence(F.lit(0), x["t"] - 1), lambda i: F.struct(part(x["a"], i).alias("a"), part(x["b"], i).alias("b")))
        return F.flatten(F.transform(pairs, lambda p: _let(_let(tables(p), lambda t: F.struct(t.alias("t"), numbered(p["a"], t).alias("a"), numbered(p["b"], t).alias("b"))), spread)))

    def step(acc: Column, level: Column) -> Column:
        return F.when(F.size(acc["open"]) > 0, _let(F.transform(dealt(acc["open"], level), lambda p: tried(p, level)), lambda found: sum_up(acc, found))).otherwise(acc)

    def settle(acc: Column) -> Column:
        rest = lambda a, b: F.flatten(F.transform(acc["open"], lambda p: F.array_except(p[a], p[b])))
        return F.struct(F.concat(acc["left"], rest("a", "b")).alias("left"), F.concat(acc["right"], rest("b", "a")).alias("right"))

    empty = F.struct(none.alias("left"), none.alias("right"), F.array().cast("array<struct<a:array<bigint>,b:array<bigint>,e:int>>").alias("open"))
    start = _let(F.array(tried(pair, F.lit(0), known)), lambda found: sum_up(empty, found))
    return F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), start, step, settle)


def sketch(digests: Column) -> Column:
    """A text's own cells."""
    return cells(digests, F.lit(0))


def fingerprint(sketch_cells: Column) -> Column:
    """The cells as text: base 64 of 20 bytes a cell (number, exclusive-or, exclusive-or of check hashes)."""
    one = lambda x: F.concat(F.lpad(F.hex(x["n"]), 8, "0"), F.lpad(F.hex(x["k"]), 16, "0"), F.lpad(F.hex(x["c"]), 16, "0"))
    return F.translate(F.base64(F.unhex(F.array_join(F.transform(F.concat(*[sketch_cells[f"r{r}"] for r in range(3)]), one), ""))), "\r\n", "")


def unpack(text: Column) -> Column:
    """The cells of a fingerprint, so that two of them can be subtracted and peeled without their texts."""
    raw = F.hex(F.unbase64(text))
    part = lambda h, at, n: F.conv(F.substring(h, at, n), 16, -10).cast("long")  # noqa: E731 - signed, as the bits are
    one = lambda h, i: _let(F.substring(h, F.lit(1) + 40 * i, F.lit(40)), lambda x: F.struct(part(x, 1, 8).cast("int").alias("n"), part(x, 9, 16).alias("k"), part(x, 25, 16).alias("c")))
    return _let(raw, lambda h: F.struct(*[F.transform(F.sequence(F.lit(r * WIDTH), F.lit((r + 1) * WIDTH - 1)), lambda i: one(h, i)).alias(f"r{r}") for r in range(3)]))


def likeness(left: Column, right: Column, known: Column | None = None) -> Column:
    """Shared over all distinct paragraphs, from the digests that the sketches' difference gives."""

    def of(d: Column) -> Column:
        every = F.size(left) + F.size(d["right"])
        return F.when(every == 0, F.lit(1.0)).otherwise((F.size(left) - F.size(d["left"])) / every)

    return _let(difference(left, right, known), of)


def with_next(df: DataFrame, id: str, text: str, rows_per_bucket: int = 1000, most_buckets: int = 65_536) -> DataFrame:
    """id, text and next_text: the text of the next row in descending id order, the first's after the last.

    Ids are cut at quantiles into buckets that are ordered one by one; each bucket also gets, as an extra row, the row that follows
    its last, so that the texts are shuffled once and no task sees all rows.
    """
    rows = df.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    ids = rows.select("id")
    total = ids.count()
    n = min(most_buckets, max(1, total // rows_per_bucket))
    ids = ids.sample(min(1.0, 200 * n / max(1, total)), 7)  # for the places of the cuts only, which balance the buckets
    cuts = sorted(set(ids.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 4 * n)).first()[0] or [])) if n > 1 else []
    if cuts:
        splits = F.from_json(F.lit(json.dumps(cuts)), "array<bigint>")
        low = lambda acc, step: F.when((acc + step <= len(cuts)) & (F.get(splits, acc + step - 1) <= F.col("id")), acc + step).otherwise(acc)
        bucket = F.coalesce(F.aggregate(F.array(*[F.lit(1 << p) for p in range(len(cuts).bit_length() - 1, -1, -1)]), F.lit(0), low), F.lit(0))
    else:
        bucket = F.lit(0)
    placed = rows.withColumn("bucket", F.when(F.col("id").isNull(), 0).otherwise(bucket).cast("int"))
    tops = [(r["bucket"], r["id"]) for r in placed.select("id", "bucket").groupBy("bucket").agg(F.max("id").alias("id")).orderBy(F.desc("bucket")).collect()]  # at most most_buckets
    following = [(top, tops[(i - 1)][0]) for i, (_, top) in enumerate(tops)]  # the top row of each bucket ends the bucket above it
    first = df.sparkSession.createDataFrame(following, "id long, ends int")
    ghosts = rows.join(F.broadcast(first), rows["id"].eqNullSafe(first["id"])).select(rows["id"], "text", F.col("ends").alias("bucket"))
    both = placed.withColumn("ghost", F.lit(0)).unionByName(ghosts.withColumn("ghost", F.lit(1)))
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc_nulls_last("id"), F.xxhash64("text"))
    return both.withColumn("next_text", F.lead("text").over(order)).where("ghost = 0").select("id", "text", "next_text")


def fingerprint_versions(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its edited text (the last third replaced by the start of the next row's text), and likenesses to both."""
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = with_next(df, id, text).withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) as int))"), F.substring(F.col("next_text"), F.lit(1), third)))
    hashed = edited.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), paragraphs(F.col("text")).alias("own"), paragraphs(F.col("edited")).alias("new"), paragraphs(F.col("next_text")).alias("next"))
    made = hashed.withColumn("cells", sketch(F.col("own"))).withColumn("new_cells", sketch(F.col("new")))
    near = likeness(F.col("own"), F.col("new"), subtract(F.col("cells"), F.col("new_cells")))
    near_next = likeness(F.col("own"), F.col("next"), subtract(F.col("cells"), sketch(F.col("next"))))
    return made.select(F.col("id").alias(id), "n_chars", "edited_sha256", fingerprint(F.col("cells")).alias("fingerprint"), fingerprint(F.col("new_cells")).alias("edited_fingerprint"), near.alias("near_edited"), near_next.alias("near_next"))
