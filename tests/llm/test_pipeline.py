"""The whole pipeline against plain versions of its stages, and columns of any name."""

import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldseries.llm import mixing, passages, queries, repetition, simhash
from tests.llm.test_llm import WORDS, repeated

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = "n_words long, kept string, base_failed int, covered_words int, __near_id string, __near_node int, __t int, __id int, __gone int, copy int, shuffle_key int, __mix_rate int, __pii_parts int, n_entities int, id string, node int"


def fixture(seed=5):
    """Clean texts, near copies, repetitive and short ones, a text with personal data; one source holds most rows."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(400)]
    words = lambda n: [r.choice(vocab) for _ in range(n)]
    texts = []
    for i in range(60):
        w = words(r.randint(60, 200))
        texts.append(" ".join(w))
        if i % 6 == 0:  # one word of many changed: similarity above 0.9
            w[30] = "changed"
            texts.append(" ".join(w))
        if i % 10 == 0:
            texts.append(texts[-1])
    texts += [" ".join(words(10)), " ".join(words(6) * 20), " ".join(words(100) + words(7) * 9), None, "", " ".join(words(3000))]
    texts.append(" ".join(words(40)) + " write to anna.berg@mail1.example.com today")
    return [(i, t, "en", "big" if i % 4 else f"small{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]


def quality_keeps(t):
    w = WORDS.findall(t or "")
    if len(w) < 20 or 100 * len(repeated(w, 8)) > 30 * len(w):
        return False
    return len(repeated(w, 5)) <= 0.3 * len(w) and not repeated(w, 101)


def first_of_groups(docs):
    """The smallest id of each component of texts whose five-word shingles agree to 0.8, all pairs compared."""
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in docs if (w := WORDS.findall(t.lower())) is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {find(i) for i in sets}


def test_run_equals_plain_stages(spark, tmp_path):
    import corpus_pipeline

    rows = fixture()
    spark.createDataFrame(rows, DOCUMENTS).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = [r for r in rows if quality_keeps(r[1])]
    assert 50 < len(kept) < len(rows) - 4
    heads = first_of_groups([(r[0], r[1]) for r in kept])
    assert len(kept) - len(heads) >= 10
    left = [r for r in kept if r[0] in heads]
    decoded = {r["doc_id"]: r["decoded"] for r in got}
    # Surrogates keep the length of an address's parts or not: its new text is read back from the result.
    mail = next(r[0] for r in rows if r[1] and "@" in r[1])
    assert mail not in decoded or ("berg" not in decoded[mail] and "@" in decoded[mail])
    own = corpus_pipeline.surrogates(spark, spark.createDataFrame([rows[mail]], DOCUMENTS), "").first()["text"]
    assert re.fullmatch(r"(?s)(.*) write to [a-z]+\.[a-z]+@\S+ today", own)[1] == re.fullmatch(r"(?s)(.*) write to \S+ today", rows[mail][1])[1]
    texts = {r[0]: own if r[0] == mail else r[1] for r in left}
    size = Counter()
    for r in left:
        size[r[3]] += len(texts[r[0]].encode()) + 1
    target = {s: n**0.7 for s, n in size.items()}
    rate = {s: size.total() / sum(target.values()) * target[s] / size[s] for s in size}
    drawn = {x["doc_id"]: x["u"] for x in spark.createDataFrame([(r[0],) for r in left], "doc_id long").select("doc_id", mixing.uniform(F.lit(42), F.col("doc_id"), F.lit(1)).alias("u")).collect()}

    def count(doc, lam):
        k, p, total = 0, math.exp(-lam), math.exp(-lam)
        while total <= drawn[doc]:
            k += 1
            p *= lam / k
            total += p
        return k

    assert max(rate.values()) < mixing.PIECE
    want = Counter({r[0]: n for r in left if (n := count(r[0], rate[r[3]]))})
    assert Counter(r["doc_id"] for r in got) == want
    model = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    for r in got:
        ids = model.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["decoded"] == model.decode(ids, skip_special_tokens=False)


def test_the_empty_table_runs_through(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.fixture
def clashing(spark):
    rows = [(*r, 7, "mine", *[5] * 2, "near", *[5] * 9, "id", 9) for r in fixture()]
    return spark.createDataFrame(rows, f"{DOCUMENTS}, {CLASHES}").repartition(4)


def test_stages_keep_columns_of_any_name(spark, clashing):
    import corpus_pipeline

    plain = clashing.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made, want = stage(spark, clashing, ""), stage(spark, plain, "")
        assert made.columns == clashing.columns, name
        found = made.collect()
        assert Counter((r["doc_id"], r["text"], r["n_chars"]) for r in found) == Counter((r["doc_id"], r["text"], r["n_chars"]) for r in want.collect()), name
        assert {tuple(r)[5:] for r in found} == {(7, "mine", *[5] * 2, "near", *[5] * 9, "id", 9)}, name
    assert corpus_pipeline.bpe_encode(spark, clashing, "").columns == ["doc_id", "source", "ids", "decoded"]


def test_operators_keep_columns_of_any_name(spark, clashing):
    for made in (repetition.passing(clashing), simhash.one_of_each(clashing), passages.without_repeats(clashing)):
        assert made.columns == clashing.columns
        assert {tuple(r)[5:] for r in made.collect()} == {(7, "mine", *[5] * 2, "near", *[5] * 9, "id", 9)}
