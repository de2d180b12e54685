"""Spelling variants, packing and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fieldseries.llm import importance, packing, queries, spelling
from fieldseries.llm.common import cut
from tests.llm.test_llm import corpus, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DIR = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def misspelt(seed=3, n=200):
    """Texts of few long words with inserted, deleted and replaced letters, accents and capitals."""
    r = random.Random(seed)
    base = ["".join(r.choice("abcdeéß") for _ in range(r.randint(6, 9))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "abababab"]

    def one():
        w = r.choice(base)
        at = r.randrange(len(w))
        return r.choice([w, w, w, w.upper(), w[:at] + w[at + 1 :], w[:at] + r.choice("abé") + w[at:], w[:at] + r.choice("abé") + w[at + 1 :]])

    texts = [r.choice([" ", ", ", "\n"]).join(one() for _ in range(r.randint(0, 60))) for _ in range(n)]
    return [*texts, texts[0], texts[0], None, "", "123 !", " ".join(one() for _ in range(20_000)), "x" * 50_000]


def edits(w, letters):
    return {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + a + w[i + d :] for a in letters for i in range(len(w) + 1) for d in (0, 1)}


def plain_variants(pairs):
    count = Counter()
    for i, t in pairs:
        for w in re.findall(spelling.RUNS, (t or "").translate(LOWER)):
            h = zlib.crc32(f"{i}:{w}".encode())
            count[w[: h % len(w)] + w[h % len(w) + 1 :] if i is not None and h % 199 == 0 else w] += 1
    n = {w: c for w, c in count.items() if c >= 5 and len(w) >= 6}
    letters = {c for w in n for c in w}
    near = {w: [v for v in edits(w, letters) if v != w and v in n] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: v for w, v in best.items() if n[v] >= 5 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


@pytest.mark.parametrize("most", [20_000, 7])
def test_spelling_variants_equal_brute_force(spark, monkeypatch, most):
    """With few words a piece, every crowded half is dealt over several automata."""
    texts = misspelt()
    docs = frame(spark, texts, [None if i == 5 else i for i in range(len(texts))])
    monkeypatch.setattr(spelling, "MOST_HELD", 50)
    got = spelling.group_variants(cut(spelling.word_counts(docs), "words"), most=most).collect()
    want = plain_variants([(None if i == 5 else i, t) for i, t in enumerate(texts)])
    assert sorted(map(tuple, got), key=lambda x: x[0]) == want
    assert sum(w[1] is not None for w in want) > 50


def test_automata_number_their_words_and_complete_with_one_error():
    r = random.Random(2)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(3, 7))) for _ in range(300)})
    machine = spelling.Automaton(words)
    assert [machine.number(w) for w in words] == list(range(len(words)))
    assert machine.number("zzz") is None and spelling.Automaton([]).near("a", "b") == []
    for w in words[::7]:
        half, rest = w[: len(w) // 2], w[len(w) // 2 :]
        assert {words[i] for i in machine.near(half, rest)} - {w} == {v for v in words if v != w and v.startswith(half) and v[len(half) :] in edits(rest, "abc")}


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(11)]
    assert {r["root"] for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()} == {"w11"}


def one_by_one(sizes, capacity):
    """Best two fit, a bin at a time."""
    left, bins = Counter(sizes), []
    while left:
        bin_, gap = [], capacity
        while fits := [s for s in left if s <= gap]:
            s = max(fits)
            bin_.append(s)
            gap -= s
            left -= Counter([s])
        if gap:
            small = bin_[-1]
            pairs = [(a + b, a, b) for a in left for b in left if b <= a and (a != b or left[a] > 1) and small < a + b <= small + gap]
            if pairs:
                _, a, b = max(pairs)
                bin_[-1:] = [a, b]
                left += Counter([small])
                left -= Counter([a, b])
        bins.append(tuple(sorted(bin_, reverse=True)))
    return Counter(bins)


@pytest.mark.parametrize("capacity", [7, 30, 64])
def test_best_two_fit_equals_packing_one_bin_at_a_time(capacity):
    for seed in range(40):
        r = random.Random(seed)
        low, high = r.choice([(1, capacity), (capacity // 4 + 1, capacity), (capacity // 3, capacity // 2)])
        sizes = [r.randint(max(1, low), max(1, high)) for _ in range(r.randint(0, 150))]
        made = Counter()
        for repeats, bin_ in packing.best_two_fit(Counter(sizes), capacity):
            made[tuple(s for s, k in bin_ for _ in range(k))] += repeats
        assert made == one_by_one(sizes, capacity)


def test_segments_encode_as_whole_texts():
    r, model = random.Random(1), Tokenizer.from_file(TOKENIZER)
    parts = ["a", "Ab", " ", "  ", "\n", "\n\n", "\t", "1", "23", ".", "!?", "'s", "'", "é", "文", "\x1c", "\x85", "\xa0", "<|endoftext|>", "x" * 70, "\r\n", " ll", "'ll"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(5000)]
    want = [np.array(e.ids, "<u4").tobytes() for e in model.encode_batch(texts, add_special_tokens=False)]
    with open(TOKENIZER, encoding="utf-8") as f:
        assert packing.Encoder(f.read()).batch(texts) == want


def test_words_with_marks_share_their_word():
    """op12: a word is encoded once, whatever marks stand behind it; any character beside letters and marks gives the library's ids."""
    model = Tokenizer.from_file(TOKENIZER)
    with open(TOKENIZER, encoding="utf-8") as f:
        spec = f.read()
    made, seen = packing.Encoder(spec), []
    piece = made.known.piece
    made.known.piece = lambda letters: seen.append(letters) or piece(letters)
    text = "Zqorblä zqorblä, zqorblä. zqorblä!?) zqorblä zqorblä's\nzqorblä, zqorblä;"
    assert made.batch([text, text]) == 2 * [np.array(model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert len(seen) == len(set(seen)) == 3  # with the capital, behind a space, and at the line's start
    long = "ab" * packing.LONGEST_KEPT
    texts = [t for c in map(chr, [*range(1, 0x260), 0x300, 0x2019, 0x2028, 0x37E, 0x1F600]) for t in (f"ab{c}", f" ab{c}cd.", f"{c}ab,{c}", f"ab.{c} cd", f"ab {c}cd{c}{c}", f"é,{c}'s", f"ab{c}'ll")] + [long, f" {long}, {long}"]
    want = [np.array(e.ids, "<u4").tobytes() for e in model.encode_batch(texts, add_special_tokens=False)]
    assert packing.Encoder(spec).batch(texts) == want and made.batch(texts) == want
    assert max(map(len, made.known)) <= packing.LONGEST_KEPT


def test_packing_holds_every_token_once(spark):
    texts, capacity = corpus(), 64
    docs = frame(spark, texts, [None if i == 5 else i // 2 for i in range(len(texts))])  # ids repeat
    rows = packing.pack(docs, TOKENIZER, ["doc_id", "a"], capacity=capacity)
    got = cut(rows, "packed").collect()
    model = Tokenizer.from_file(TOKENIZER)
    want = [[*model.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert Counter(i for r in got for i in r["ids"]) == Counter(i for w in want for i in w)
    lengths = sorted(n for w in want for n in ([len(w)] if len(w) <= capacity else [len(w) % capacity] * (len(w) % capacity > 0) + [capacity] * (len(w) // capacity)))
    assert sorted(r["length"] for r in got) == lengths and all(len(r["ids"]) == r["length"] for r in got)
    assert all(r["length"] == capacity or r["piece"] == 0 for r in got)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for bin_ in places.values():
        assert [o for o, _ in sorted(bin_)] == np.cumsum([0, *(n for _, n in sorted(bin_)[:-1])]).tolist() and sum(n for _, n in bin_) <= capacity
    assert len(places) == sum(one_by_one(lengths, capacity).values())
    single = {tuple(r["ids"]) for r in got if r["doc_id"] == (len(texts) - 3) // 2}
    assert any(x in single for x in [tuple(w[:64]) for w in want[-5:]] + [tuple(w) for w in want[-5:]])
    whole = {r["sequence_id"]: r for r in packing.sequences(packing.pack(docs, TOKENIZER, ["doc_id"], capacity=capacity)).collect()}
    assert sum(len(r["ids"]) for r in whole.values()) == sum(map(len, want)) and all(sum(r["lengths"]) == len(r["ids"]) for r in whole.values())


def test_packing_query_equals_the_library(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    by = {}
    for r in queries.queries()["op12_best_two_fit"](spark, DIR).collect():
        by.setdefault(r["doc_id"], []).append(r)
    model = Tokenizer.from_file(TOKENIZER)
    assert set(by) == set(docs)
    for i, t in docs.items():
        ids, at = [*model.encode(t or "", add_special_tokens=False).ids, 2], 0
        for k, r in enumerate(sorted(by[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : at], "<u4").tobytes())
        assert at == len(ids)


def plain_sample(pairs, target, longest):
    def runs(t):
        w = re.findall(importance.WORDS, (t or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    held = [(i, *runs(t)) for i, t in pairs]
    s, t = Counter(b for _, _, f in held for b in f), Counter(b for x in target for b in runs(x)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    rows = []
    for i, n, f in held:
        w = math.floor(sum(map(gain, f)) / len(f)) if f else 0
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n))
    drawn = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: k + 1 for k, r in enumerate(drawn[: 10 * len(drawn) // 100])}
    return sorted((*r[:4], rank.get(r[0])) for r in rows)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_equals_brute_force(spark, longest):
    texts, target = corpus(), corpus(1, 40)
    got = importance.resample(frame(spark, texts), frame(spark, target), longest=longest).collect()
    assert sorted(map(tuple, got), key=lambda x: x[0]) == plain_sample(list(enumerate(texts)), target, longest)


def test_suffixes_sort_and_share_prefixes():
    r = np.random.default_rng(0)
    for depth in (1, 2, 3, 5):
        ids = r.integers(0, 4, 200)
        order, shared = importance.suffixes(ids, depth)
        cuts = [tuple(ids[p : p + depth]) for p in order]
        assert cuts == sorted(cuts) and sorted(order) == list(range(200))
        for i in range(1, 200):
            same = 0
            while same < min(len(cuts[i]), len(cuts[i - 1])) and cuts[i][same] == cuts[i - 1][same]:
                same += 1
            assert shared[i] == same


def test_resampling_of_repeated_rows_and_null_ids(spark):
    text = "one two three four five six seven eight nine ten " * 3
    docs = frame(spark, [text] * 40, [None] * 10 + [7] * 20 + list(range(100, 110)))
    got = importance.resample(docs, frame(spark, [text]), percent=50).collect()
    assert len(got) == 40 and {r["weight"] for r in got if r["doc_id"] is None} == {got[0]["weight"]}
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 21)) and all(r["rank"] is None for r in got if r["doc_id"] is None)


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert spelling.spelling_variants(docs).count() == 0
    assert packing.pack(docs, TOKENIZER, ["doc_id"]).count() == 0
    assert importance.resample(docs, docs).count() == 0
    assert importance.resample(frame(spark, ["a b"]), docs).first()["weight"] is not None


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_importance_resampling"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, DIR).select(*want.columns).collect()
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in got)
