"""Bucketed merges, declared tables and the votes of unseen trees."""

import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldseries.operators import model, schemas
from fieldseries.streaming import merge

SCHEMA = "k int, day string, v string"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def files(target):
    return {p.relative_to(target).as_posix(): p.stat().st_mtime_ns for p in (target / "data").rglob("*.parquet")}


def content(df):
    return sorted(map(tuple, df.collect()))


def test_a_merge_rewrites_touched_buckets_only(spark, tmp_path):
    target = tmp_path / "t"
    old = [(i, "d", "a") for i in range(200)]
    assert merge.read(spark, str(target)) is None
    assert merge.merge(spark, str(target), table(spark, old), ["k"], buckets=16) == 0
    before = files(target)
    assert merge.merge(spark, str(target), table(spark, [(3, "d", "b"), (500, "d", "b")]), ["k"]) == 1
    assert content(merge.read(spark, str(target))) == sorted([(i, "d", "b" if i == 3 else "a") for i in range(200)] + [(500, "d", "b")])
    assert content(merge.read(spark, str(target), 0)) == sorted(old)
    held = merge.Store(spark, str(target)).latest().buckets
    first = merge.Store(spark, str(target)).manifest(0).buckets
    changed = {b for b in held if held[b] != first.get(b)}
    assert len(held) == 16 and 1 <= len(changed) <= 2
    after = files(target)
    assert all(after[f] == t for f, t in before.items())  # untouched files keep their names, and their old versions are there
    assert merge.expire(spark, str(target), keep=1) >= 1
    left = files(target)
    assert {f for f in before if f.split("bucket=")[1].split("/")[0] not in changed} <= set(left) and len(left) == 16
    assert len(content(merge.read(spark, str(target)))) == 201


def test_a_crash_before_the_manifest_changes_nothing(spark, tmp_path):
    target = tmp_path / "t"
    merge.merge(spark, str(target), table(spark, [(1, "d", "a")]), ["k"], stream="s", batch=0)

    def crash():
        raise OSError("lost")

    new = table(spark, [(1, "d", "b"), (2, "d", "b")])
    with pytest.raises(OSError, match="lost"):
        merge.merge(spark, str(target), new, ["k"], stream="s", batch=1, before_commit=crash)
    assert content(merge.read(spark, str(target))) == [(1, "d", "a")]
    for _ in range(2):  # the batch runs again, and once more after its version is there
        assert merge.merge(spark, str(target), new, ["k"], stream="s", batch=1) == 1
    assert content(merge.read(spark, str(target))) == [(1, "d", "b"), (2, "d", "b")]
    assert merge.expire(spark, str(target), keep=1) >= 2  # the lost folder goes too
    assert content(merge.read(spark, str(target))) == [(1, "d", "b"), (2, "d", "b")]


def test_two_writers_do_not_lose_rows(spark, tmp_path):
    target = str(tmp_path / "t")
    merge.merge(spark, target, table(spark, [(1, "d", "a")]), ["k"])
    other = lambda: merge.merge(spark, target, table(spark, [(7, "d", "x")]), ["k"])
    with pytest.raises(RuntimeError, match="written by another"):
        merge.merge(spark, target, table(spark, [(1, "d", "b")]), ["k"], before_commit=other)
    assert content(merge.read(spark, target)) == [(1, "d", "a"), (7, "d", "x")]


def test_merges_refuse_other_shapes_and_take_null_keys_and_empty_batches(spark, tmp_path):
    target = str(tmp_path / "t")
    merge.merge(spark, target, table(spark, [(None, "d", "a"), (1, None, None)]), ["k"])
    with pytest.raises(ValueError, match="keys"):
        merge.merge(spark, target, table(spark, [(1, "d", "a")]), ["day"])
    with pytest.raises(ValueError, match="columns"):
        merge.merge(spark, target, spark.range(1).select(F.col("id").alias("k")), ["k"])
    with pytest.raises(Exception, match="two new rows have one key"):
        merge.merge(spark, target, table(spark, [(1, "d", "a"), (1, "d", "b")]), ["k"])
    assert merge.merge(spark, target, table(spark, []), ["k"]) == 1
    assert Counter(map(tuple, merge.read(spark, target).collect())) == Counter([(None, "d", "a"), (1, None, None)])


def test_a_stream_merges_into_buckets(spark, tmp_path):
    source, target = str(tmp_path / "in"), tmp_path / "out"
    first = table(spark, [(1, "a", "a"), (2, "a", "a")])
    first.coalesce(1).write.parquet(source)
    run = lambda: merge.start(spark, source, first.schema, str(target), ["k"], str(tmp_path / "cp"), buckets=8, order=["day"]).awaitTermination()
    run()
    table(spark, [(2, "b", "b"), (2, "c", "c"), (3, "a", "b")]).coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    assert content(merge.read(spark, str(target))) == [(1, "a", "a"), (2, "c", "c"), (3, "a", "b")]
    assert len(list((target / "manifests").glob("*.json"))) == 2
    assert json.loads(sorted((target / "manifests").glob("*.json"))[-1].read_text())["n_buckets"] == 8


NOTES = schemas.Table("notes", {"k": "int", "mark": "string", "note": "string", "n": "bigint"}, ("k",), ("note",), {"mark": ("a", "b")}, {"note": "'none'"})


def test_a_declared_table_fills_defaults_and_keeps_out_bad_rows(spark, tmp_path):
    good = spark.createDataFrame([(1, "a", None), (2, None, "x")], "k int, mark string, note string")
    made = schemas.write(good, str(tmp_path), NOTES)
    assert made.dtypes == list(NOTES.columns.items()) and sorted(map(tuple, made.collect())) == [(1, "a", "none", None), (2, None, "x", None)]
    for bad, said in (([(1, "c", "x")], "mark has a value"), ([(None, "a", "x")], "k is null"), ([(1, "a", "x"), (1, "b", "y")], "key twice")):
        with pytest.raises(Exception, match=said):
            schemas.write(spark.createDataFrame(bad, "k int, mark string, note string"), str(tmp_path), NOTES)
        assert spark.read.parquet(f"{tmp_path}/notes").count() == 2  # the old table stands
    assert sorted(p.name for p in tmp_path.iterdir()) == ["notes"]
    with pytest.raises(ValueError, match="no column more"):
        schemas.conformed(good.withColumn("more", F.lit(1)), NOTES)
    assert {r["contrainte"]: r["n"] for r in schemas.faults(spark.createDataFrame([(1, "c", None), (1, "a", "x"), (None, "b", "y")], "k int, mark string, note string"), NOTES).collect()} == {"not_null:k": 1, "not_null:note": 0, "domaine:mark": 1, "cle": 1}
    assert schemas.create_if_absent(spark, str(tmp_path), NOTES).count() == 2
    for t in schemas.TABLES.values():
        assert schemas.create_if_absent(spark, str(tmp_path), t).dtypes == [(n, k) for n, k in t.columns.items()]


def test_unseen_votes_equal_a_plain_version(spark):
    g = np.random.default_rng(0)
    data = [(i, g.normal(0, 1, 3).tolist(), "abc"[int(g.integers(3))]) for i in range(150)]
    data = [(i, [v[0] + "abc".index(c), *v[1:]], c) for i, v, c in data]
    df = spark.createDataFrame(data, "id long, x array<double>, classe string")
    bagged = model.train_bags(df, "x", "classe", "id", trees=8, bags=4, depth=4, least=2)
    got = {r["id"]: (r["classe_predite"], r["n_votes"]) for r in model.unseen_votes(bagged, df, "x", "id", "classe").collect()}
    times = {r["id"]: [r[f"t{b}"] for b in range(4)] for r in df.select("id", *[model.times_in_bag("id", b).alias(f"t{b}") for b in range(4)]).collect()}
    assert 0.9 < np.mean(list(times.values())) < 1.1
    labels, sums = bagged[0].stages[0].labels, {}
    for b, fitted in enumerate(bagged):
        assert fitted.stages[1].getNumTrees == 2
        vectors = model._vector(df, "x")
        for r in fitted.stages[1].transform(vectors).select("id", "probability").collect():
            if times[r["id"]][b] == 0:
                sums.setdefault(r["id"], []).append(r["probability"].toArray())
    want = {i: (labels[int(np.argmax(np.sum(p, axis=0)))], len(p)) for i, p in sums.items()}
    assert got == want and len(want) < 150
    score = model.unseen_accuracy(model.unseen_votes(bagged, df, "x", "id", "classe")).first()
    assert score["n"] == len(want) and score["accuracy"] == pytest.approx(np.mean([want[i][0] == c for i, _, c in data if i in want]))
