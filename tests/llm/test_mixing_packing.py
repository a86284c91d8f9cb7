import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeshelf.llm import mixing, packing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def water_filling(sizes, weights=(5, 2, 1), cap=3):
    """Clamp and share again, step by step."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while True:
        shares = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if shares[s] > cap * sizes[s]}
        if not over:
            return target | shares
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
            open_.discard(s)


def test_targets_and_taken(docs, corpus):
    found = {r["doc_id"]: r for r in mixing.plan_mix(docs).collect()}
    size = {r[0]: len(WORDS.findall(r[1] or "")) for r in corpus}
    of = {r[0]: r[3] for r in corpus}
    sizes = defaultdict(int)
    for i, s in of.items():
        sizes[s] += size[i]
    want, taken = water_filling(sizes), defaultdict(int)
    assert len(found) == len(corpus)
    for i, r in found.items():
        assert (r["size"], r["source_size"]) == (size[i], sizes[of[i]]) and r["target"] == pytest.approx(want[of[i]])
        assert 0 <= r["times"] <= 3
        taken[of[i]] += r["size"] * r["times"]
    for s in sizes:  # to the nearest document of the seeded order
        assert abs(taken[s] - want[s]) <= max(size[i] for i in of if of[i] == s)
    again = {r["doc_id"]: r["times"] for r in mixing.plan_mix(docs.repartition(3)).collect()}
    assert again == {i: r["times"] for i, r in found.items()}


def test_mix_repeats_rows_and_keeps_columns(docs):
    times = Counter({r["doc_id"]: r["times"] for r in mixing.plan_mix(docs).collect() if r["times"]})
    extra = docs.withColumn("whole", F.lit("x")).withColumn("cut", F.lit(1)).withColumn("h", F.lit(2))
    mixed = mixing.mix(extra)
    assert mixed.columns == extra.columns and Counter(r["doc_id"] for r in mixed.collect()) == times


def test_mix_with_many_ranges(docs, monkeypatch):
    plain = sorted(map(tuple, mixing.plan_mix(docs).collect()), key=str)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    assert sorted(map(tuple, mixing.plan_mix(docs).collect()), key=str) == plain


def test_mix_of_nothing_and_of_empty_texts(spark, nothing):
    assert mixing.plan_mix(nothing).count() == 0 and mixing.mix(nothing).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (None, "", None), (None, "", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["times"]) for r in mixing.plan_mix(empty).collect()] == [(0, 0.0, 0)] * 3
    one = spark.createDataFrame([(1, "a b", None), (1, "a b", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["times"]) for r in mixing.plan_mix(one).collect()] == [(4.0, 1)] * 2


def padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= n) - n for n in lengths)


def test_best_bounds_against_all_choices():
    from itertools import combinations

    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = rng.integers(0, 40, 30).tolist()
        values, counts = np.unique(lengths, return_counts=True)
        for k in (1, 2, 3):
            found = packing.best_bounds(values, counts, k)
            least = min(padding(lengths, [*c, max(lengths)]) for c in combinations(values.tolist(), k - 1))
            assert padding(lengths, found) == least and len(found) <= k and found[-1] == max(lengths)
    assert packing.best_bounds(np.array([3, 1]), np.array([2, 5]), 9) == [1, 3]


def test_pack(docs, corpus):
    found = packing.pack(docs, mixing.word_count(F.col("text")), longest=500, buckets=4, budget=2000).collect()
    size = {r[0]: len(WORDS.findall(r[1] or "")) for r in corpus}
    total, pieces = Counter(), defaultdict(list)
    for r in found:
        total[r["doc_id"]] += r["n_tokens"]
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["n_tokens"]))
    assert {i: total[i] for i in size} == size
    for i, p in pieces.items():
        assert [(k, k * 500) for k in range(len(p))] == [x[:2] for x in sorted(p)]
    bounds = packing.best_bounds(*np.unique([r["n_tokens"] for r in found], return_counts=True), 4)
    assert all(r["bucket_length"] == min(b for b in bounds if b >= r["n_tokens"]) for r in found)
    batches = defaultdict(list)
    for r in found:
        batches[r["batch"]].append(r)
    assert sorted(batches) == list(range(len(batches)))
    full = Counter()
    for rows in batches.values():
        bound = {r["bucket_length"] for r in rows}
        assert len(bound) == 1
        capacity = max(1, 2000 // max(1, bound.copy().pop()))
        assert sorted(r["slot"] for r in rows) == list(range(len(rows))) and len(rows) <= capacity
        full[bound.pop()] += len(rows) < capacity
    assert max(full.values()) <= 1  # at most the last batch of a bucket isn't full


def test_pack_with_many_ranges(docs, monkeypatch):
    tokens = mixing.word_count(F.col("text"))
    plain = sorted(map(tuple, packing.pack(docs, tokens).collect()), key=str)
    monkeypatch.setattr(packing, "RANGE_ROWS", 2)
    assert sorted(map(tuple, packing.pack(docs, tokens).collect()), key=str) == plain


def test_pack_edges(spark, nothing):
    assert packing.pack(nothing, mixing.word_count(F.col("text"))).count() == 0
    df = spark.createDataFrame([(1, None, 7), (1, "", 8), (None, "a b", 9)], "doc_id long, text string, piece int")
    found = packing.pack(df, mixing.word_count(F.col("text"))).collect()
    assert sorted((r["n_tokens"], r["bucket_length"]) for r in found) == [(0, 0), (0, 0), (2, 2)]
