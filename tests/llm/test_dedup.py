import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from lakeshelf.llm import common, exact_dedup, ngram_join
from lakeshelf.llm.components import components

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact_brute(rows):
    body = {r[0]: (r[1] or "").translate(AZ) for r in rows}
    groups = {}
    for i, t in body.items():
        groups.setdefault(t, []).append(i)
    return sorted(
        (i, max(groups[t]), len(groups[t]), i == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in body.items()
    )


def near_brute(rows):
    sets = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return sorted((r[0], len(sets[k]), rows[find(k)][0]) for k, r in enumerate(rows))


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("bits", [16, 33, 60])
def test_golomb_code_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 2, 1000):
        values = np.sort(rng.integers(0, 1 << bits, n, dtype=np.uint64))
        if n > 2:
            values[5:9] = values[5]
        assert (exact_dedup.decode_sorted(exact_dedup.encode_sorted(values, bits)) == values).all()


def test_code_is_short():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 26, 1 << 16, dtype=np.uint64))
    assert len(exact_dedup.encode_sorted(values, 26)) < 13 * len(values) / 8


def test_exact_groups(docs, corpus):
    assert got(exact_dedup.exact_groups(docs)) == sorted(exact_brute(corpus), key=str)


def test_exact_groups_with_few_owners_and_many_suspects(docs, corpus, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_IDS", 0)  # the bitmap decides then
    monkeypatch.setattr(exact_dedup, "PORTION", 7)
    assert got(exact_dedup.exact_groups(docs)) == sorted(exact_brute(corpus), key=str)


def test_exact_empty_nulls_and_repeats(spark, nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0
    rows = [(None, "x"), (1, "X"), (1, "x"), (2, "y"), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(df).collect()), key=str)
    assert found == sorted(
        [(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False), (2, 2, 1, True), (None, None, 2, True), (None, None, 2, True)], key=str
    )
    assert got(exact_dedup.drop_exact_copies(df)) == sorted([(1, "X"), (1, "x"), (2, "y"), (None, None), (None, "")], key=str)


def test_one_row_of_each_group_stays(spark, nothing):
    stage = dict(corpus_pipeline.STAGES)["exact dedup"]
    rows = [(None, "x"), (1, "X"), (1, "x"), (2, "y"), (None, None), (None, ""), (3, "z"), (4, "z"), (1, "other"), *[(7, "many")] * 500, (6, "many")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = stage(spark, df, "").collect()
    assert len(found) == 6 and found[0].__fields__ == df.columns
    assert {(r[0], (r[1] or "").lower()) for r in found} == {(1, "x"), (2, "y"), (None, ""), (4, "z"), (1, "other"), (7, "many")}
    assert stage(spark, nothing, "").count() == 0


def test_near_duplicates(docs, corpus):
    assert got(ngram_join.near_duplicates(docs)) == sorted(near_brute(corpus), key=str)


def test_near_duplicates_by_trees_alone(spark, corpus, monkeypatch):
    """Without the stars' links, all links must come from the signature trees."""
    real, calls = ngram_join._verified, []

    def verified(docs, classes, pairs):
        calls.append(1)
        return real(docs, classes, pairs if len(calls) > 1 else pairs.where("false"))

    monkeypatch.setattr(ngram_join, "_verified", verified)
    # every bucket gets three members at least besides its pivot: each text three times, with a word more
    rows = [(r[0] * 10 + k, f"{r[1]}{' more' * k}") for r in corpus if r[1] and len(r[1]) > 400 and len(r[1]) < 5000 for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = dict((r[0], r[2]) for r in got(ngram_join.near_duplicates(df)))
    want = dict((r[0], r[2]) for r in near_brute(rows))
    linked = [i for i in want if want[i] != i]
    assert len(calls) == 2 and linked
    # links of a bucket's pivot were taken away; all others are found
    assert sum(found[i] != i for i in linked) >= 0.4 * len(linked)
    assert all(want[i] == want[found[i]] for i in found)


def test_tree_loses_no_pair():
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(300)]
    sets = []
    for k in range(120):
        s = set(rng.sample(base, 260)) | {rng.getrandbits(64) for _ in range(rng.randrange(60))}
        sets.append(np.array(sorted(s), np.uint64))
    n = np.array([len(s) for s in sets])
    comp = np.arange(len(sets)) // 2
    found = set()
    for i, j in ngram_join.tree_pairs(n, comp, [ngram_join._bitmap(s) for s in sets], np.ones(len(sets), bool)):
        found |= {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            both = len(np.intersect1d(sets[a], sets[b]))
            linked = 100 * both >= 75 * (n[a] + n[b] - both)
            assert not (linked and comp[a] != comp[b]) or (a, b) in found
            if linked:
                assert ngram_join._may_link_short(n[a], n[b], ngram_join._short(sets[a]), ngram_join._short(sets[b]))
    assert all(comp[a] != comp[b] for a, b in found)


def test_a_pair_is_left_to_the_first_bucket_of_both():
    rng = random.Random(1)
    base = {rng.getrandbits(64) for _ in range(100)}
    bits = [ngram_join._bitmap(np.array(sorted(base), np.uint64)) for _ in range(4)]
    n, comp, home = np.full(4, 100), np.arange(4), np.ones(4, bool)
    first = np.array([[3, 9], [3, -1], [4, 9], [-1, -1]])

    def pairs(place):
        found = ngram_join.tree_pairs(n, comp, bits, home, place, first)
        return {(min(a, b), max(a, b)) for i, j in found for a, b in zip(i.tolist(), j.tolist())}

    assert pairs(3) == {(a, b) for a in range(4) for b in range(a + 1, 4)}
    assert (0, 1) not in pairs(5) and (0, 2) in pairs(5) and (0, 2) not in pairs(10) and (0, 3) in pairs(10)


def test_near_empty_nulls_and_repeats(spark, nothing):
    assert ngram_join.near_duplicates(nothing).count() == 0
    rows = [(None, "a b c"), (5, "A b  c"), (5, "a b c"), (7, None), (8, ""), (8, ""), (9, " \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(ngram_join.near_duplicates(df)) == sorted(
        [(None, 1, 5), (5, 1, 5), (5, 1, 5), (7, 0, 7), (8, 0, 8), (8, 0, 8), (9, 0, 9)], key=str
    )


def test_texts_without_a_doc_id_are_linked(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (None, f"{text} x"), (9, f"{text} x y z v u t s r"), (20, "other words " * 9), (None, "no one like this one here"), (None, f"{text} x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r[0], r[2]) for r in got(ngram_join.near_duplicates(df))), key=str)
    assert found == sorted([(5, 5), (9, 5), (20, 20), (None, 5), (None, 5), (None, None)], key=str)
    chain = [(None, f"{text} {' '.join(f'v{i}' for i in range(k))}") for k in (0, 8, 16)] + [(3, f"{text} {' '.join(f'v{i}' for i in range(24))}")]
    found = got(ngram_join.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string")))
    assert {r[2] for r in found} == {3}


def test_threshold_is_inclusive(spark):
    # 8 words give 4 shingles; three of four shared and one more on one side only: 3 of 4
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g"), (3, "q b c d e f g h"), (4, "a b c d e x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r[2] for r in got(ngram_join.near_duplicates(df))] == [r[2] for r in near_brute(rows)] == [1, 1, 3, 4]


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 50)] + [(70, 70)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {found[i] for i in range(100, 161)} == {100} and {found[i] for i in range(1, 50)} == {1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_clashing_columns_stay(spark):
    df = spark.createDataFrame([(1, "a b c", 9, "x"), (2, "A B C", 8, "y")], "doc_id long, text string, keep_id int, component_id string")
    assert got(exact_dedup.drop_exact_copies(df)) == [(2, "A B C", 8, "y")]
    assert got(ngram_join.drop_near_copies(df)) == [(1, "a b c", 9, "x")]
