"""Near duplicates of embeddings against all pairs."""

import numpy as np
import pytest

from lakeshelf.llm import pq_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, `a.b` string, list int, cid long, copies long"


def brute(rows, least=0.9):
    """vec_id -> sorted (n_links, component_id) of its rows."""
    kept, by_length = [], {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            by_length.setdefault(len(v), []).append(k)
    links = [[] for _ in rows]
    for at in by_length.values():
        u = pq_dedup.units(np.array([rows[k][1] for k in at]))
        s = u @ u.T >= least
        np.fill_diagonal(s, False)
        for i, j in zip(*np.nonzero(s)):
            links[at[i]].append(at[j])
    seen = {}
    for k in range(len(rows)):
        if k in seen:
            continue
        stack, group = [k], {k}
        while stack:
            for j in links[stack.pop()]:
                if j not in group:
                    group.add(j)
                    stack.append(j)
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        seen.update(dict.fromkeys(group, min(ids) if ids else None))
    for k, (i, _) in enumerate(rows):
        kept.append((i, len(links[k]), seen[k], i == seen[k]))
    return sorted(kept, key=str)


def cluster(rng, centre, n, cosine):
    """n vectors around a centre, so that two of them have about this cosine."""
    noise = rng.normal(size=(n, len(centre)))
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return centre / np.linalg.norm(centre) + noise * np.sqrt((1 - cosine) / cosine)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, "x", 2, 3, 4) for i, v in rows], SCHEMA).repartition(5)
    found = pq_dedup.near_duplicates(df, **kw)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, found.collect()), key=str)


def floats(m):
    return [[float(np.float32(x)) for x in v] for v in m]


@pytest.fixture(scope="module")
def many():
    rng = np.random.default_rng(4)
    vectors = list(rng.normal(size=(1500, 24)))
    for n, cosine in ((300, 0.97), (60, 0.93), (40, 0.905), (5, 0.99), (2, 0.95)):
        vectors += list(cluster(rng, rng.normal(size=24), n, cosine))
    rows = list(zip(map(int, rng.permutation(len(vectors))), floats(vectors)))
    rows += [(10_000 + k, rows[7][1]) for k in range(400)]  # a hot vector
    rows += [(20_000, [2 * x for x in rows[9][1]]), (20_001, [-x for x in rows[9][1]])]
    return rows


def test_all_links_are_found(spark, many):
    found, want = run(spark, many), brute(many)
    links = sum(r[1] for r in want)
    assert sum(r[1] for r in found) >= 0.99 * links
    assert {r[0]: r[1] for r in found}.keys() == {r[0]: r[1] for r in want}.keys()
    exact = {r[0]: r for r in want}
    assert all(r[1] <= exact[r[0]][1] for r in found)  # none below the least cosine
    assert sum(r == exact[r[0]] for r in found) >= 0.99 * len(want)


def test_hot_lists_in_blocks_give_the_same(spark, many, monkeypatch):
    plain = run(spark, many)
    monkeypatch.setattr(pq_dedup, "BLOCK_ROWS", 50)
    monkeypatch.setattr(pq_dedup, "VISITORS_AT_ONCE", 7)
    assert run(spark, many) == plain


def test_distances_bound_every_pair(many):
    u = pq_dedup.units(np.array([v for _, v in many[:1500]]))
    q = pq_dedup.Quantiser.fit(u[:1000], 1500, 0.9)
    own, visits, codes, errors = q.encode(u)
    assert len(q.coarse) > 20 and sum(map(len, visits)) < len(u) * len(q.coarse) / 2
    for of_list in range(0, len(q.coarse), 9):
        at = np.flatnonzero(own == of_list)
        exact = np.sqrt(np.maximum(0, 2 - 2 * u[:200] @ u[at].T))
        assert (abs(q.distances(u[:200], codes[at], of_list) - exact) <= errors[at] + 1e-9).all()


def test_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(1, a), (2, a), (2, a), (None, a), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (7, [1.0, nan, 3.0])]
    rows += [(8, [1.0, inf, 3.0]), (9, [1.0, 2.0]), (10, [2.0, 4.0]), (11, [3e38, 1e38, 0.0]), (12, [3e-45, 1e-45, 0.0]), (13, [-0.0, 0.0, 1.0]), (14, [0.0, 0.0, 2.0])]
    rows += [(None, b), (None, b), (15, [5.0]), (16, [1.0]), (17, [-1.0]), (None, None), (3, None)]
    assert run(spark, rows) == brute(rows)


def test_lengths_outside_the_sample(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = list(enumerate(floats(cluster(rng, rng.normal(size=9), 30, 0.95)) + floats(cluster(rng, rng.normal(size=5), 30, 0.95))))
    monkeypatch.setattr(pq_dedup, "learned", lambda classes, least: {})
    assert run(spark, rows) == brute(rows)


def test_doubles_and_integers(spark):
    rows = [(1, [10**9, 1]), (2, [10**9, 2]), (3, [1, 10**9])]
    for kind in ("bigint", "double"):
        df = spark.createDataFrame([(i, [float(x) for x in v] if kind == "double" else v) for i, v in rows], f"vec_id long, embedding array<{kind}>")
        assert sorted(map(tuple, pq_dedup.near_duplicates(df).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_empty(spark):
    assert run(spark, []) == []
