"""The filter audit against filters applied to documents one after the other."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np

from lakeshelf.llm import filter_audit
from tests.llm.conftest import SCHEMA

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int, text string"


def failures(rows):
    least = {}
    for r in rows:
        if r[0] is not None:
            least[r[1] or ""] = min(least.get(r[1] or "", r[0]), r[0])
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = WORDS.findall(text)
        bad = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        bad += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
        out.append(bad + "E" * (doc_id is not None and least[text] < doc_id))
    return out


def expected(rows, labels):
    good = {i for i, q, *_ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, *_ in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for r, bad in zip(rows, failures(rows)):
        parts[r[3] or ""].append((r[0], bad))
    want = {}
    for part, docs in parts.items():
        total = Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                failing = sum(letter in d[1] for d in docs)
                total[letter] += len(gone)
                want[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(d[1] == letter for d in docs),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), letter,
                ]
        for key, v in want.items():
            if key[0] == part:
                v[-1] = total[v[-1]]
    return want


def hard_rows(corpus):
    rows = [(r[0], r[1], r[2], r[3], None) for r in corpus]
    plain = " ".join(f"w{i}" for i in range(250))
    rows += [(5000 + i, plain, None, "a", None) for i in range(300)]  # a hot text
    rows += [(7, plain, None, None, None), (None, plain, None, "", None), (None, None, None, "b", None)] * 2
    rows += [(9000, "same words " * 120, None, "b", None)] * 3 + [(9001, "same words " * 120 + "#", None, "b", None)]
    rows += [(9002, plain + " É ABCDEFGHIJKLMNOPQRSTUVWXYZ ABCDEF", None, "b", None), (-4, plain.upper(), None, "é", None)]
    return rows


def test_audit_equals_filters_one_by_one(spark, corpus):
    rows = hard_rows(corpus)
    labels = [(r[0], i % 3 and 1, (i % 4 == 0) * 1, "x") for i, r in enumerate(rows) if i % 2]
    labels += [(5001, None, None, "x"), (5001, 1, 1, "x"), (5002, 0, None, "x"), (None, 1, 1, "x"), (77_777, 1, 1, "x")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("part", "digest", "A", "n", "words", "bare", "x.y"):
        docs = docs.withColumn(name, docs["text"])
    found = filter_audit.audit(docs, spark.createDataFrame(labels, LABELS))
    assert found.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    want = expected(rows, labels)
    found = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in found.collect()}
    assert found == want and len(found) == 600 * len({r[3] or "" for r in rows})


def test_hot_texts_give_the_same(spark, corpus, monkeypatch):
    docs = spark.createDataFrame(hard_rows(corpus), SCHEMA)
    flags = filter_audit.text_flags(docs)
    plain = sorted(map(str, filter_audit.with_copies(flags).collect()))
    for share in (1, 10**6):  # no text joined apart, every repeated text joined apart
        monkeypatch.setattr(filter_audit, "HOT_SHARE", share)
        assert sorted(map(str, filter_audit.with_copies(flags).collect())) == plain


def test_contraction_of_three_filters():
    counts = np.random.default_rng(1).integers(0, 50, (4, 2, 2, 2))
    kept, removed, redundant, alone, lost, shapley = filter_audit.Contraction("XYZ")(counts, [counts * 2])
    row = filter_audit.Contraction("XYZ").names.index("YXZ") + 1  # the second step of Y, X, Z is X
    assert (kept[:, row] == counts[:, 0, 0, :].sum(1)).all() and (removed[:, row] == counts[:, 1, 0, :].sum(1)).all()
    assert (redundant[:, row] == counts[:, 1, 1, :].sum(1)).all() and (alone[:, row] == counts[:, 1, 0, 0]).all()
    assert (lost == 2 * removed).all() and (shapley.sum(1) >= removed.sum(1)).all()


def test_empty(spark, nothing):
    assert filter_audit.audit(nothing, spark.createDataFrame([], LABELS)).collect() == []
