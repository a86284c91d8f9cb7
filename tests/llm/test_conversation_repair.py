"""Conversation repair against a plain search over whole strings of edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from lakeshelf.llm import conversation_repair as repair
from lakeshelf.llm.conversation_repair import Repair

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, letters, repaired rows) by best-first search; rows: (role, must_go, truncated, text)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, at, roles, out = heapq.heappop(heap)
        if at == len(rows) and PATTERN.fullmatch(roles):
            return cost, letters, out
        state = (at, roles[-1:])
        if state in seen:  # the first to come is the cheapest, with the least letters among equals
            continue
        seen.add(state)

        def go(cost, letter, at, role, text):
            new = roles + role[:1] if role is not None else roles
            if re.fullmatch(r"s?(ua)*u?", new):
                heapq.heappush(heap, (cost, letters + letter, at, new, out + ((role, text),) if role is not None else out))

        for role in ("user", "assistant"):
            go(cost + 5, "I", at, role, "")
        if at < len(rows):
            role, must_go, truncated, text = rows[at]
            go(cost + 2, "D", at + 1, None, None)
            if not must_go:
                more = 5 if truncated else 0
                if role:  # an empty role has no initial
                    go(cost + more, "K", at + 1, role, text)
                for new in ("user", "assistant"):
                    go(cost + 1 + more, "R", at + 1, new, text)
    raise AssertionError


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_, turn_ = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        out += {0: [], 3: [row, row]}.get(kind, [row])
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def expected(rows):
    rows = damaged(rows)
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    cost, letters, out = cheapest([(r[1], f in ("blank", "duplicate"), f == "truncated", r[2]) for r, f in zip(rows, faults)])
    turns = {r[0] for r in rows} - {None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, digest


def random_rows(rng, n, conv):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "s", "ü"]
    texts = ["Yes.", "No!", "a b", "a b ", "", None, " \t", "Why?", "x.  ", "é", "end.\n"]
    return [(conv, rng.choice([None, *range(8)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_search_equals_plain_search():
    rng = random.Random(5)
    for case in range(1500):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.random() < 0.15, rng.random() < 0.2, str(i)) for i in range(rng.randrange(9))]
        search, found = Repair(), []
        for row in rows:
            found += search.add(row[0], row[1], row[2], row)
        found += search.end()
        cost, letters, out = cheapest(rows)
        assert "".join(f[0] for f in found) == letters, (case, rows)
        assert tuple((role, row[3] if row else "") for edit, role, row in found if edit != "D") == out


def test_undecided_edits_stay_few_where_survivors_meet():
    search, most = Repair(), 0
    for k in range(4000):
        list(search.add(("user", "assistant")[k % 2], k % 97 == 5, k % 31 == 4, (k,)))
        most = max(most, search.held())
    assert most < 1000
    turns, most = Repair(), 0
    for k in range(2000):  # a sound conversation: survivors meet soon
        list(turns.add(("user", "assistant")[k % 2], False, False, (k,)))
        most = max(most, turns.held())
    assert most < 20


def test_long_tie_is_settled_over_its_whole_length():
    rows = [("user", False, False, str(k)) for k in range(301)]
    search, found = Repair(), []
    for row in rows:
        found += search.add(row[0], row[1], row[2], row)
    found += search.end()
    assert "".join(f[0] for f in found) == cheapest(rows)[1]


def test_spark_equals_plain_search(spark):
    rng = random.Random(11)
    rows = [r for conv in range(250) for r in random_rows(rng, rng.randrange(1, 10), conv)]
    rows += random_rows(rng, 7, None) + [(900, 1, "user", "word " * 50_000 + "."), (900, 2, "assistant", None), (901, None, None, None)]
    rows += [(902, 3, "user", "Again.")] * 5 + [(903, 10**15, "user", "far."), (903, -(10**15), "assistant", "far.")]
    rows += [(conv, turn, "user", "gone.") for conv, turn in ((c, 1) for c in range(2000, 2100)) if zlib.crc32(f"{conv}:1".encode()) % 20 == 0]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("live", "seen", "fault", "place", "edit", "a.b"):
        df = df.withColumn(name, df["text"])
    found = repair.summaries(repair.edits(repair.damage(df)))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = found.collect()
    conversations = {}
    for r in rows:
        conversations.setdefault(r[0], []).append(r)
    assert len(found) == len(conversations) and any(not damaged(r) for r in conversations.values())
    for r in found:
        assert tuple(r)[1:] == expected(conversations[r["conv_id"]]), r["conv_id"]


def test_repaired_turns(spark):
    rows = [(1, 1, "assistant", "Hi.", True), (1, 2, "user", "Hm", True), (1, 3, "user", "So?", True)]
    df = spark.createDataFrame(rows, SCHEMA + ", live boolean")
    turns = [tuple(r) for r in repair.repaired_turns(df).orderBy("place").collect()]
    assert turns == [(1, 1, "user", "Hi."), (1, 3, "assistant", "So?")]


def test_empty(spark):
    assert repair.summaries(repair.edits(repair.damage(spark.createDataFrame([], SCHEMA)))).collect() == []
    with pytest.raises(StopIteration):
        next(iter(Repair().end()))
