from pyspark.sql import functions as F
import pytest
import re
from collections import Counter

import corpus_pipeline
from lakeshelf.llm import language_id, mixing
from .conftest import SCHEMA
from .test_dedup import AZ, near_brute

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_in_order():
    assert [k for k, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"
    ]


def test_each_stage_against_brute_force(spark, docs, corpus, tmp_path):
    stages, now, kept = dict(corpus_pipeline.STAGES), docs, {r[0]: r for r in corpus}
    # language ID: what the model calls unknown goes
    model = language_id.fit(docs)
    kept = {i: r for i, r in kept.items() if (p := model.predict(r[1] or ""))[0] != "und" and p[1] >= language_id.LEAST_SCORE}
    assert all(re.search(r"[^\W\d_]", r[1]) for r in kept.values())
    now = stages["language ID"](spark, now, "")
    assert {r[0] for r in now.collect()} == set(kept) and now.schema == docs.schema
    # exact dedup: the largest doc_id of equal texts stays
    last = {}
    for i, r in kept.items():
        last[r[1].translate(AZ)] = max(i, last.get(r[1].translate(AZ), -1))
    kept = {i: kept[i] for i in last.values()}
    now = stages["exact dedup"](spark, now, "")
    assert {r[0] for r in now.collect()} == set(kept) and now.columns == docs.columns
    # near copies: the smallest doc_id of a component stays
    rows = [kept[i] for i in sorted(kept)]
    kept = {i: kept[i] for i, _, c in near_brute(rows) if i == c}
    now = stages["n-gram Jaccard join"](spark, now, "")
    assert {r[0] for r in now.collect()} == set(kept) and now.columns == docs.columns
    # mixing: rows as often as planned
    times = Counter({r["doc_id"]: r["times"] for r in mixing.plan_mix(now).collect() if r["times"]})
    now = stages["mixing sources to target weights"](spark, now, "")
    assert Counter(r[0] for r in now.collect()) == times and now.columns == docs.columns
    # packing: every row that is left, with its words
    packed = stages["packing"](spark, now, "").collect()
    words = Counter()
    for r in packed:
        words[r["doc_id"]] += r["n_tokens"]
    assert words == Counter({i: n * len(WORDS.findall(kept[i][1])) for i, n in times.items()})


def test_run_of_the_whole(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_run_of_nothing(spark, nothing, tmp_path):
    nothing.write.parquet(str(tmp_path / "documents.parquet"))
    assert spark.read.parquet(str(tmp_path / "documents.parquet")).schema == spark.createDataFrame([], SCHEMA).schema
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("number", range(4))
def test_stages_take_any_column_names(spark, docs, number):
    """Columns with the names that the stages use themselves, in any case, and names with dots and quotes."""
    names = "_id _text _gone_id _gone_text _mix _mix_copy _of row h of whole cut copy digest of_id kept n gone_id GONE_ID_ cid a.b x`y score lang_pred".split()
    wide = docs.select("*", *[F.lit(f"{k}").alias(name) for k, name in enumerate(names)])
    stage = corpus_pipeline.STAGES[number][1]
    plain = Counter((r["doc_id"], r["text"]) for r in stage(spark, docs, "").collect())
    found = stage(spark, wide, "")
    assert found.columns == wide.columns
    rows = found.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == plain
    assert all(tuple(r)[5:] == tuple(map(str, range(len(names)))) for r in rows)
