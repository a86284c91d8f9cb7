"""Inputs on which rows were once lost or made up without an error."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeshelf.functions import tolerant_cast
from lakeshelf.operators import incremental, quality
from lakeshelf.sources import files, payloads
from lakeshelf.sources.files import FileOptions
from lakeshelf.sources.ingest import Ingestor
from lakeshelf.sources.spec import SourceSpec
from pyspark.sql import types as T


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- files


def test_long_first_line_is_no_reason_to_skip_a_file(spark, tmp_path):
    (tmp_path / "long.csv").write_text("x" * (17 << 20) + "\na,b\n1,2\n")
    (tmp_path / "short.csv").write_text("note\na,b\n3,4\n")
    got = files.read_files(spark, str(tmp_path), options=FileOptions(skip_rows=1)).select("a", "b")
    assert rows(got) == [("1", "2"), ("3", "4")]


@pytest.mark.parametrize("split", ["1k", "4k", "128m"])
def test_preamble_over_several_splits(spark, tmp_path, split):
    preamble = "".join(f"line {i} {'y' * (i * 37 % 400)}\n" for i in range(100))
    body = "".join(f"{i},{i * i}\n" for i in range(2000))
    (tmp_path / "a b.csv").write_text(preamble + "\n\na,b\n" + body)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "512")
        got = files.read_files(spark, str(tmp_path), options=FileOptions(skip_rows=100)).select("a", "b")
        assert rows(got) == sorted(((str(i), str(i * i)) for i in range(2000)), key=str)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_small_splits_share_tasks(spark, tmp_path, monkeypatch):
    preamble = "".join(f"line {i} {'y' * 90}\n" for i in range(100))
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(preamble + "a,b\n" + "".join(f"{name},{i:08}\n" for i in range(10_000)))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for key, value in zip(keys, ("1k", "512")):
            spark.conf.set(key, value)
        read = lambda: files.read_files(spark, str(tmp_path), options=FileOptions(skip_rows=100)).select("a", "b")
        assert read().rdd.getNumPartitions() == spark.sparkContext.defaultParallelism  # of 240 splits
        monkeypatch.setattr(files, "_TASK_BYTES", 10 * 1024)
        got = read()
        assert 20 < got.rdd.getNumPartitions() < 30  # with the input's size, not at a fixed number
        assert rows(got) == [(name, f"{i:08}") for name in "ab" for i in range(10_000)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_blank_line_between_preamble_and_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("note\n\n  \na,b\n1,2\n")
    got = files.read_files(spark, str(tmp_path), options=FileOptions(skip_rows=1)).select("a", "b")
    assert rows(got) == [("1", "2")]


# ---- casts


def test_whole_doubles_up_to_the_bounds_of_bigint(spark):
    df = spark.createDataFrame([(9.21e18,), (-(2.0**63),), (2.0**63,), (-9.3e18,)], "v double")
    got = [r[0] for r in df.select(tolerant_cast(F.col("v"), "integer", T.DoubleType())).collect()]
    assert got == [9210000000000000000, -(2**63), None, None]


# ---- incremental loads


def test_replace_by_key_keeps_other_rows_of_the_null_partition(lake):
    spark = lake.spark
    lake.overwrite(spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", "x")], "id int, v string, p string"), "gold.t", ["p"])
    incremental.replace_by_key(lake, "gold.t", spark.createDataFrame([(1, "new", None)], "id int, v string, p string"), ["id", "p"], "p")
    assert rows(lake.read("gold.t")) == [(1, "new", None), (2, "b", None), (3, "c", "x")]


def test_emptied_days_and_months_are_cleared(lake):
    spark = lake.spark
    cols = "date_key date, v int, month_key date"
    old = [(date(2024, 1, 5), 1, date(2024, 1, 1)), (date(2024, 1, 20), 2, date(2024, 1, 1)), (date(2024, 2, 3), 3, date(2024, 2, 1))]
    lake.overwrite(spark.createDataFrame(old, cols), "gold.f", ["month_key"])
    fresh = spark.createDataFrame([(date(2024, 3, 1), 9, date(2024, 3, 1))], cols)
    incremental.replace_days(lake, "gold.f", fresh, date(2024, 1, 10), "date_key", "month_key")
    assert rows(lake.read("gold.f").select("date_key", "v")) == [(date(2024, 1, 5), 1), (date(2024, 3, 1), 9)]


# ---- landed responses


def pages_of(spark, listed):
    return spark.createDataFrame(listed, "entity string, page_no int, body string")


def test_first_empty_page_of_the_null_entity(spark):
    pages = pages_of(spark, [(None, 1, '[{"a":1}]'), (None, 2, "[]"), (None, 3, '[{"a":3}]')])
    assert [json.loads(r["record"])["a"] for r in payloads.unite_pages(pages, ["entity"]).collect()] == [1]


def test_all_landed_pages_are_united_and_repeats_count_once(spark):
    pages = pages_of(spark, [("x", i, f'{{"data":[{{"a":{i}}}]}}') for i in (*range(1, 14), 3)])
    got = [json.loads(r["record"])["a"] for r in payloads.unite_pages(pages, ["entity"]).collect()]
    assert sorted(got) == list(range(1, 14))
    assert payloads.missing_pages(pages, ["entity"]).isEmpty()


def test_inferred_schema_keeps_names(spark):
    df = spark.createDataFrame([('{"VOID_FLAG":null,"VARIANT_ID":1,"OBJECT<":{"a b":2}}',)], "record string")
    got = payloads.flatten_records(df)
    assert got.columns == ["OBJECT<.a b", "VARIANT_ID", "VOID_FLAG"] and got.first()[:2] == (2, 1)


def api_spec(tmp_path, **settings):
    return SourceSpec.from_dict({
        "source_id": "s", "source_type": "api", "api": {"landing_path": str(tmp_path), **settings},
        "target": {"table": "bronze.bronze_s"},
        "schema_mapping": {"$.id": {"target": "id", "type": "integer", "required": True}},
    })


def test_broken_response_goes_to_quarantine_and_casts_are_counted(lake, tmp_path):
    (tmp_path / "a.json").write_text('{"data":[{"id":1},{"id":"no"}]}')
    (tmp_path / "b.json").write_text("<html>Bad gateway</html>")
    result = Ingestor(lake, [api_spec(tmp_path)]).run_source("s")
    assert rows(lake.read("bronze.bronze_s").select("id")) == [(1,), (None,)]
    assert (result.rows_extracted, result.rows_written, result.rows_rejected, result.cast_rejects) == (3, 2, 1, {"id": 1})
    assert lake.read("bronze.bronze_s_quarantine").first()["raw_text"] == "<html>Bad gateway</html>"


def test_second_topic_run_loads_only_new_messages(lake, tmp_path):
    from lakeshelf.sources.messages import ENVELOPE

    def land(name, *offsets):
        made = [(None, b'{"id": %d}' % n, "t", 0, n, None) for n in offsets]
        lake.spark.createDataFrame(made, ENVELOPE).write.parquet(str(tmp_path / "landed" / name))

    spec = SourceSpec.from_dict({
        "source_id": "k", "source_type": "kafka", "kafka": {"landing_path": str(tmp_path / "landed" / "*")},
        "target": {"table": "bronze.bronze_k"}, "schema_mapping": {"id": {"target": "id", "type": "integer"}},
    })
    run = Ingestor(lake, [spec]).run_source
    land("one", 0, 1)
    assert run("k").rows_written == 2
    assert run("k").rows_written == 0
    land("two", 2, 3)
    assert run("k").rows_written == 2
    assert rows(lake.read("bronze.bronze_k").select("id")) == [(0,), (1,), (2,), (3,)]


# ---- tables


def test_overwrite_leaves_folders_that_are_not_its_own(lake, tmp_path):
    spark = lake.spark
    raw = str(tmp_path / "raw")
    spark.range(3).write.parquet(raw)
    spark.sql(f"CREATE TABLE {lake.table('gold.ext')} (id bigint) USING parquet LOCATION '{raw}'")
    lake.overwrite(spark.range(5), "gold.ext")
    assert lake.read("gold.ext").count() == 5 and spark.read.parquet(raw).count() == 3


def test_failed_registration_leaves_the_old_table(lake, monkeypatch):
    spark = lake.spark
    lake.overwrite(spark.range(3).toDF("a"), "gold.kept")
    monkeypatch.setattr(lake, "_register", lambda *a: (_ for _ in ()).throw(RuntimeError("no catalog")))
    with pytest.raises(RuntimeError):
        lake.overwrite(spark.range(9).toDF("b"), "gold.kept")
    monkeypatch.undo()
    assert lake.read("gold.kept").columns == ["a"] and lake.read("gold.kept").count() == 3


def test_versions_do_not_pile_up(lake, tmp_path):
    import os

    for n in range(1, 5):
        lake.overwrite(lake.spark.range(n), "gold.v")
        lake.overwrite(lake.spark.range(n).selectExpr("id", "id AS other"), "gold.v")
    home = lake._home(lake.table("gold.v"))
    assert lake.read("gold.v").count() == 4 and len(os.listdir(home)) == 2


# ---- quality


def test_accepted_values_in_the_type_of_the_column(spark):
    df = spark.createDataFrame([(True, 1.0, 1), (False, 2.0, 2), (None, 3.0, 3)], "b boolean, d double, i int")
    checks = [
        {"type": "accepted_values", "col": "b", "values": [True, False]},
        {"type": "accepted_values", "col": "d", "values": [1, 2]},
        {"type": "accepted_values", "col": "i", "values": [1, 2.5]},
    ]
    got = {r["check_column"]: r["failed_rows"] for r in quality.report(df, checks).collect()}
    assert got == {"b": 0, "d": 1, "i": 2}


# ---- staging views


def test_catalog_views_equal_the_transforms(lake, sf):
    from lakeshelf.plans import medallion, staging
    from lakeshelf.workload import tables

    spark = lake.spark
    sources = {
        medallion.BRONZE_TRAFFIC: (tables.bronze_traffic, "stg_traffic"),
        medallion.BRONZE_AIR: (tables.bronze_air_quality, "stg_air_quality"),
        medallion.BRONZE_EVENTS: (tables.bronze_events, "stg_stream_events"),
    }
    for name, (make, _) in sources.items():
        lake.overwrite(make(spark, sf), name)
    assert medallion.create_staging_views(lake) == [view for _, view in sources.values()]
    other = spark.newSession()  # a view of the catalog, not of the session
    for name, (_, view) in sources.items():
        got, want = other.table(lake.table(f"staging.{view}")), getattr(staging, view)(lake.read(name))
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
        assert rows(got) == rows(want) and got.count()
