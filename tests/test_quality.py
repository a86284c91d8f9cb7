from datetime import datetime, timezone

import pytest

from lakeshelf.operators import audit, quality

NOW = datetime(2024, 1, 2, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, 1, "a", "2024-01-01 23:00:00"), (1, 1, None, "2023-01-01 00:00:00"), (None, 1, "b", None), (None, 1, "c", None)]
    return spark.createDataFrame(rows, "k int, g int, s string, t string")


def run(df, *checks):
    return {(r["check_type"], r["check_column"]): r for r in quality.report(df, checks, "s", "r", NOW).collect()}


CHECKS = [
    ({"check_type": "not_null", "columns": ["k", "s"]}, 3),
    ({"type": "not_null", "col": "g"}, 0),
    ({"check_type": "unique", "columns": ["k"]}, 3),
    ({"type": "duplicate", "cols": ["k", "g"]}, 2),
    ({"check_type": "value_range", "column": "k", "min": 2}, 2),
    ({"check_type": "value_range", "column": "k"}, 0),
    ({"check_type": "value_range", "column": "s", "min": 0}, 0),
    ({"check_type": "accepted_values", "column": "s", "values": ["a", "b"]}, 1),
    ({"check_type": "accepted_values", "column": "g", "values": [1]}, 0),
    ({"check_type": "freshness", "column": "t", "max_age_hours": 1}, 0),
    ({"check_type": "freshness", "column": "t", "max_age_hours": 0}, 1),
    ({"check_type": "row_count", "min_rows": 4}, 0),
    ({"check_type": "row_count", "min_rows": 5}, 1),
    ({"check_type": "row_count", "max_rows": 3}, 1),
]


@pytest.mark.parametrize("check, failed", CHECKS)
def test_each_check(df, check, failed):
    (row,) = run(df, check).values()
    assert (row["failed_rows"], row["passed"], row["total_rows"]) == (failed, failed == 0, 4)
    assert row["failure_rate"] == failed / 4


def test_fused_equals_one_at_a_time(df):
    together = quality.report(df, [c for c, _ in CHECKS], "s", "r", NOW).collect()
    assert sorted(r["failed_rows"] for r in together) == sorted(f for _, f in CHECKS)


def test_plain_checks_share_one_scan(spark, tmp_path, df):
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plain = [c for c, _ in CHECKS if c.get("check_type", c.get("type")) not in ("unique", "duplicate")]
    plan = quality.report(stored, plain)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" not in plan
    unique = quality.report(stored, [{"type": "unique", "col": "k"}])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:int>" in unique and "Expand" not in unique


def test_unknown_and_broken_checks(df):
    got = run(df, {"type": "sparkle", "col": "k"}, {"type": "not_null", "col": "gone"}, {"type": "row_count"})
    assert set(got) == {("not_null", "gone"), ("row_count", "")}
    bad = got[("not_null", "gone")]
    assert bad["passed"] is False and bad["failed_rows"] is None and "no column gone" in bad["details"]


def test_empty_table(df):
    got = run(df.where("false"), {"type": "not_null", "col": "k"}, {"type": "row_count"}, {"type": "freshness", "col": "t"})
    assert got[("not_null", "k")]["failure_rate"] == 0.0
    assert not got[("row_count", "")]["passed"] and not got[("freshness", "t")]["passed"]


def test_epoch_seconds_are_times(spark):
    df = spark.createDataFrame([(int(NOW.timestamp()) - 60,)], "dt bigint")
    assert run(df, {"type": "freshness", "col": "dt", "max_age_hours": 1})[("freshness", "dt")]["passed"]


def test_pass_rate_and_audit(lake, df):
    report = quality.report(df, [c for c, _ in CHECKS], "s", "r", NOW)
    row = quality.pass_rate(report).first()
    passed = sum(f == 0 for _, f in CHECKS)
    assert (row["total_checks"], row["passed"], row["failed"], row["overall_pass"]) == (14, passed, 14 - passed, False)
    audit.create_audit_tables(lake)
    assert audit.record_checks(lake, report) == 14
    assert quality.report_all([("missing", None, [])]) is None


def test_declared_model_tests():
    assert sum(len(tests) for _, _, tests in quality.MODEL_TESTS) == 25
    assert sum(len(checks) for _, _, checks in quality.STANDING_SUITE) == 13
    assert quality.model_checks("dim_date")[0] == {"type": "not_null", "col": "date_key"}
