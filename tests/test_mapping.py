import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeshelf.operators.mapping import FieldMapping

RULES = {
    "temp": {"target": "kelvin", "type": "double", "default": 273, "validation": {"min": 200, "max": 350}},
    "PM2.5": {"target": "pm25", "type": "double"},
    "gone": {"target": "gone", "type": "int"},
}


def test_steps_run_in_order(spark):
    raw = spark.createDataFrame(
        [("200", "1.5", "k"), ("350", None, "k"), ("199.9", "x", "k"), ("400", "2", "k"), (None, "3", "k"), ("x", "4", "k")],
        "temp string, `PM2.5` string, kept string",
    )
    out = FieldMapping.from_dict(RULES).apply(raw)
    assert out.columns == ["kelvin", "pm25", "kept"]
    assert [r["kelvin"] for r in out.collect()] == [200.0, 350.0, None, None, 273.0, None]
    assert [r["pm25"] for r in out.collect()] == [1.5, None, None, 2.0, 3.0, 4.0]


def test_empty_mapping_passes_through(spark):
    df = spark.range(2)
    assert FieldMapping.from_dict(None).apply(df).collect() == df.collect()


def test_one_target_twice_is_an_error():
    with pytest.raises(ValueError):
        FieldMapping.from_dict({"a": {"target": "x"}, "b": {"target": "x"}})


def test_json_paths(spark):
    body = '{"coord":{"lat":1.25,"lon":"x"},"weather":[{"main":"Rain"}],"wind":{"deg":10},"name":null}'
    df = spark.createDataFrame([(body,), ("{}",), ("broken",)], "body string")
    mapping = FieldMapping.from_dict({
        "$.coord.lat": {"target": "lat", "type": "double"},
        "$.coord.lon": {"target": "lon", "type": "double"},
        "$.weather[0].main": {"target": "sky", "type": "varchar"},
        "$.weather[3].main": {"target": "late_sky"},
        "$.wind.deg": {"target": "deg", "type": "integer"},
        "$.name": {"target": "name", "default": "nobody"},
    })
    rows = mapping.apply_to_json(df, "body", keep_raw=False).collect()
    assert tuple(rows[0]) == (1.25, None, "Rain", None, 10, "nobody")
    assert tuple(rows[1]) == tuple(rows[2]) == (None, None, None, None, None, "nobody")
    plan = mapping.apply_to_json(df, "body")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_paths_over_flattened_columns(spark):
    df = spark.createDataFrame([("7",)], "`main.temp` string")
    out = FieldMapping.from_dict({"$.main.temp": {"target": "t", "type": "int"}}).apply(df)
    assert out.columns == ["t"] and out.first()["t"] == 7


def test_required_split_and_reject_counts(spark):
    raw = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "n string, s string")
    mapping = FieldMapping.from_dict({"n": {"type": "int", "required": True}})
    good, bad = mapping.split_required(mapping.apply(raw))
    assert (good.count(), bad.count()) == (1, 2)
    assert raw.agg(*mapping.rejected_casts(raw)).first()["n"] == 1


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(200, 350)), min_size=1, max_size=8))
def test_mapping_again_changes_nothing(spark, kelvins):
    """On its own clean output a mapping without renames is the identity."""
    mapping = FieldMapping.from_dict({"k": {"type": "double", "default": 273.0, "validation": {"min": 200, "max": 350}}})
    df = spark.createDataFrame([(i, v) for i, v in enumerate(kelvins)], "i int, k double")
    once = mapping.apply(df)
    assert mapping.apply(once).orderBy("i").collect() == once.orderBy("i").collect()
