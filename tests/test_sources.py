import gzip
import json
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeshelf.operators import audit
from lakeshelf.sources import files, messages, payloads
from lakeshelf.sources.ingest import Ingestor, check_sources
from lakeshelf.sources.spec import SourceSpec, SpecFolder


def read(spark, where, pattern="*", **options):
    recursive = options.pop("recursive", False)
    fmt = options.pop("fmt", "csv")
    return files.read_files(spark, str(where), pattern, fmt, recursive, files.FileOptions(**options))


def records(df, *cols):
    return sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=str)


def test_csv_union_is_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,PM2.5,q\n1,2,"he said ""hi"""\n3,NA,\n')
    (tmp_path / "b.csv").write_text("q,x\nz,9\n")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as out:
        out.write("x,q\n5,None\n")
    df = read(spark, tmp_path)
    assert records(df, "x", "PM2.5", "q", "_source_file") == sorted([
        ("1", "2", 'he said "hi"', "a.csv"), ("3", None, None, "a.csv"), ("9", None, "z", "b.csv"), ("5", None, None, "c.csv.gz"),
    ], key=str)


def test_csv_options(spark, tmp_path):
    (tmp_path / "s.csv").write_text("junk\nmore\nx;y\n1;'a;b'\n\n2;c\n")
    df = read(spark, tmp_path, delimiter=";", quote_char="'", skip_rows=2)
    assert records(df, "x", "y") == [("1", "a;b"), ("2", "c")]
    (tmp_path / "n.txt").write_bytes("é,1\n".encode("latin-1"))
    plain = read(spark, tmp_path, "*.txt", has_header=False, encoding="ISO-8859-1")
    assert records(plain, "0", "1") == [("é", "1")]
    (tmp_path / "m.dat").write_text('x,y\n1,"two\nlines"\n')
    assert records(read(spark, tmp_path, "*.dat", multi_line=True), "x", "y") == [("1", "two\nlines")]


def test_same_header_promise_is_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n3,4\n")
    with pytest.raises(Exception):
        read(spark, tmp_path, same_header=True).collect()


def test_repeated_and_blank_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,x,\n1,2,3\n")
    assert records(read(spark, tmp_path), "x", "x.1", "Unnamed: 2") == [("1", "2", "3")]


def test_formats_by_extension(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"x":1,"n":{"a":1.5}},{"x":"s"}]')
    (tmp_path / "l.jsonl").write_text('{"x":2}\n{bad\n{"x":3}\n')
    pd.DataFrame({"x": ["p"], "k": [5]}).to_parquet(tmp_path / "p.parquet")
    df = read(spark, tmp_path)
    good = df.where(F.col(files.CORRUPT).isNull())
    assert records(good, "x", "k") == sorted([("1", None), ("s", None), ("2", None), ("3", None), ("p", 5)], key=str)
    assert [r[files.CORRUPT] for r in df.where(F.col(files.CORRUPT).isNotNull()).collect()] == ["{bad"]
    with pytest.raises(ValueError):
        files.format_of("a.xml", "xml")
    assert files.format_of("a.XML", "json") == "json"


def test_bad_files_are_skipped_unless_all_are_bad(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "empty.csv").write_text("\n\n")
    assert records(read(spark, tmp_path), "x") == [("1",)]
    with pytest.raises(files.UnreadableFile):
        read(spark, tmp_path, tolerate_bad_files=False)
    (tmp_path / "a.csv").write_text("\n")
    with pytest.raises(RuntimeError):
        read(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        read(spark, tmp_path, "*.none")


def test_discovery(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "sub" / "b.csv").write_text("x\n2\n")
    names = lambda paths: [p.rsplit("/", 1)[-1] for p in paths]
    assert names(files.discover(spark, str(tmp_path), "*.csv")) == ["a.csv"]
    assert names(files.discover(spark, str(tmp_path), "*.csv", recursive=True)) == ["a.csv", "b.csv"]
    assert names(files.discover(spark, str(tmp_path), "sub/*.csv")) == ["b.csv"]
    assert files.discover(spark, str(tmp_path), "*.none") == []
    assert files.dataset_file(spark, str(tmp_path), "other.csv").endswith("a.csv")
    with pytest.raises(FileNotFoundError):
        files.dataset_file(spark, str(tmp_path / "sub" / "x"), "b.csv")


def bodies(spark, *texts):
    return spark.createDataFrame([(i, b) for i, b in enumerate(texts)], "i int, body string")


def test_envelopes(spark):
    texts = ['{"data":"none","items":[{"a":1}]}', '{"data":{"x":1},"results":[{"a":2}]}', '[{"a":3},{"a":4}]',
             '{"a":5}', '{"data":null,"items":[]}', '{"data":[]}']
    single = payloads.with_response_records(bodies(spark, *texts)).orderBy("i").collect()
    assert [r["__records"] for r in single] == [
        ['{"a":1}'], ['{"a":2}'], ['{"a":3}', '{"a":4}'], ['{"a":5}'], [], []]
    paged = payloads.with_page_records(bodies(spark, *texts)).orderBy("i").collect()
    # pages look at the first key present, and do not know "items"
    assert [r["__records"] for r in paged] == [
        ["none"], ['{"x":1}'], ['{"a":3}', '{"a":4}'], ['{"a":5}'], [], []]


def test_flatten_records(spark):
    df = payloads.unwrap_responses(bodies(spark, '[{"a":{"b":1,"c":[1,2]},"d":"x"},{"a":{"b":2}}]'))
    flat = payloads.flatten_records(df)
    assert sorted(flat.columns) == ["a.b", "a.c", "d", "i"]
    assert records(flat, "a.b", "d") == [(1, "x"), (2, None)]


def test_pages_stop_at_the_first_empty_one(spark):
    rows = [("e", 1, '{"data":[{"r":1}]}'), ("e", 2, '{"data":[]}'), ("e", 3, '{"data":[{"r":3}]}'),
            ("f", 1, '{"data":[{"r":4}]}'), ("f", 2, '[{"r":5}]'), ("f", 3, '{"data":[{"r":6}]}')]
    pages = spark.createDataFrame(rows, "entity string, page_no int, body string")
    got = payloads.unite_pages(pages, ["entity"], max_pages=2)
    assert records(got, "entity", "record") == [("e", '{"r":1}'), ("f", '{"r":4}'), ("f", '{"r":5}')]
    everything = payloads.unite_pages(pages.where("entity = 'e'"))
    assert records(everything, "record") == [('{"r":1}',)]
    assert payloads.missing_pages(pages, ["entity"]).count() == 0
    assert payloads.missing_pages(pages.where("page_no <> 2"), ["entity"]).count() == 2


def test_ends_are_found_without_bringing_bodies_together(spark):
    rows = [("e", 1, '{"data":[{"r":1}]}', "b"), ("e", 1, '{"data":[{"r":1}]}', "a"), ("e", 2, '{"data":[]}', "a"), ("e", 2, '{"data":[]}', "b"),
            ("e", 3, '{"data":[{"r":3}]}', "a"), (None, 1, '{"data":[]}', "a"), (None, 1, '{"data":[{"r":4}]}', "a"), (None, 2, '{"data":null}', "a")]
    got = payloads.unite_pages(spark.createDataFrame(rows, "entity string, page_no int, body string, run string"), ["entity"])
    assert records(got, "entity", "record", "run") == [("e", '{"r":1}', "a"), (None, '{"r":4}', "a")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(entity#\w+, page_no#\w+, body#", plan)) == 1


def test_empty_pages(spark):
    empty = ['{"data":[]}', '{"data": [ ] }', '{"x":1,"data":[\n]}', '{"data":null}', '{"data" : "[]"}', '{"data":"[ ]"}', r'{"data":"\u005b\u005d"}', "[]", " [ ]",
             r'{"d\u0061ta":[]}', '{"results":[],"y":[1]}', '{"data":[],"results":[1]}', '{"features":null}', "{'data':[]}"]
    others = ['{"data":[1]}', '{"data":[null]}', '{"data":[[]]}', '{"data":{"x":[]}}', '{"data":""}', '{"data":"null"}', '{"data":0}', '{"data":{}}', "{}", "[1]", "[null]",
              '{"items":[]}', '{"results":[1],"data":[1]}', '{"results":[],"data":[1]}', "", "null", "{bad", '{"data":[]', "\n[]", None]
    found = {r["i"]: r["__empty"] for r in payloads._with_empty(bodies(spark, *empty, *others), "body", payloads.PAGE_KEYS).collect()}
    assert [b for i, b in enumerate(empty) if found[i] is not True] == []
    assert [b for i, b in enumerate(others, len(empty)) if found[i] is not False] == []
    # a text that only begins like a list is neither, as its length isn't known
    assert payloads._with_empty(bodies(spark, '{"data":"[abc"}', "[1"), "body", payloads.PAGE_KEYS).where("__empty IS NULL").count() == 2


def envelope(spark, *values):
    rows = [(b"k", v, "t", 0, i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")
    return df.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))


def test_broken_messages_keep_their_text(spark):
    df = messages.decode(envelope(spark, b'{"a":1,"p":{"z":1}}', b"{bad", b"[1]", None), "a string, p string")
    got = [tuple(r) for r in df.orderBy("kafka_offset").select("a", "p", messages.CORRUPT).collect()]
    assert got == [("1", '{"z":1}', None), (None, None, "{bad"), (None, None, "[1]"), (None, None, "")]


def test_message_field_replaces_envelope_column(spark):
    df = messages.decode(envelope(spark, b'{"kafka_key":"own"}'), "kafka_key string")
    assert df.columns.count("kafka_key") == 1 and df.first()["kafka_key"] == "own"


# ---- specs and runs -------------------------------------------------------


def spec(tmp_path, **over):
    return {
        "source_id": "cities", "source_type": "file", "format": "csv",
        "file": {"base_path": str(tmp_path / "raw"), "pattern": "*.csv"},
        "target": {"table": "bronze_cities", "write_mode": "append", "partition_by": "ingestion_date"},
        "schema_mapping": {"City": {"target": "city", "type": "varchar", "required": True},
                           "N": {"target": "n", "type": "bigint", "default": 0, "validation": {"min": 0}}},
        "quality_checks": [{"check_type": "not_null", "columns": ["city"]}],
        "metadata": {"expected_row_count_min": 1, "expected_row_count_max": 10},
        **over,
    }


@pytest.fixture()
def raw(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("City,N,More\nA,1,m\nB,x,m\nC,,m\nD,-5,m\n")
    return tmp_path


def test_spec_folder(tmp_path):
    folder = tmp_path / "sources"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(spec(tmp_path)))
    (folder / "b.json").write_text("{broken")
    (folder / "c.json").write_text(json.dumps(spec(tmp_path, source_id="off", enabled=False)))
    (folder / "d.yaml").write_text("source_id: y\nsource_type: api\n")
    (folder / "e.json").write_text(json.dumps({"source_type": "file"}))
    specs = SpecFolder(tmp_path)
    assert [s.source_id for s in specs.all()] == ["cities", "y"]
    assert specs.by_id("off") is None and specs.by_id("cities").partition_column == "_ingestion_date"
    assert [s.source_id for s in specs.by_type("api")] == ["y"]
    assert specs.by_id("y").target_table == "bronze_y"
    assert specs.by_id("cities").checks()[-1] == {"check_type": "row_count", "min_rows": 1, "max_rows": 10}


def test_run_source(lake, raw):
    runner = Ingestor(lake, [SourceSpec.from_dict(spec(raw))])
    result = runner.run_source("cities")
    assert (result.status, result.rows_extracted, result.rows_written) == (audit.SUCCESS, 4, 4)
    assert result.cast_rejects == {"n": 1}
    table = lake.read("bronze_cities")
    assert records(table, "city", "n", "More", "_source_file") == [
        ("A", 1, "m", "a.csv"), ("B", None, "m", "a.csv"), ("C", 0, "m", "a.csv"), ("D", None, "m", "a.csv")]
    assert table.select("_batch_id").distinct().count() == 1
    assert lake.partition_columns("bronze_cities") == ["_ingestion_date"]
    runner.run_source("cities")
    assert lake.stats("bronze_cities")["rows"] == 8
    runs = lake.read(audit.INGESTION_AUDIT)
    assert tuple(audit.ingestion_summary(runs).first()) == (2, 2, 0, 8)


def test_declared_checks_run_over_the_target(lake, raw):
    specs = [SourceSpec.from_dict(spec(raw)), SourceSpec.from_dict(spec(raw, source_id="x", target={"table": "bronze_none"}))]
    Ingestor(lake, specs).run_source("cities")
    got = {(r["check_type"], r["passed"]) for r in check_sources(lake, specs).collect()}
    assert got == {("not_null", True), ("row_count", True)}
    assert lake.stats(audit.QUALITY_AUDIT)["rows"] == 2


def test_overwrite_mode(lake, raw):
    one = spec(raw)
    one["target"] = {"table": "bronze_cities", "write_mode": "overwrite"}
    runner = Ingestor(lake, [SourceSpec.from_dict(one)])
    runner.run_source("cities")
    runner.run_source("cities")
    assert lake.stats("bronze_cities")["rows"] == 4


def test_failures_are_isolated_and_recorded(lake, raw):
    good, lost = spec(raw), spec(raw, source_id="lost", file={"base_path": str(raw / "none")})
    odd = spec(raw, source_id="odd", source_type="fax")
    runner = Ingestor(lake, [SourceSpec.from_dict(s) for s in (lost, odd, good)])
    results = runner.run_all(parallel=3)
    assert [(r.source_id, r.status) for r in results] == [
        ("lost", audit.FAILED), ("odd", audit.FAILED), ("cities", audit.SUCCESS)]
    assert lake.read(audit.INGESTION_AUDIT).groupBy("status").count().where("status = 'failed'").first()["count"] == 2
    with pytest.raises(ValueError):
        runner.run_source("unknown")
    with pytest.raises(FileNotFoundError):
        runner.run_source("lost")


def test_new_source_type(lake, raw, spark):
    runner = Ingestor(lake, [SourceSpec.from_dict(spec(raw, source_type="numbers", schema_mapping=None))])

    def numbers(session, _spec):
        return session.range(3)

    runner.register("numbers", numbers)
    assert runner.run_type("numbers")[0].rows_written == 3
    assert runner.source_types()["numbers"] == "numbers"


def test_broken_rows_go_to_quarantine(lake, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.jsonl").write_text('{"City":"A","N":1}\n{bad\n{"City":"B"}\n')
    one = spec(tmp_path, format="jsonl", file={"base_path": str(tmp_path / "raw"), "pattern": "*.jsonl"})
    result = Ingestor(lake, [SourceSpec.from_dict(one)]).run_source("cities")
    assert (result.rows_extracted, result.rows_written, result.rows_rejected) == (3, 2, 1)
    assert [r["raw_text"] for r in lake.read("bronze_cities_quarantine").collect()] == ["{bad"]


def test_api_sources(lake, tmp_path):
    docs, paged = tmp_path / "docs", tmp_path / "paged"
    docs.mkdir(), paged.mkdir()
    (docs / "a.json").write_text('{"name":"X","main":{"temp":1.5},"weather":[{"main":"Rain"}]}')
    (docs / "b.json").write_text('{"data":[\n{"name":"Y","main":{"temp":"hot"}}]}')
    mapping = {"$.name": {"target": "city", "type": "varchar"}, "$.main.temp": {"target": "t", "type": "double"},
               "$.weather[0].main": {"target": "sky"}}
    single = {"source_id": "w", "source_type": "api", "format": "json", "api": {"landing_path": str(docs)}, "schema_mapping": mapping}
    pages = [{"entity": "e", "page_no": n, "body": json.dumps({"data": [{"id": n}] if n < 3 else []})} for n in (1, 2, 3)]
    (paged / "p.jsonl").write_text("\n".join(map(json.dumps, pages)))
    many = {"source_id": "p", "source_type": "api", "api": {"landing_path": str(paged), "pagination": True},
            "schema_mapping": {"$.id": {"target": "route_id", "type": "varchar"}}}
    results = Ingestor(lake, [SourceSpec.from_dict(single), SourceSpec.from_dict(many)]).run_all()
    assert [r.status for r in results] == [audit.SUCCESS] * 2, results
    assert records(lake.read("bronze_w"), "city", "t", "sky") == [("X", 1.5, "Rain"), ("Y", None, None)]
    assert records(lake.read("bronze_p"), "route_id") == [("1",), ("2",)]
    inferred = dict(single, source_id="i", api={"landing_path": str(docs), "infer_columns": True})
    assert Ingestor(lake, [SourceSpec.from_dict(inferred)]).run_source("i").rows_written == 2
    assert "city" in lake.columns("bronze_i")


def test_a_gap_in_landed_pages_fails(lake, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"entity":"e","page_no":1,"body":"[]"}\n{"entity":"e","page_no":3,"body":"[]"}')
    gap = {"source_id": "p", "source_type": "api", "api": {"landing_path": str(tmp_path), "pagination": True}}
    with pytest.raises(RuntimeError, match="gaps"):
        Ingestor(lake, [SourceSpec.from_dict(gap)]).run_source("p")


def test_topic_source_from_landed_envelopes(lake, spark, tmp_path):
    landed = str(tmp_path / "env")
    envelope(spark, b'{"event_id":"e1","timestamp":"2024-01-01T00:00:00Z","value":"3"}', b"{bad").write.parquet(landed)
    mapping = {"event_id": {"target": "event_id"}, "timestamp": {"target": "event_timestamp", "type": "timestamp"},
               "value": {"target": "metric_value", "type": "double"}, "topic": {"target": "kafka_topic"},
               "partition": {"target": "kafka_partition", "type": "integer"}}
    one = {"source_id": "k", "source_type": "kafka", "kafka": {"landing_path": landed}, "schema_mapping": mapping}
    result = Ingestor(lake, [SourceSpec.from_dict(one)]).run_source("k")
    assert (result.rows_extracted, result.rows_written) == (2, 1)
    assert records(lake.read("bronze_k"), "event_id", "metric_value", "kafka_topic", "kafka_partition") == [("e1", 3.0, "t", 0)]
    assert lake.stats("bronze_k_quarantine")["rows"] == 1
