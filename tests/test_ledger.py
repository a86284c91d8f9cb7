"""Files that aren't whole are left out as a whole, and the ledger says what became of each."""

import bz2
import gzip
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lakeshelf.operators import audit
from lakeshelf.sources import files
from lakeshelf.sources.ingest import Ingestor
from lakeshelf.sources.spec import SourceSpec

TEXT = "a,b\n" + "".join(f"{i},{i * 37 % 1009}\n" for i in range(100_000))


def read(spark, where, pattern="*", fmt="csv", **options):
    outcomes = []
    df = files.read_files(spark, str(where), pattern, fmt, True, files.FileOptions(**options), outcomes)
    found = {}
    for frame in outcomes:
        found |= {os.path.basename(r["path"]): r for r in frame.collect()}
    return df, found


def test_a_truncated_compressed_file_gives_no_row(spark, tmp_path):
    data = gzip.compress(TEXT.encode())
    (tmp_path / "whole.csv.gz").write_bytes(gzip.compress(b"a,b\n1,2\n"))
    (tmp_path / "half.csv.gz").write_bytes(data[: len(data) // 2])
    (tmp_path / "flipped.csv.gz").write_bytes(data[:-6] + bytes([data[-6] ^ 1]) + data[-5:])
    (tmp_path / "none.csv.gz").write_bytes(b"nothing compressed")
    (tmp_path / "two.csv.bz2").write_bytes(bz2.compress(TEXT.encode())[:-40])
    df, found = read(spark, tmp_path)
    assert [(r["a"], r["b"]) for r in df.collect()] == [("1", "2")]
    assert {k: r["status"] for k, r in found.items()} == {
        "whole.csv.gz": "whole", "half.csv.gz": "damaged", "flipped.csv.gz": "damaged", "none.csv.gz": "unreadable", "two.csv.bz2": "damaged"}
    half = found["half.csv.gz"]
    assert half["size"] == len(data) // 2 >= half["damaged_at"] > 0 and half["detail"]
    with pytest.raises(files.UnreadableFile, match="damaged|unreadable"):
        read(spark, tmp_path, tolerate_bad_files=False)
    with pytest.raises(Exception):  # never half a file, also where files aren't examined
        read(spark, tmp_path, "half*", verify_files=False)[0].collect()


def test_a_parquet_file_damaged_in_a_page(spark, tmp_path):
    table = pa.table({"a": pa.array(range(50_000), pa.int64()), "b": [f"x{i}" for i in range(50_000)]})
    for name in ("good", "bad", "cut"):
        pq.write_table(table, tmp_path / f"{name}.parquet", compression="zstd", row_group_size=10_000, write_page_checksum=True)
    bad = bytearray((tmp_path / "bad.parquet").read_bytes())
    middle = len(bad) // 2
    bad[middle : middle + 40] = bytes(40)
    (tmp_path / "bad.parquet").write_bytes(bad)
    (tmp_path / "cut.parquet").write_bytes((tmp_path / "cut.parquet").read_bytes()[:5000])
    df, found = read(spark, tmp_path, "*.parquet", "parquet")
    assert df.count() == 50_000 and {r["_source_file"] for r in df.select("_source_file").distinct().collect()} == {"good.parquet"}
    assert {k: r["status"] for k, r in found.items()} == {"good.parquet": "whole", "bad.parquet": "damaged", "cut.parquet": "unreadable"}
    assert 0 < found["bad.parquet"]["damaged_at"] <= middle


def test_headers_that_never_end_do_not_stop_the_load(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_HEADER_MOST", 300_000)
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "quote.csv").write_text('"a,b\n' + "1,2\n" * 200_000)
    (tmp_path / "line.csv").write_text("x" * 900_000)
    df, found = read(spark, tmp_path, "*.csv")
    assert [(r["a"], r["b"]) for r in df.collect()] == [("1", "2")]
    assert {k: r["status"] for k, r in found.items()} == {"a.csv": "whole", "quote.csv": "unreadable", "line.csv": "unreadable"}


def test_the_ledger_is_written_with_the_run(lake, spark, tmp_path):
    data = gzip.compress(TEXT.encode())
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv.gz").write_bytes(gzip.compress(b"a,b\n1,2\n"))
    (tmp_path / "in" / "b.csv.gz").write_bytes(data[: len(data) // 2])
    spec = SourceSpec.from_dict({
        "source_id": "s", "source_type": "file", "file": {"base_path": str(tmp_path / "in"), "pattern": "*.csv.gz"},
        "target": {"table": "bronze_s"}, "schema_mapping": {}})
    result = Ingestor(lake, [spec]).run_source("s")
    assert (result.status, result.rows_written) == ("success", 1)
    rows = {os.path.basename(r["path"]): (r["source_id"], r["status"]) for r in lake.read(audit.FILE_LEDGER).collect()}
    assert rows == {"a.csv.gz": ("s", "whole"), "b.csv.gz": ("s", "damaged")}
    (tmp_path / "in" / "a.csv.gz").unlink()
    with pytest.raises(RuntimeError):
        Ingestor(lake, [spec]).run_source("s")
    assert lake.read(audit.FILE_LEDGER).count() == 3  # a failed run's files too
