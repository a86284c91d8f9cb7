"""Closed days of the stored stream in few files.

The intake keeps a partition of small files for every micro-batch, which makes its replays safe. Compaction copies the batches of days
before a given one into ``<table>_closed``, a partition a day, and moves the boundary in the view ``<table>_all``, through which the
stored stream is read:

    batches up to the boundary from ``<table>_closed``, later ones from ``<table>``

The boundary is the number of the last compacted batch of every intake (label). Replacing the view is one catalog step,
so a reader sees a batch in one of the two places, never in both or none. A batch up to the boundary that is written again changes
nothing, since the view doesn't look at it. The newest batch of an intake is never compacted: it is the one that may still be replayed.

A run that fails before the view is replaced is simply repeated: what it wrote lies behind the boundary and is written again. The open
partitions are dropped by the run after, so queries that began on the view before still find their files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from lakeshelf.operators.tables import Lake, _name
from lakeshelf.session import delete_path
from lakeshelf.streaming.bronze import BRONZE_EVENTS, PARTITIONS

DAY, BATCH = PARTITIONS


@dataclass(frozen=True)
class Compaction:
    """What a run did: batches moved, days written, files of those days before and after, partitions dropped."""

    batches: int
    days: tuple[date, ...]
    files_before: int
    files_after: int
    dropped: int


def closed_name(table: str) -> str:
    return f"{table}_closed"


def view_name(table: str) -> str:
    return f"{table}_all"


def _label(batch_id: Column) -> Column:
    return F.regexp_extract(batch_id, r"^(.*)_(\d+)$", 1)


def _number(batch_id: Column) -> Column:
    return F.regexp_extract(batch_id, r"^(.*)_(\d+)$", 2).try_cast("bigint")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def boundary(lake: Lake, table: str) -> dict[str, int]:
    """The last compacted batch of each intake, as the view has it."""
    if not lake.exists(view_name(table)):
        return {}
    described = lake.spark.sql(f"SHOW TBLPROPERTIES {lake.table(view_name(table))}").collect()
    prefix = "compacted_upto."
    return {r["key"].removeprefix(prefix): int(r["value"]) for r in described if r["key"].startswith(prefix)}


def _inside(upto: dict[str, int]) -> str:
    """SQL of the batches up to the boundary: on the partition column alone in the open table, so whole partitions are left out."""
    number = r"TRY_CAST(regexp_extract(`%s`, '^(.*)_(\\d+)$', 2) AS BIGINT)" % BATCH
    label = r"regexp_extract(`%s`, '^(.*)_(\\d+)$', 1)" % BATCH
    each = [f"({label} = {_text(name)} AND {number} <= {last})" for name, last in sorted(upto.items())]
    return f"coalesce({' OR '.join(each)}, false)" if each else "false"


def _replace_view(lake: Lake, table: str, upto: dict[str, int]) -> None:
    columns = ", ".join(_name(c) for c in lake.columns(table))
    parts = [f"SELECT {columns} FROM {lake.table(table)} WHERE NOT {_inside(upto)}"]
    if upto:
        parts.append(f"SELECT {columns} FROM {lake.table(closed_name(table))} WHERE {_inside(upto)}")
    properties = ", ".join(f"{_text(f'compacted_upto.{name}')} = {_text(str(last))}" for name, last in sorted(upto.items()))
    kept = f"TBLPROPERTIES ({properties}) " if properties else ""
    lake.spark.sql(f"CREATE OR REPLACE VIEW {lake.table(view_name(table))} {kept}AS {' UNION ALL '.join(parts)}")


def _partitions(lake: Lake, table: str) -> DataFrame:
    """day, batch_id, label, number of every open partition, from the catalog."""
    listed = lake.spark.sql(f"SHOW PARTITIONS {lake.table(table)}")
    values = F.str_to_map("partition", F.lit("/"), F.lit("="))
    day, batch = values[DAY].try_cast("date").alias("day"), F.url_decode(values[BATCH]).alias("batch_id")
    return listed.select("partition", day, batch).select("*", _label(F.col("batch_id")).alias("label"), _number(F.col("batch_id")).alias("number"))


def _files(df: DataFrame) -> int:
    return df.select("_metadata.file_path").distinct().count()


def compact(lake: Lake, table: str = BRONZE_EVENTS, before: date | None = None, remove_now: bool = False) -> Compaction:
    """Compact the batches of days before ``before`` (today, if not given); drop what earlier runs left open.

    File sizes follow ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: days are dealt over tasks by size, large ones over
    several. A day that gets more batches later is written again with them. ``remove_now`` drops this run's partitions too, where no query is running.
    """
    upto = boundary(lake, table)
    before = before or lake.spark.sql("SELECT current_date()").first()[0]
    open_ = [r for r in _partitions(lake, table).collect() if r["number"] is not None]  # catalog entries, no rows
    newest: dict[str, int] = {}
    for r in open_:
        newest[r["label"]] = max(newest.get(r["label"], -1), r["number"])
    done = [r for r in open_ if r["number"] <= upto.get(r["label"], -1)]
    # of each intake, the batches before the first one that has to stay: the boundary is a number
    first_open = dict(newest)
    for r in open_:
        if r["day"] is None or r["day"] >= before:
            first_open[r["label"]] = min(first_open[r["label"]], r["number"])
    moved = [r for r in open_ if upto.get(r["label"], -1) < r["number"] < first_open[r["label"]]]
    before_files = after_files = 0
    days = sorted({r["day"] for r in moved})
    if moved:
        next_upto = dict(upto)
        for r in moved:
            next_upto[r["label"]] = max(next_upto.get(r["label"], -1), r["number"])
        closed = closed_name(table)
        on_days = F.col(DAY).isin(days)
        fresh = lake.read(table).where(on_days & F.expr(_inside(next_upto)) & ~F.expr(_inside(upto)))
        before_files = _files(fresh)
        rows = fresh
        if lake.exists(closed):
            kept = lake.read(closed).where(on_days & F.expr(_inside(upto)))
            before_files += _files(kept)
            rows = fresh.unionByName(kept)
        if not lake.exists(view_name(table)):
            _replace_view(lake, table, upto)
        lake.overwrite_partitions(rows.select(*[F.col(_name(c)) for c in lake.columns(table) if c != DAY], DAY), closed, [DAY])
        _replace_view(lake, table, next_upto)
        after_files = _files(lake.read(closed).where(on_days))
    elif not lake.exists(view_name(table)):
        _replace_view(lake, table, upto)
    dropped = _drop(lake, table, [*done, *(moved if remove_now else [])])
    return Compaction(len(moved), tuple(days), before_files, after_files, dropped)


def _drop(lake: Lake, table: str, gone: Sequence) -> int:
    """Drop open partitions behind the boundary: the catalog entries first, then their folders."""
    name, root = lake.table(table), lake.location(table)
    for at in range(0, len(gone), 500):
        some = gone[at : at + 500]
        specs = ", ".join(f"PARTITION ({_name(DAY)} = {_text(str(r['day']))}, {_name(BATCH)} = {_text(r['batch_id'])})" for r in some)
        lake.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
        for r in some:
            delete_path(lake.spark, f"{root}/{r['partition']}")
    return len(gone)
