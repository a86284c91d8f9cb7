"""Incremental loads of date-partitioned facts, and following schema changes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from lakeshelf.operators.tables import Lake, _quoted
from lakeshelf.session import staged


def newest(lake: Lake, table: str, column: str, partition_by: str):
    """Largest value of a column of the target, or None if it has no rows.

    The column must grow with the partition, so only the newest partition is read; which
    one that is, the catalog knows.
    """
    target = lake.read(table)
    kind = target.schema[partition_by].dataType
    listed = lake.spark.sql(f"SHOW PARTITIONS {lake.table(table)}")
    value = F.split(F.col("partition"), "=").getItem(1).try_cast(kind)
    last = listed.agg(F.max(value)).first()[0]
    if last is None:
        return None
    return target.where(F.col(partition_by) == F.lit(last)).agg(F.max(column)).first()[0]


def month_start(day: date) -> date:
    return day.replace(day=1)


def with_month(df: DataFrame, day: str = "date_key", name: str = "month_key") -> DataFrame:
    """Add the month a row belongs to. Facts are partitioned by it: they hold few rows a
    day, and a folder per day would be a tiny file per day."""
    return df.withColumn(name, F.trunc(day, "month"))


def replace_days(
    lake: Lake,
    table: str,
    fresh: DataFrame,
    first_day: date,
    day: str,
    partition_by: str,
    partition_start: Callable[[date], date] = month_start,
) -> int:
    """Replace all target rows from ``first_day`` on by ``fresh``.

    Partitions from there on for which no rows are left are dropped. ``partition_start`` gives the partition a
    day lies in. The partition that begins before ``first_day`` keeps its earlier rows; only that
    partition of the target is read.
    """
    start = partition_start(first_day)
    if start < first_day:
        kept = lake.read(table).where((F.col(partition_by) == F.lit(start)) & (F.col(day) < F.lit(first_day)))
        fresh = fresh.unionByName(kept, allowMissingColumns=True)
    # kept in the shared folder: the partitions that it fills must be known, and be the same when it is written
    fresh, release = staged(fresh, "days")
    try:
        filled = {r[0] for r in fresh.select(partition_by).distinct().collect()}  # days or months
        rows = lake.overwrite_partitions(fresh, table, [partition_by])
        lake.drop_partitions(table, partition_by, lambda value: value is not None and value >= start and value not in filled)
    finally:
        release()
    return rows


def load(
    lake: Lake,
    table: str,
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    source_column: str,
    target_column: str,
    day: str,
    partition_by: str,
    lookback_days: int | None = None,
    time_column: str | None = None,
    partition_start: Callable[[date], date] = month_start,
) -> int:
    """Build and store only what is newer than the target; returns the rows written.

    The newest target value is fetched first (one value, from one partition), so the source filter is a
    literal. Where ``source_column`` is computed (an hour or a day), name the raw time in
    ``time_column``: the bound then also reaches the scan and skips files.

    Without ``lookback_days`` only source rows *strictly* newer than the target are
    read; their keys are new by definition, so the result is appended. A group that was
    half full keeps its old row, and late rows are left out.

    With it, the days from ``lookback_days`` before the newest one on are built again and
    replaced, which also picks up late rows.

    An absent or empty target gets a full load.
    """
    high = newest(lake, table, target_column, partition_by) if lake.exists(table) else None
    if high is None:
        return lake.overwrite(build(source), table, [partition_by])
    if lookback_days is None:
        if time_column:
            source = source.where(F.col(time_column) >= F.lit(high))
        fresh = build(source.where(F.col(source_column) > F.lit(high)))
        sync_columns(lake, table, fresh)
        return lake.append(fresh, table, [partition_by])
    first_day = newest(lake, table, day, partition_by) - timedelta(days=lookback_days)
    if time_column:
        source = source.where(F.col(time_column) >= F.lit(first_day))
    fresh = build(source.where(F.to_date(source_column) >= F.lit(first_day)))
    sync_columns(lake, table, fresh)
    return replace_days(lake, table, fresh, first_day, day, partition_by, partition_start)


PROGRESS = "gold.refresh_progress"
PROGRESS_COLUMNS = "target string, arrived_upto timestamp, groups bigint, recorded_at timestamp"

#: So many partitions are named in the filter; beyond, they are joined (and pruned at run time).
NAMED_PARTITIONS = 4000


@dataclass(frozen=True)
class Groups:
    """How a source is cut into the groups that a target holds.

    ``source``: column of the source that names a row's group, and ``target``: the target's column for it. ``partition_by``: the target's
    partition column, with ``partition_of`` giving the partition of a group. ``source_partition`` (optional): the partition column of the source, with
    ``source_partition_of`` giving where a group's rows lie; ``time_column`` (optional): a raw time that lies within a group named by
    time, to skip files by its range.
    """

    source: str
    target: str
    partition_by: str
    partition_of: Callable[[Column], Column]
    source_partition: str | None = None
    source_partition_of: Callable[[Column], Column] = F.to_date
    time_column: str | None = None
    group_span: timedelta = timedelta(hours=1)


def arrived_upto(lake: Lake, table: str):
    """The arrival time up to which rows are in the target, or None."""
    if not lake.exists(PROGRESS):
        return None
    return lake.read(PROGRESS).where(F.col("target") == lake.table(table)).agg(F.max("arrived_upto")).first()[0]


def refresh_groups(
    lake: Lake,
    table: str,
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    groups: Groups,
    arrival: str = "_ingestion_timestamp",
) -> int:
    """Recompute exactly the groups that rows arrived for since the last run; returns how many (all, on a first run: -1).

    Late rows need no look-back to be chosen: what counts is when a row arrived (``arrival``), not the time it is about. The groups of
    the newly arrived rows are found first, with a scan that arrival times let skip older files. Then only the partitions that hold
    these groups are read, in the source and in the target, and the groups are built from all of their rows. Rows that arrived at
    the very time of the last mark are taken again, so none is missed; a run that is repeated gives the same table. Rows without
    an arrival time are seen by the first run only.
    """
    seen = arrived_upto(lake, table) if lake.exists(table) else None
    newest_arrival = source.agg(F.max(arrival)).first()[0]  # before the build: what arrives meanwhile comes again next time
    if seen is None:
        lake.overwrite(build(source), table, [groups.partition_by])
        _record_progress(lake, table, newest_arrival, -1)
        return -1
    new = source.where(F.col(arrival) >= F.lit(seen)).select(F.col(groups.source).alias("__group")).distinct()
    touched, release = staged(new, "touched")
    try:
        count = touched.count()
        if count:
            fresh = build(_rows_of(source, touched, groups))
            sync_columns(lake, table, fresh)
            _replace_groups(lake, table, fresh, touched, groups)
    finally:
        release()
    _record_progress(lake, table, newest_arrival, count)
    return count


def _record_progress(lake: Lake, table: str, upto, count: int) -> None:
    row = lake.spark.createDataFrame([(lake.table(table), upto, count)], "target string, arrived_upto timestamp, groups bigint")
    lake.append(row.withColumn("recorded_at", F.current_timestamp()), PROGRESS)


def _in_partitions(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose partition is among the values of ``wanted`` (one column), nulls included."""
    wanted = wanted.toDF("__part").distinct()
    listed = [r[0] for r in wanted.limit(NAMED_PARTITIONS + 1).collect()]
    if len(listed) > NAMED_PARTITIONS:
        return rows.join(wanted, rows[column].eqNullSafe(wanted["__part"]), "left_semi")
    inside = F.col(column).isin([v for v in listed if v is not None])
    return rows.where(inside | F.col(column).isNull() if None in listed else inside)


def _rows_of(source: DataFrame, touched: DataFrame, groups: Groups) -> DataFrame:
    """All source rows of the touched groups, from their partitions and time range."""
    if groups.source_partition:
        places = touched.select(groups.source_partition_of(F.col("__group")))
        source = _in_partitions(source, groups.source_partition, places)
    if groups.time_column:
        first, last, nulls = touched.agg(F.min("__group"), F.max("__group"), F.count_if(F.col("__group").isNull())).first()
        if first is not None and not nulls:
            source = source.where(
                (F.col(groups.time_column) >= F.lit(first)) & (F.col(groups.time_column) < F.lit(last) + F.lit(groups.group_span)))
    return source.join(touched, source[groups.source].eqNullSafe(touched["__group"]), "left_semi")


def _replace_groups(lake: Lake, table: str, fresh: DataFrame, touched: DataFrame, groups: Groups) -> None:
    """Delete the target rows of the touched groups, then add the fresh ones; untouched partitions are not read."""
    columns = lake.columns(table)
    places = touched.select(groups.partition_of(F.col("__group")))
    old = _in_partitions(lake.read(table), groups.partition_by, places)
    kept = old.join(touched, old[groups.target].eqNullSafe(touched["__group"]), "left_anti")
    merged, release = staged(kept.select(*_quoted(columns)).unionByName(fresh.select(*_quoted(columns))), "groups")
    try:
        filled = {r[0] for r in merged.select(groups.partition_by).distinct().collect()}
        emptied = {r[0] for r in places.toDF("p").distinct().collect()} - filled
        lake.overwrite_partitions(merged, table, [groups.partition_by])
        if emptied:
            lake.drop_partitions(table, groups.partition_by, lambda value: value in emptied)
    finally:
        release()


def replace_by_key(lake: Lake, table: str, delta: DataFrame, key: Sequence[str], partition_by: str) -> int:
    """Delete the target rows whose key occurs in ``delta``, then add ``delta``.

    Only partitions that ``delta`` touches are read (dynamic partition pruning) and
    replaced. ``partition_by`` has to be part of the key, or a row could live on in a
    partition that is not looked at. ``delta`` must hold each key once.
    """
    if partition_by not in key:
        raise ValueError(f"the partition column {partition_by} must be part of the key {list(key)}")
    if not lake.exists(table):
        return lake.overwrite(delta, table, [partition_by])
    # written once: it is used three times below, and must not change in between
    delta, release = staged(delta, "delta")
    try:
        return _replace_by_key(lake, table, delta, key, partition_by)
    finally:
        release()


def _replace_by_key(lake: Lake, table: str, delta: DataFrame, key: Sequence[str], partition_by: str) -> int:
    sync_columns(lake, table, delta)
    touched = delta.select(F.col(partition_by).alias("__touched")).distinct()
    old = lake.read(table)
    # null-safe: the partition of null values is replaced as a whole like any other
    old = old.join(touched, old[partition_by].eqNullSafe(touched["__touched"]), "left_semi")
    same_key = None
    d = delta.select(*[F.col(k).alias(f"__{k}") for k in key])
    for k in key:
        match = old[k].eqNullSafe(d[f"__{k}"])
        same_key = match if same_key is None else same_key & match
    kept = old.join(d, same_key, "left_anti")
    columns = lake.columns(table)
    merged = kept.select(*_quoted(columns)).unionByName(delta.select(*_quoted(columns)))
    return lake.overwrite_partitions(merged, table, [partition_by])


@dataclass(frozen=True)
class ColumnChange:
    added: tuple[str, ...]
    removed: tuple[str, ...]
    retyped: tuple[str, ...]

    @property
    def any(self) -> bool:
        return bool(self.added or self.removed or self.retyped)


def column_change(lake: Lake, table: str, wanted: DataFrame) -> ColumnChange:
    have = {f.name: f.dataType for f in lake.read(table).schema.fields}
    want = {f.name: f.dataType for f in wanted.schema.fields}
    return ColumnChange(
        added=tuple(c for c in want if c not in have),
        removed=tuple(c for c in have if c not in want),
        retyped=tuple(c for c in want if c in have and want[c] != have[c]),
    )


def sync_columns(lake: Lake, table: str, wanted: DataFrame) -> ColumnChange:
    """Make the columns of the table those of ``wanted``.

    Adding columns only changes the catalog. Removing or retyping one writes a new
    version of the table, because Parquet tables cannot drop a column in place.
    """
    change = column_change(lake, table, wanted)
    if not change.any:
        return change
    if not change.removed and not change.retyped:
        ddl = ", ".join(f"`{c}` {wanted.schema[c].dataType.simpleString()}" for c in change.added)
        lake.spark.sql(f"ALTER TABLE {lake.table(table)} ADD COLUMNS ({ddl})")
        return change
    parts = lake.partition_columns(table)
    have = lake.columns(table)
    current = lake.read(table)
    select = [
        (F.col(f"`{f.name}`").cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in wanted.schema.fields
    ]
    lake.overwrite(current.select(*select), table, parts)
    return change
