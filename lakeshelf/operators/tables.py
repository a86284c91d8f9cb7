"""Tables of the layers: names, writes, views and catalog questions.

Row counts come from an ``Observation`` on the write itself, so no table is scanned a
second time to be counted.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from lakeshelf.session import delete_path

LAYERS = ("bronze", "silver", "gold", "staging")


def qualify(name: str, schema: str | None = None) -> str:
    """``schema.table``: a dotted name stands, then the explicit schema, then the layer
    the name starts with; any other name stays as it is."""
    if "." in name:
        return name
    if schema:
        return f"{schema}.{name}"
    prefix = name.split("_")[0].lower()
    return f"{prefix}.{name}" if prefix in LAYERS else name


class Lake:
    """The layer databases of one session.

    Tables are Parquet files below ``root/layer/table/<version>``, by default in the
    warehouse folder of the session. A full overwrite writes a new version folder,
    registers it under another name and then exchanges the names, so a failed write or
    registration leaves the old table in place and a table may be overwritten with a query over
    itself. The version before is kept for readers that began on it.

    ``namespace`` is put in front of the database names (``dev_bronze``), so several
    lakes can live in one catalog.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, namespace: str = ""):
        self.spark = spark
        self.namespace = namespace
        self.root = (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
        # Two jobs that commit to one folder at a time can remove each other's files.
        self._locks: dict[str, threading.RLock] = defaultdict(threading.RLock)

    def table(self, name: str, schema: str | None = None) -> str:
        """The catalog name of a table."""
        full = qualify(name, schema)
        return self.namespace + full if "." in full else full

    # ---- catalog ----------------------------------------------------------

    def create_layers(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace}{layer}")

    def location(self, name: str) -> str:
        """The folder of a table's current version."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table(name)}")
        return described.where("col_name = 'Location'").first()["data_type"]

    def exists(self, name: str, schema: str | None = None) -> bool:
        return self.spark.catalog.tableExists(self.table(name, schema))

    def list_tables(self, schema: str | None = None) -> list[tuple[str, str]]:
        """(schema, table) of one schema, or of all schemas of this lake's namespace."""
        catalog, prefix = self.spark.catalog, self.namespace
        schemas = [schema] if schema else [
            d.name.removeprefix(prefix) for d in catalog.listDatabases() if d.name.startswith(prefix)
        ]
        return [(s, t.name) for s in schemas for t in catalog.listTables(prefix + s) if not t.isTemporary]

    def stats(self, name: str) -> dict:
        """Row count of a table; a table that cannot be read counts zero, with the error."""
        table = self.table(name)
        try:
            return {"table": table, "rows": self.spark.table(table).count()}
        except AnalysisException as error:
            return {"table": table, "rows": 0, "error": str(error)}

    def read(self, name: str | None = None, query: str | None = None, limit: int | None = None) -> DataFrame:
        """A table, optionally its first ``limit`` rows, or the result of a SQL query."""
        if query:
            return self.spark.sql(query)
        df = self.spark.table(self.table(name))
        return df if limit is None else df.limit(limit)

    def columns(self, name: str) -> list[str]:
        return self.spark.table(self.table(name)).columns

    def partition_columns(self, name: str) -> list[str]:
        listed = self.spark.catalog.listColumns(self.table(name))
        return [c.name for c in listed if c.isPartition]

    # ---- writes -----------------------------------------------------------

    def _prepared(self, df: DataFrame, partition_by: Sequence[str], rebalance: bool):
        """The frame to write, counted, and a function that gives the count.

        Rows spread over many partitions are rebalanced first, or every task would write
        a file into every partition. AQE splits a partition that is too large for one
        task, so a day that holds a third of the rows is written by many; without AQE
        one task would get it, so then the rows stay where they are. The counter sits
        behind that shuffle, in the tasks that write, where a retry does not count twice.
        """
        if rebalance and partition_by and _adaptive(df.sparkSession):
            df = df.hint("rebalance", *_quoted(partition_by))
        seen = Observation()
        return df.observe(seen, F.count(F.lit(1)).alias("n")), lambda: int(seen.get["n"])

    def _register(self, table: str, schema: T.StructType, path: str, partition_by: Sequence[str]) -> None:
        """Point the catalog at a folder of Parquet files."""
        order = [c for c in schema.names if c not in partition_by] + list(partition_by)
        columns = ", ".join(f"{_name(c)} {schema[c].dataType.simpleString()}" for c in order)
        parts = f"PARTITIONED BY ({', '.join(map(_name, partition_by))})" if partition_by else ""

        def create(name: str) -> None:
            # an overwriting insert replaces only the partitions it has rows for
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet "
                f"OPTIONS (partitionOverwriteMode 'dynamic') {parts} LOCATION '{path}'"
            )
            if partition_by:
                self.spark.sql(f"MSCK REPAIR TABLE {name}")

        if not self.spark.catalog.tableExists(table):
            create(table)
            return
        now = self.spark.table(table).schema
        if not partition_by and [(f.name, f.dataType) for f in now] == [(c, schema[c].dataType) for c in order]:
            if not any(c.isPartition for c in self.spark.catalog.listColumns(table)):
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")  # one step for readers
                self.spark.catalog.refreshTable(table)
                return
        # all that can fail is done under another name, and only then the names are exchanged
        beside = f"{table}_{uuid.uuid4().hex[:12]}"
        former = f"{beside}_former"
        create(beside)
        try:
            self.spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
        except Exception:
            self.spark.sql(f"DROP TABLE {beside}")
            raise
        try:
            self.spark.sql(f"ALTER TABLE {beside} RENAME TO {table}")
        except Exception:
            self.spark.sql(f"ALTER TABLE {former} RENAME TO {table}")
            raise
        self.spark.sql(f"DROP TABLE {former}")

    def _forget_versions(self, table: str, keep: set[str]) -> None:
        """Delete version folders of this lake's own that are older than the last two.

        The version before stays: queries that began on it still read its files. Folders
        elsewhere, such as raw data an external table was made over, are never touched.
        """
        home = self._home(table)
        names = {k.rstrip("/").rsplit("/", 1)[-1] for k in keep}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(home)
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(path):
            return
        for status in system.listStatus(path):
            name = status.getPath().getName()
            if status.isDirectory() and re.fullmatch(r"[0-9a-f]{32}", name) and name not in names:
                delete_path(self.spark, f"{home}/{name}")

    def _home(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def append(
        self, df: DataFrame, name: str, partition_by: Sequence[str] = (), rebalance: bool = True
    ) -> int:
        """Append by column name, creating the table if needed; returns the row count.

        New columns of ``df`` are an error here; ``incremental.sync_columns`` adds them.
        """
        table = self.table(name)
        with self._locks[table]:
            if not self.exists(name):
                return self.overwrite(df, name, partition_by, rebalance)
            kept = self.columns(name)
            extra = sorted(set(df.columns) - set(kept))
            if extra:
                raise ValueError(f"{table} has no column {', '.join(extra)}")
            absent = {c: F.lit(None) for c in kept if c not in df.columns}
            filled = df.withColumns(absent) if absent else df
            counted, rows = self._prepared(filled.select(*_quoted(kept)), self.partition_columns(name), rebalance)
            counted.write.insertInto(table)
        return rows()

    def overwrite(
        self, df: DataFrame, name: str, partition_by: Sequence[str] = (), rebalance: bool = True
    ) -> int:
        """Replace the whole table; returns the row count.

        ``rebalance=False`` saves a shuffle where all rows go to one partition or few.
        """
        table = self.table(name)
        counted, rows = self._prepared(df, partition_by, rebalance)
        path = f"{self._home(table)}/{uuid.uuid4().hex}"
        with self._locks[table]:
            old = self.location(name) if self.exists(name) else None
            writer = counted.write.partitionBy(*partition_by) if partition_by else counted.write
            writer.parquet(path)
            self._register(table, df.schema, path, partition_by)
            self._forget_versions(table, {path, *([old] if old else [])})
        return rows()

    def drop_partitions(self, name: str, column: str, which: Callable[[Any], bool]) -> int:
        """Drop the partitions whose value of ``column`` (the only partition column) passes ``which``."""
        table = self.table(name)
        if self.partition_columns(name) != [column]:
            raise ValueError(f"{table} is not partitioned by {column} alone")
        kind = self.read(name).schema[column].dataType
        value = F.split(F.col("partition"), "=").getItem(1)
        listed = self.spark.sql(f"SHOW PARTITIONS {table}").select(
            value.alias("text"), F.when(value != "__HIVE_DEFAULT_PARTITION__", value).try_cast(kind).alias("value")
        )
        gone = [r["text"] for r in listed.collect() if which(r["value"])]
        with self._locks[table]:
            for text in gone:
                # the catalog entry goes first, so that no reader looks for files that are gone
                folder = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({_name(column)} = '{text}')")
                place = folder.where("col_name = 'Location'").first()["data_type"]
                self.spark.sql(f"ALTER TABLE {table} DROP PARTITION ({_name(column)} = '{text}')")
                if place.startswith(self.location(name)):
                    delete_path(self.spark, place)
        return len(gone)

    def write(
        self, df: DataFrame, name: str, mode: str = "append", partition_by: Sequence[str] = (), rebalance: bool = True
    ) -> int:
        if mode not in ("append", "overwrite", "replace"):
            raise ValueError(f"unknown write mode {mode!r}")
        target = self.append if mode == "append" else self.overwrite
        return target(df, name, partition_by, rebalance)

    def overwrite_partitions(
        self, df: DataFrame, name: str, partition_by: Sequence[str], rebalance: bool = True
    ) -> int:
        """Replace exactly the partitions that occur in ``df``.

        Running the same batch again gives the same table. ``df`` may read the table
        itself: new files are written beside the old ones and swapped at commit.
        """
        table = self.table(name)
        if not self.exists(name):
            return self.overwrite(df, name, partition_by, rebalance)
        if self.partition_columns(name) != list(partition_by):
            raise ValueError(f"{table} is partitioned by {self.partition_columns(name)}, not {partition_by}")
        counted, rows = self._prepared(df.select(*_quoted(self.columns(name))), partition_by, rebalance)
        with self._locks[table]:
            counted.write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)
        return rows()

    # ---- views ------------------------------------------------------------

    def create_view(self, df: DataFrame, name: str) -> None:
        """A view of this session over a plan; nothing is computed or stored."""
        df.createOrReplaceTempView(name)

    def create_sql_view(self, name: str, sql: str) -> None:
        """A view kept in the catalog."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.table(name)} AS {sql}")


def _adaptive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(_name(n)) for n in names]
