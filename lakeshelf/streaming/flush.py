"""Batches of at most so many messages, or of what came within so many seconds, for each topic partition.

The buffers are keyed state: a list of the messages held, the number of the next batch and the time by which the oldest
message has to go. Full batches leave as they fill; a processing-time timer lets the rest go. State, numbers and output belong to one
micro-batch, so a replay gives the same batches under the same numbers.

A topic partition is a key, and one key's messages pass through one task in order of offset, as in a consumer group. A partition
that is too hot for one task is split by ``lanes``: offsets are dealt over so many keys, each with batches of its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

BATCH_SIZE, FLUSH_SECONDS = 100, 30
#: Why a batch left: it was full, its time was up, or nothing may be held.
FULL, TIME, END = "full", "time", "end"

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_HELD = "key binary, value binary, offset long, timestamp timestamp"
OUTPUT = (
    "topic string, partition int, lane int, offset long, key binary, value binary, timestamp timestamp, "
    "batch_no long, batch_size int, reason string"
)
_COLUMNS = ["key", "value", "offset", "timestamp"]

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FlushProcessor(StatefulProcessor):
    def __init__(self, batch_size: int, flush_ms: int):
        self.batch_size, self.flush_ms = batch_size, flush_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _HELD)
        #: the next batch's number, and the timer that is set (0: none)
        self.mark = handle.getValueState("mark", "batch_no long, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        number, due = self.mark.get() if self.mark.exists() else (0, 0)
        held = list(self.held.get()) if self.held.exists() else []
        came = sorted((r for frame in rows for r in zip(*(frame[c] for c in _COLUMNS))), key=lambda r: r[2])
        held += [(_bytes(k), _bytes(v), int(o), _time(ts)) for k, v, o, ts in came]
        out = []
        while len(held) >= self.batch_size:
            out += self._batch(key, held[: self.batch_size], number, FULL)
            held, number = held[self.batch_size :], number + 1
        if held and not self.flush_ms:
            out += self._batch(key, held, number, END)
            held, number = [], number + 1
        if due and (out or not held):  # what it was set for is gone
            self.handle.deleteTimer(due)
            due = 0
        if held and not due:
            due = timerValues.getCurrentProcessingTimeInMs() + self.flush_ms
            self.handle.registerTimer(due)
        self._keep(held, number, due)
        if out:
            yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, due = self.mark.get()
        if due and due <= expiredTimerInfo.getExpiryTimeInMs() and self.held.exists():
            held = list(self.held.get())
            self._keep([], number + 1, 0)
            yield _frame(self._batch(key, held, number, TIME))

    def close(self) -> None:
        pass

    def _keep(self, held: list[tuple], number: int, due: int) -> None:
        if held:
            self.held.put(held)
        else:
            self.held.clear()
        self.mark.update((number, due))

    @staticmethod
    def _batch(key, messages: list[tuple], number: int, reason: str) -> list[tuple]:
        return [(*key, m[2], m[0], m[1], m[3], number, len(messages), reason) for m in messages]


def _bytes(value):
    return None if value is None else bytes(value)


def _time(value):
    return None if pd.isna(value) else pd.Timestamp(value).to_pydatetime()


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [field.split()[0] for field in OUTPUT.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"partition": "int32", "lane": "int32", "batch_size": "int32"})


def flush_batches(
    envelopes: DataFrame, batch_size: int = BATCH_SIZE, flush_seconds: float = FLUSH_SECONDS, lanes: int = 1
) -> DataFrame:
    """Messages with the number of their batch (per topic, partition and lane), its size and why it left.

    No batch is larger than ``batch_size``; no message is held for longer than ``flush_seconds`` and a trigger. With 0 seconds nothing is
    held from one trigger to the next, for scheduled runs that end when they have read all. Needs the RocksDB state store, which
    is set for the session here.
    """
    if batch_size < 1 or flush_seconds < 0 or lanes < 1:
        raise ValueError("batch_size and lanes must be at least 1, flush_seconds at least 0")
    envelopes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    keyed = envelopes.select("topic", "partition", F.pmod("offset", F.lit(lanes)).cast("int").alias("lane"), *_COLUMNS)
    return keyed.groupBy("topic", "partition", "lane").transformWithStateInPandas(
        FlushProcessor(batch_size, round(flush_seconds * 1000)), OUTPUT, "Append", "ProcessingTime"
    )
