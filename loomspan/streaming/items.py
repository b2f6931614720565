"""The last copy of each item on a stream, whatever the order of arrival: an extension, as batches are the rule here.

State is by key in Spark's state store, which must be RocksDB (spark.sql.streaming.stateStore.providerClass). A key's timer is set anew by each copy; when the stream's event time has passed
it, the key gives one row, as keep_last gives it, and its state goes. A copy that comes later still makes a row of its own, with what is known by then.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class KeepLast(StatefulProcessor):
    def __init__(self, keys: list[str], columns: list[str], schema: T.StructType, ordinal: str, at: str, quiet_ms: int):
        self.keys, self.columns, self.schema, self.ordinal, self.at, self.quiet_ms = keys, columns, schema, ordinal, at, quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.last.get() if self.last.exists() else None
        best, position = (None, None) if known is None else (known[:-2], known[-2])
        seen = 0 if known is None else known[-1]
        place = self.columns.index(self.ordinal)
        for row in rows:
            own = tuple(row[c] for c in self.columns)
            best = own if best is None or own[place] > best[place] else best
            position = own[place] if position is None else min(position, own[place])
            seen = max(seen, int(row["_at_ms"]))
        self.last.update((*best, position, seen))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(max(seen + self.quiet_ms, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.last.get()
        self.last.clear()
        yield Row(*self.keys, *self.columns, "position")(*key, *known[:-1])

    def close(self) -> None:
        pass


def keep_last_stream(rows: DataFrame, keys: list[str], ordinal: str, at: str, quiet: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """rows' columns and position (the least ordinal of a key), one row for each key after `quiet` of event time without a copy. Watermarks trail the event time `at` by `late`."""
    columns = [c for c in rows.columns if c not in keys]
    position = T.StructField("position", rows.schema[ordinal].dataType)
    of = lambda names: [rows.schema[c] for c in names]
    state = T.StructType([*of(columns), position, T.StructField("seen_ms", T.LongType())])
    out = T.StructType([*of(keys), *of(columns), position])
    seconds = rows.sparkSession.sql(f"select cast(interval {quiet} as interval day to second) as q").first()["q"].total_seconds()
    marked = rows.withWatermark(at, late).withColumn("_at_ms", F.unix_millis(at))
    return marked.groupBy(*keys).transformWithState(KeepLast(keys, columns, state, ordinal, at, int(seconds * 1000)), out, "append", "eventTime")
