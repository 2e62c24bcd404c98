"""Idle periods of warehouses as they close (N04).

A stateful stream that gives the islands of the batch model: an island is a stretch of
idle intervals in time order without a busy one between them, however long the gaps
warehouse the state has the open island and the intervals newer than the watermark,
which an event-time timer brings up in order; at one start, busy intervals come before
idle ones. An island that no busy interval has ended stays in the state.

A warehouse is one key, and its intervals have an order, so one task handles it; a
micro-batch brings it as many intervals as a trigger's time holds, and the state has one
island and the intervals of the watermark's delay."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from costlens.streaming.state import event_time, micros, use_state_store, wall_clock

OUT_SCHEMA = "warehouse_name string, idle_start timestamp_ntz, idle_end timestamp_ntz"
_INNER = "warehouse_name string, start_us long, end_us long"


class Islands(StatefulProcessor):
    """Times are microseconds; an interval is (start, end, idle)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "start_us long, end_us long")
        self.pending = handle.getListState("pending", "start_us long, end_us long, idle boolean")
        self.timer = handle.getValueState("timer", "at_ms long")

    def _advance(self, name: str | None, new: list[tuple], watermark_ms: int) -> Iterator[Row]:
        """Takes the waiting intervals up to the watermark in order and keeps the rest,
        with a timer at the first of them."""
        held = [tuple(x) for x in self.pending.get()] if self.timer.exists() else []
        waiting = sorted(held + new, key=lambda x: (x[0], x[2]))
        island = tuple(self.open.get()) if self.open.exists() else None
        before, taken = island, 0
        for start, end, idle in waiting:
            if start > watermark_ms * 1000:
                break
            taken += 1
            if idle:
                ends = [e for e in (island and island[1], end) if e is not None]
                island = (island[0] if island else start, max(ends, default=None))
            elif island is not None:
                yield Row(warehouse_name=name, start_us=island[0], end_us=island[1])
                island = None
        if island != before:
            self.open.update(island) if island else self.open.clear()
        rest = waiting[taken:]
        if rest:
            at = rest[0][0] // 1000
            self.pending.put(rest)
            self.timer.update((at,))
            self.handle.registerTimer(at)
        elif held:
            self.pending.clear()
            self.timer.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r.start_us, r.end_us, r.idle) for r in rows]
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
        return self._advance(key[0], new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._advance(key[0], [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def idle_stream(utilisation: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """warehouse_name, idle_start and idle_end of every island that has closed.
    ``utilisation``: a streaming frame in the schema of ``warehouse_utilisation``; an
    interval older than ``lateness`` before the newest is no longer taken, one without a
    start is left out, and one of unknown idleness counts as busy."""
    use_state_store(utilisation.sparkSession)
    rows = utilisation.filter(F.col("interval_start").isNotNull()).select(
        "warehouse_name", micros(F.col("interval_start")).alias("start_us"), micros(F.col("interval_end")).alias("end_us"),
        F.coalesce("is_idle", F.lit(False)).alias("idle"), event_time(F.col("interval_start")).alias("event_time"))
    closed = rows.withWatermark("event_time", lateness).groupBy("warehouse_name").transformWithState(Islands(), _INNER, "append", "eventTime")
    return closed.select("warehouse_name", wall_clock(F.col("start_us")).alias("idle_start"), wall_clock(F.col("end_us")).alias("idle_end"))
