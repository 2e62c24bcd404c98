"""Alert episodes as a stream (N03).

The stream keeps, per alert and resource, the last episode number and the last
detection in a value state (``transformWithState``) and applies the rule of the batch
tracker: an alert seen again within the active window continues its episode, anything
else opens the next one. The clock is ``clock`` of the alert rows, the time of the run
that found them, so a stream that runs for weeks, or that is replayed, decides as the
batches did. An event-time timer drops the state of a key that has been silent for
``ttl_days``; its next alert opens episode 1 again."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from costlens.streaming.state import event_time, micros, use_state_store, wall_clock

#: Columns of the episodes; times inside the processor are microseconds.
OUT_SCHEMA = ("alert_episode_key string, alert_id string, detected_at timestamp_ntz, resource_key string, "
              "alert_resource_key string, metric_value double, threshold_value double, details_json string, "
              "is_new_episode boolean, is_continuation boolean, episode_number long, evaluated_at timestamp_ntz")
_INNER = ("alert_id string, resource_key string, detected_us long, clock_us long, metric_value double, threshold_value double, "
          "details_json string, is_continuation boolean, episode_number long")
STATE_SCHEMA = "last_episode long, last_us long, expires_ms long"
HOUR_US, DAY_US = 3_600_000_000, 86_400_000_000


class Episodes(StatefulProcessor):
    """One value per key; a timer that a new alert of the key moves on."""

    def __init__(self, active_hours: int, ttl_days: int):
        self.active, self.ttl = active_hours * HOUR_US, ttl_days * DAY_US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", STATE_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # newest detection, then largest value, then smallest details, as the batch tracker
        newest = rank = None
        for r in rows:
            this = (r.detected_us, r.metric_value is not None, r.metric_value or 0.0)
            if newest is None or this > rank or this == rank and (r.details_json or "") < (newest.details_json or ""):
                newest, rank = r, this
        episode, continues, seen = 1, False, newest.detected_us
        if self.last.exists():
            number, before, expires = self.last.get()
            continues = before >= newest.clock_us - self.active
            episode, seen = number + (0 if continues else 1), max(before, seen)
            self.handle.deleteTimer(expires)
        expires = (seen + self.ttl) // 1000
        self.last.update((episode, seen, expires))
        self.handle.registerTimer(expires)
        yield Row(alert_id=key[0], resource_key=key[1], detected_us=newest.detected_us, clock_us=newest.clock_us, metric_value=newest.metric_value,
                  threshold_value=newest.threshold_value, details_json=newest.details_json, is_continuation=continues, episode_number=episode)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def episode_stream(alerts: DataFrame, clock: Column | None = None, active_hours: int = 6, ttl_days: int = 400,
                   lateness: str = "7 days") -> DataFrame:
    """``alerts``: a streaming frame in the alert union schema. ``clock``: when the
    alert was evaluated, its detection by default. Rows with a null resource key are one
    key of their alert, without episode key, as in the batch model; those without a
    detection time are left out. Rows whose clock is older than ``lateness`` before the
    newest are no longer taken."""
    use_state_store(alerts.sparkSession)
    now = F.col("detected_at") if clock is None else clock
    timed = (alerts.filter(F.col("detected_at").isNotNull())
             .select("alert_id", "resource_key", micros(F.col("detected_at")).alias("detected_us"), micros(now).alias("clock_us"),
                     "metric_value", "threshold_value", "details_json", event_time(now).alias("event_time"))
             .withWatermark("event_time", lateness))
    found = timed.groupBy("alert_id", "resource_key").transformWithState(Episodes(active_hours, ttl_days), _INNER, "append", "eventTime")
    return found.select(
        F.concat("alert_id", F.lit("_episode_"), F.col("episode_number").cast("string"), F.lit("_"), "resource_key").alias("alert_episode_key"),
        "alert_id", wall_clock(F.col("detected_us")).alias("detected_at"), "resource_key",
        F.concat("alert_id", F.lit("||"), "resource_key").alias("alert_resource_key"), "metric_value", "threshold_value", "details_json",
        (~F.col("is_continuation")).alias("is_new_episode"), "is_continuation", "episode_number", wall_clock(F.col("clock_us")).alias("evaluated_at"))
