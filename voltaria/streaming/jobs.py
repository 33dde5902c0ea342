"""Structured Streaming forms of the batch models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..materialize import Table
from ..operators.dedup import latest


def rollup(stream: DataFrame, keys: Sequence[str], ts: str, value: str, slot: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """Sums per key and slot; rows later than ``late`` behind the newest are left out, and state is dropped with them."""
    w = F.window(ts, slot)
    return stream.withWatermark(ts, late).groupBy(*keys, w).agg(F.sum(value).alias(value), F.count("*").alias("readings")).select(*keys, F.col("window.start").alias(ts), value, "readings")


def sessions(stream: DataFrame, keys: Sequence[str], ts: str, gap: str = "1 hour", late: str = "1 hour") -> DataFrame:
    w = F.session_window(ts, gap)
    return stream.withWatermark(ts, late).groupBy(*keys, w).agg(F.count("*").alias("rows")).select(*keys, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "rows")


def deduplicated(stream: DataFrame, keys: Sequence[str], ts: str, late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def merge_into(stream: DataFrame, table: Table, keys: Sequence[str], newest: str, checkpoint: str, once: bool = True, update: Sequence[str] | None = None) -> StreamingQuery:
    """Upserts every micro-batch, its newest row per key; running a batch again changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            table.merge(latest(batch, keys, newest), keys, update, check=False)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update")
    return (w.trigger(availableNow=True) if once else w).start()


def streaks(stream: DataFrame, device: str = "device_id", most: int = 10, floor: float = 0.5) -> DataFrame:
    """(device, week, level, peak): each device's streak after every week that arrives; (device, week, responded) rows in."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        level, peak = state.get if state.exists else (0, 0)
        rows = pd.concat(list(frames)).groupby("week", as_index=False)["responded"].max().sort_values("week")
        out = []
        for week, responded in zip(rows["week"], rows["responded"], strict=True):
            level = min(level + 1, most) if responded else min(level, max(level - 1, round(peak * floor), 0))
            peak = max(peak, level)
            out.append((key[0], week, level, peak))
        state.update((level, peak))
        yield pd.DataFrame(out, columns=[device, "week", "level", "peak"])

    return stream.groupBy(device).applyInPandasWithState(step, f"{device} string, week date, level int, peak int", "level int, peak int", "append", GroupStateTimeout.NoTimeout)


#: A week, and the Monday of the first week after the epoch, in milliseconds.
WEEK, MONDAY = 7 * 86_400_000, 4 * 86_400_000
#: The state store that timers need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _WeeklyStreak(StatefulProcessor):
    """Weeks are settled by timers, when the watermark has passed their end: in order, however late their rows came, and without
    rows as weeks without a response. A device whose level can't fall further has no timer until it is heard of again."""

    def __init__(self, device: str, most: int, floor: float) -> None:
        self.device, self.most, self.floor = device, most, floor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.streak = handle.getValueState("streak", "level int, peak int, next long")
        self.heard = handle.getMapState("heard", "week long", "responded boolean")

    def _timed(self) -> bool:
        return any(True for _ in self.handle.listTimers())

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        level, peak, due = self.streak.get() if self.streak.exists() else (0, 0, None)
        first = None
        for frame in rows:
            for ts, responded in zip(frame["ts"], frame["responded"], strict=True):
                ms = int(pd.Timestamp(ts).timestamp() * 1000)
                week = (ms - MONDAY) // WEEK * WEEK + MONDAY
                if due is not None and week < due:
                    continue  # settled before
                before = self.heard.getValue((week,))[0] if self.heard.containsKey((week,)) else False
                self.heard.updateValue((week,), (bool(before or responded),))
                first = week if first is None else min(first, week)
        if first is not None and not self._timed():
            due = first  # new, or at rest since: weeks in between change nothing
            self.handle.registerTimer(due + WEEK)
        elif first is not None and due is not None and first < due:
            due = first
        if due is not None:
            self.streak.update((level, peak, due))
        return iter([])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        level, peak, week = self.streak.get()
        out, moving = [], True
        while moving and week + WEEK <= timerValues.getCurrentWatermarkInMs():  # all weeks that are over, as timers set here wait for the next batch
            responded = False
            if self.heard.containsKey((week,)):
                responded = self.heard.getValue((week,))[0]
                self.heard.removeKey((week,))
            new = min(level + 1, self.most) if responded else min(level, max(level - 1, round(peak * self.floor), 0))
            moving = new != level or responded or any(True for _ in self.heard.keys())
            level, peak = new, max(peak, new)
            out.append((key[0], pd.Timestamp(week, unit="ms").date(), level, peak))
            week += WEEK
        self.streak.update((level, peak, week))
        if moving:
            self.handle.registerTimer(week + WEEK)
        if out:
            yield pd.DataFrame(out, columns=[self.device, "week", "level", "peak"])

    def close(self) -> None:
        pass


def timed_streaks(stream: DataFrame, device: str = "device_id", late: str = "1 day", most: int = 10, floor: float = 0.5) -> DataFrame:
    """(device, week, level, peak), a row per device and week once the week is ``late`` past; (device, ts, responded) rows in. A
    device that falls silent decays week by week. Needs ``spark.sql.streaming.stateStore.providerClass`` = ``STATE_STORE``."""
    rows = stream.select(device, "ts", "responded").withWatermark("ts", late)
    return rows.groupBy(device).transformWithStateInPandas(_WeeklyStreak(device, most, floor), f"{device} string, week date, level int, peak int", "append", "eventTime")
