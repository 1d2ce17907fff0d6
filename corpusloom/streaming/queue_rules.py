"""The work queue as a stream with rules: only legal transitions, and stale items put back by a timer.

Events of an item are held until the watermark has passed them and then applied in the order of their time and number, so
the state does not hang on the order in which they come, as long as none is later than the watermark's delay.  An item is
in progress only if it was pending; an event that would put another one in progress is refused and counted.  An item that
stays in progress for ``stale`` goes back to pending at that time, whether or not another event follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: From which states a status can be reached; any other one from all.
FROM = {"in_progress": ("pending",)}
STATE = "status string, since long, applied long, refused long, stale long"
OUT = f"id long, {STATE}, version long"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def advance(state: tuple, at: int, status: str | None, stale_ms: int) -> tuple:
    """The state (``status, since, applied, refused, stale``) after an event at a time, or at a time without one."""
    now, since, applied, refused, stale = state
    if now == "in_progress" and at - since >= stale_ms:
        now, since, stale = "pending", since + stale_ms, stale + 1
    if status is None:
        return now, since, applied, refused, stale
    if now in FROM.get(status, (now,)):
        return status, at, applied + 1, refused, stale
    return now, since, applied, refused + 1, stale


class Rules(StatefulProcessor):
    def __init__(self, stale_ms: int) -> None:
        self.stale_ms = stale_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)
        self.held = handle.getListState("held", "at long, event_id long, status string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  (Spark's names)
        for pdf in rows:
            self.held.appendList([(int(a), int(e), s) for a, e, s in zip(pdf["at"], pdf["event_id"], pdf["status"], strict=True)])
            first = int(pdf["at"].min())
            self.handle.registerTimer(max(first, timerValues.getCurrentWatermarkInMs() + 1))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        upto = timerValues.getCurrentWatermarkInMs()
        held = sorted(self.held.get())
        before = self.state.get() if self.state.exists() else None
        now = tuple(before) if before else ("pending", 0, 0, 0, 0)
        due = [e for e in held if e[0] <= upto]
        for at, _, status in due:
            now = advance(now, at, status, self.stale_ms)
        now = advance(now, upto, None, self.stale_ms)
        if due:
            rest = [tuple(e) for e in held[len(due) :]]
            self.held.put(rest) if rest else self.held.clear()
        else:
            rest = [tuple(e) for e in held]
        self.state.update(now)
        # The next time at which anything can happen.
        then = [rest[0][0]] if rest else []
        if now[0] == "in_progress":
            then.append(now[1] + self.stale_ms)
        if then:
            self.handle.registerTimer(max(min(then), upto + 1))
        if now != (tuple(before) if before else None):
            yield pd.DataFrame([(key[0], *now, sum(now[2:]))], columns=["id", "status", "since", "applied", "refused", "stale", "version"])
        else:
            yield pd.DataFrame()

    def close(self) -> None:
        pass


def follow(events: DataFrame, delay: str, stale_ms: int) -> DataFrame:
    """``events``: a stream of ``id, event_id, ts, status``; a row for each change of an item, ``version`` rises with each.

    ``since``: when the status began, in milliseconds; ``applied``, ``refused``: events so far; ``stale``: times that the item
    was put back.  The session must keep state in RocksDB (:func:`run_to_end` sees to that).
    """
    timed = events.withWatermark("ts", delay).withColumn("at", F.unix_millis("ts")).select("id", "event_id", "ts", "at", "status")
    return timed.groupBy("id").transformWithStateInPandas(Rules(stale_ms), outputStructType=OUT, outputMode="Update", timeMode="EventTime")


def run_to_end(spark: SparkSession, events: DataFrame, table: str, checkpoint: str, delay: str, stale_ms: int) -> DataFrame:
    """Drive the stream over what is there and return the last state of every item, as of the last watermark."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, PROVIDER)
    try:
        query = follow(events, delay, stale_ms).writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("append").parquet(table)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before)
    query.awaitTermination()
    rows = spark.read.schema(OUT).parquet(table)
    return rows.groupBy("id").agg(F.max_by(F.struct("status", "since", "applied", "refused", "stale"), "version").alias("s")).select("id", "s.*")
