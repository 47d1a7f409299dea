"""C6/U24 as a stream of answers: attempts and back-off are keyed state, with timers.

The push service's answers arrive as rows (timesheetId, userId, chunk, attempt, ok, answered_at); attempt 0 is
the first push, 1, 2... are retries. Each chunk is a key of ``transformWithState``:

- a rejected answer counts as one failure and sets a timer: the chunk is due again after ``BACK_OFF``, twice that after the
  second failure, and so on; when the stream's event time passes it, a ``retry`` event asks the sender for it;
- an accepted answer ends the chunk: its timer goes and an ``accepted`` event lets its rows leave the dead letter;
- after ``MAX_FAILURES`` a ``given_up`` event says so; its rows stay in the dead letter.

Defined cases: answers may come in any order and more than once; an attempt counts once, an accepted answer ends
the chunk whenever it comes, and nothing is emitted for a chunk twice. An answer without ``ok`` is a rejection; without a
time or a key it is left out. Accepted first pushes need no state and are filtered out before.

Events go to a file sink, exactly once; state and progress are in the folder of the stream's checkpoint, so a
stopped stream goes on where it was, with its timers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

# Workers get this module with the processor, wherever the driver found it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS = ["timesheetId", "userId", "chunk"]
ANSWERS = "timesheetId bigint, userId bigint, chunk string, attempt int, ok boolean, answered_at timestamp"
#: What the processor hands out: times as milliseconds, whatever the session's time zone.
RAW_EVENTS = "timesheetId bigint, userId bigint, chunk string, kind string, attempt int, at_ms bigint"
EVENTS = "timesheetId bigint, userId bigint, chunk string, kind string, attempt int, at timestamp"
BACK_OFF_MS = 5 * 60_000
MAX_FAILURES = 5
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Retries(StatefulProcessor):
    """One chunk's attempts (a bit each), whether it has ended, and when it is due."""

    def __init__(self, back_off_ms: int, max_failures: int):
        self.back_off_ms, self.max_failures = back_off_ms, max_failures

    def init(self, handle) -> None:
        self.handle = handle
        self.chunk = handle.getValueState("chunk", "failed bigint, ended boolean, due bigint")

    def _event(self, key, kind: str, attempt: int, ms: int) -> pd.DataFrame:
        return pd.DataFrame([(*key, kind, attempt, ms)], columns=[*KEYS, "kind", "attempt", "at_ms"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        failed, ended, due = self.chunk.get() if self.chunk.exists() else (0, False, 0)
        if ended:
            return
        old, last = due, 0
        answers = pd.concat(list(rows)).sort_values(["ok", "attempt"], ascending=[False, True])
        for attempt, ok, ms in zip(answers["attempt"].tolist(), answers["ok"].tolist(), answers["ms"].tolist(), strict=True):
            if ok:
                ended, due = True, 0
                yield self._event(key, "accepted", attempt, ms)
                break
            if not failed >> attempt & 1:
                failed |= 1 << attempt
                last = max(last, ms)
        n = failed.bit_count()
        if not ended and n >= self.max_failures:
            ended, due = True, 0
            yield self._event(key, "given_up", n, last)
        elif not ended and last:
            due = max(due, last + self.back_off_ms * (1 << n - 1))
        if old and due != old:
            self.handle.deleteTimer(old)
        if due and due != old:
            self.handle.registerTimer(due)
        self.chunk.update((failed, ended, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        failed, ended, due = self.chunk.get()
        if not ended and due:
            self.chunk.update((failed, False, 0))
            yield self._event(key, "retry", failed.bit_count(), due)

    def close(self) -> None:
        pass


def retry_events(answers: DataFrame, back_off_ms: int = BACK_OFF_MS, max_failures: int = MAX_FAILURES, late: str = "1 hour") -> DataFrame:
    """The stream of events of a stream of answers; ``late``: how far behind the newest an answer may come."""
    if not 0 < max_failures <= 62:
        raise ValueError("attempts are bits of a long")
    wanted = answers.where("timesheetId IS NOT NULL AND userId IS NOT NULL AND chunk IS NOT NULL AND answered_at IS NOT NULL") \
        .where("attempt > 0 OR NOT coalesce(ok, false)").where("attempt BETWEEN 0 AND 62")
    wanted = wanted.select(*KEYS, "attempt", F.coalesce("ok", F.lit(False)).alias("ok"), "answered_at", F.unix_millis("answered_at").alias("ms"))
    out = wanted.withWatermark("answered_at", late).groupBy(*KEYS).transformWithStateInPandas(
        statefulProcessor=Retries(back_off_ms, max_failures), outputStructType=RAW_EVENTS, outputMode="Append", timeMode="EventTime")
    return out.select(*KEYS, "kind", "attempt", F.timestamp_millis("at_ms").alias("at"))


def start_retry_stream(spark: SparkSession, answers_dir: str, events_dir: str, progress_dir: str, **limits) -> StreamingQuery:
    """Read the answers that landed since the last run and write their events; returns the StreamingQuery."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    answers = spark.readStream.schema(ANSWERS).parquet(answers_dir)
    return (retry_events(answers, **limits).writeStream.format("parquet").outputMode("append").option("path", events_dir)
            .option("checkpointLocation", progress_dir).trigger(availableNow=True).start())


def clear_accepted(dead_letter: DataFrame, events: DataFrame) -> DataFrame:
    """U24 from the events: rows of chunks whose retry was accepted leave the dead letter."""
    done = events.where("kind = 'accepted' AND attempt > 0").select(*KEYS).distinct()
    keyed = dead_letter.withColumn("chunk", F.date_format("entryDate", "yyyy/MM/dd"))
    return keyed.join(done.hint("merge"), KEYS, "left_anti").select(*dead_letter.columns)
