"""Dead-letter retry as a stream: each record waits for its due time as a timer of keyed state, and runs again when that has come."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ledgerframe.operators import dlq
from ledgerframe.sinks import commit_batch
from ledgerframe.storage import cut, dropped

_HELD = "last_attempt_at long, retry_count long, due long, record string"


class Due(StatefulProcessor):
    """Holds the newest state of an open record and gives the record once, when it is due. Closed records hold nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("held", _HELD)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803 (names of the interface)
        told = [tuple(r) for frame in rows for r in frame[["last_attempt_at", "retry_count", "alive", "due", "record"]].itertuples(index=False)]
        at, tries, alive, due, record = max(told, key=lambda r: (r[0], r[1], not r[2]))
        before = self.held.get() if self.held.exists() else None
        out = []
        if before is None or (at, tries) > tuple(before[:2]):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not alive:
                self.held.clear()
            else:
                self.held.update((int(at), int(tries), int(due), record))
                if due <= timerValues.getCurrentProcessingTimeInMs():
                    out = [record]
                else:
                    self.handle.registerTimer(int(due))
        yield pd.DataFrame({"record": out}, dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        if self.held.exists():
            yield pd.DataFrame({"record": [self.held.get()[3]]}, dtype=object)

    def close(self) -> None:
        pass


def due_records(log: DataFrame) -> DataFrame:
    """A stream of (record): each open record of a dead-letter log, as JSON, once for each of its states, when its due time has come.

    A state counts if it is newer, by (last_attempt_at, retry_count), than the one held; a resolved, failed or spent one ends the
    waiting. A missing or zero due time is now. Needs the RocksDB state store.
    """
    zero = F.lit(0).cast("bigint")
    alive = dlq.should_retry(2**62)
    rows = log.select("id", F.coalesce("last_attempt_at", zero).alias("last_attempt_at"), F.coalesce("retry_count", zero).alias("retry_count"), alive.alias("alive"), F.coalesce("next_retry_at", zero).alias("due"), F.to_json(F.struct(*log.columns)).alias("record"))
    return rows.groupBy("id").transformWithStateInPandas(Due(), "record string", "Update", "ProcessingTime")


def stream_retry(
    log: DataFrame, raw_of: Callable[[DataFrame], DataFrame], run: Callable[[DataFrame], tuple], methods: list[str], base: str, states: str, checkpoint: str, base_ms: int,
    interval_ms: int = 1000, now_ms: Callable[[], int] = lambda: int(time.time() * 1000),
) -> StreamingQuery:
    """Retries a dead-letter log's records as they come due, with the states and rows that retry_job gives for the same records.

    raw_of gives the raw rows of a table of cursors as they are now, run ingests them. Entities and gap rows are committed under base,
    and the records' new states are written to states/b<batch>, a folder that `log` reads too: so a record that failed again comes
    back with its next due time. A repeated batch overwrites its states, which are then no newer than those held.
    """
    spark = log.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    kind = log.schema

    def batch(df: DataFrame, batch_id: int) -> None:
        made: list[str] = []
        records = cut(df.select(F.from_json("record", kind).alias("r")).select("r.*"), made)
        if not records.isEmpty():
            raw = raw_of(records.where("cursor IS NOT NULL").select("cursor").distinct())
            bundle, after, gaps = dlq.retry_job(records, raw, run, methods, base_ms, now_ms(), "last_attempt_at")
            commit_batch(bundle | {"gaps": gaps}, base, batch_id, writer=df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))
            after.select(*kind.names).write.mode("overwrite").parquet(f"{states}/b{batch_id:012d}")
        dropped(df.sparkSession, made)

    return due_records(log).writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(processingTime=f"{interval_ms} milliseconds").start()
