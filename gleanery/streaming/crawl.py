"""Crawl state as keyed state of a stream: one state per URL, timers for retries that fall due, and states that run out.

What is kept of a URL are partial folds that compose in any order (the first and last entry by seq, the last success, the last
failure, attempts), so the state after any division of the log into batches, late entries included, is the fold of the log. It lives in
the state store with the query's checkpoint and survives restarts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE = (
    "first long, first_kind string, last long, last_kind string, at long, attempts long, ok long, raw_file string, content_hash string, ok_status int, "
    "bad long, message string, error_type string, bad_status int"
)
UPDATE = (
    "source_id string, url string, event string, status string, attempts long, http_status int, raw_file string, content_hash string, error_type string, error_message string, "
    "updated long, version long"
)
LOG = "source_id string, url string, kind string, seq long, at long, raw_file string, content_hash string, http_status int, message string, error_type string"
NOTHING = (None,) * 5 + (0,) + (None,) * 8


def folded(state: tuple, rows: pd.DataFrame) -> tuple:
    """The state with the rows (of LOG, without the key) added."""
    first, first_kind, last, last_kind, at, attempts, ok, raw_file, content_hash, ok_status, bad, message, error_type, bad_status = state
    for kind, seq, when, file, fingerprint, code, text, error in rows.astype(object).where(rows.notna(), None).itertuples(index=False, name=None):
        if first is None or seq < first:
            first, first_kind = int(seq), kind
        if last is None or seq > last:
            last, last_kind, at = int(seq), kind, None if when is None else int(when)
        code = None if code is None else int(code)
        if kind == "attempt":
            attempts += 1
        elif kind == "success" and (ok is None or seq > ok):
            ok, raw_file, content_hash, ok_status = int(seq), file, fingerprint, code
        elif kind == "failure" and (bad is None or seq > bad):
            bad, message, error_type, bad_status = int(seq), None if text is None else text[:2000], error, code
    return first, first_kind, last, last_kind, at, attempts, ok, raw_file, content_hash, ok_status, bad, message, error_type, bad_status


def shown(key: tuple, state: tuple, event: str) -> tuple:
    """The row of UPDATE that a state stands for."""
    first, first_kind, last, last_kind, at, attempts, ok, raw_file, content_hash, ok_status, bad, message, error_type, bad_status = state
    failed = bad is not None and bad > (-1 if ok is None else ok)
    status = {"attempt": "pending", "success": "success"}.get(last_kind, "failed")
    tried = attempts + (first_kind != "attempt")
    return (*key, event, status, tried, bad_status if failed else ok_status, raw_file, content_hash, error_type if failed else None, message if failed else None, at, last)


class CrawlState(StatefulProcessor):
    """A row with event `state` for each URL of a batch; one with event `retry` when a failed URL falls due again.

    A retry falls due `wait` seconds after a failure is seen, twice that after the next, up to `retries` of them, and not if a later
    entry has come. A state that nothing was added to for `keep` days is forgotten (0: never).
    """

    def __init__(self, retries: int = 3, wait: float = 60.0, keep: float = 0.0):
        self.retries, self.wait, self.keep = retries, wait, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        days = int(self.keep * 86_400_000)
        self.state = handle.getValueState("url", STATE, ttlDurationMs=days) if days else handle.getValueState("url", STATE)

    def _rows(self, *rows: tuple) -> pd.DataFrame:
        names = [c.split()[0] for c in UPDATE.split(", ")]
        out = pd.DataFrame(list(rows), columns=names)
        return out.astype({"attempts": "Int64", "http_status": "Int32", "updated": "Int64", "version": "Int64"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = tuple(self.state.get()) if self.state.exists() else NOTHING
        for part in rows:
            state = folded(state, part[[c.split()[0] for c in LOG.split(", ")[2:]]])
        self.state.update(state)
        row = shown(key, state, "state")
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if row[3] == "failed" and row[4] <= self.retries:
            now = timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer(now + int(1000 * self.wait * 2 ** max(row[4] - 1, 0)))
        yield self._rows(row)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            yield self._rows(shown(key, tuple(self.state.get()), "retry"))

    def close(self) -> None:
        pass


def updates(log: DataFrame, retries: int = 3, wait: float = 60.0, keep: float = 0.0) -> DataFrame:
    """The stream of UPDATE rows of a log stream (source_id, url, kind, seq, updated_at, raw_file, message, and if it has them
    http_status, content_hash, error_type)."""
    lacking = {"http_status": "int", "content_hash": "string", "error_type": "string"}
    log = log.withColumns({c: F.lit(None).cast(t) for c, t in lacking.items() if c not in log.columns})
    rows = log.withColumn("at", F.unix_micros("updated_at")).select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in LOG.split(", ")))
    log.sparkSession.conf.set(STORE, ROCKS)
    return rows.groupBy("source_id", "url").transformWithStateInPandas(statefulProcessor=CrawlState(retries, wait, keep), outputStructType=UPDATE, outputMode="Update", timeMode="ProcessingTime")


def keep_state(log: DataFrame, folder: str, checkpoint: str, **options) -> StreamingQuery:
    """Starts the stream over what is there now; each batch's updates go to a folder by batch, so one that runs again replaces itself.

    Batches without data, which would never end under timers, are off: what falls due is reported with the next data. A stream
    that is to report it at its time takes `updates` under a trigger of its own.
    """
    conf = log.sparkSession.conf
    before = conf.get(NO_DATA)
    conf.set(NO_DATA, "false")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    try:
        return updates(log, **options).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(NO_DATA, before)


def kept_state(spark, folder: str) -> DataFrame:
    """The newest state of each URL, in the columns of `fold_state`."""
    rows = spark.read.schema(UPDATE + ", batch long").parquet(folder).filter("event = 'state'")
    rest = [c for c in rows.columns if c not in ("source_id", "url", "batch", "event", "version", "updated")]
    last = rows.groupBy("source_id", "url").agg(F.max_by(F.struct(*rest, F.timestamp_micros("updated").alias("updated_at")), "batch").alias("s"))
    return last.select("source_id", "url", "s.status", "s.attempts", "s.http_status", "s.raw_file", "s.content_hash", "s.error_type", "s.error_message", "s.updated_at")


def due_retries(spark, folder: str) -> DataFrame:
    """(source_id, url, attempts, batch) of the retries that fell due, each with the batch that said so."""
    return spark.read.schema(UPDATE + ", batch long").parquet(folder).filter("event = 'retry'").select("source_id", "url", "attempts", "batch")
