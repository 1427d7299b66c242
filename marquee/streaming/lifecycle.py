"""The message life cycle as a stateful stream, one small state per message.

Operations (claim, ack, nack, tick) of a message apply in time order within each batch; a
timer fails a message whose last attempt ran out. No operation is dropped: one that arrives
late, however far behind the watermark, applies when it arrives. Messages are independent, so the work
spreads over them, and the files admitted per trigger bound what one batch brings for any
single message.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any, NamedTuple

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from marquee.operators.queue import (
    DEFAULT_ATTEMPTS,
    EXPIRED,
    MAX_BACKOFF_SECONDS,
    MAX_ERROR_CHARS,
    PERMANENT,
    RECLAIMED,
)
from marquee.session import ROCKSDB_PROVIDER

_SECOND = 1_000_000  # times are microseconds

STATE = """status STRING, attempts INT, available_at BIGINT, started_at BIGINT,
    completed_at BIGINT, failed_at BIGINT, last_error STRING"""
# ``step`` counts a message's transitions in the order in which they applied.
KEPT = f"{STATE}, step BIGINT"
TRANSITIONS = f"id BIGINT, seq BIGINT, at BIGINT, op STRING, {KEPT}"


class Message(NamedTuple):
    status: str
    attempts: int
    available_at: int
    started_at: int | None
    completed_at: int | None
    failed_at: int | None
    last_error: str | None


def enqueued(at: int) -> Message:
    return Message("pending", 0, at, None, None, None, None)


def deadline(m: Message, timeout: int) -> int | None:
    """When a message on its last attempt fails unless it is acked or nacked before."""
    if m.status == "processing" and m.attempts >= DEFAULT_ATTEMPTS:
        return m.started_at + timeout
    return None


def settle(m: Message, at: int, timeout: int) -> Message:
    due = deadline(m, timeout)
    if due is None or due > at:
        return m
    return m._replace(
        status="failed", failed_at=due, started_at=None, last_error=m.last_error or EXPIRED
    )


def advance(m: Message, op: str, at: int, reason: str | None, timeout: int) -> Message:
    """The message after one operation; operations that do not apply change nothing."""
    m = settle(m, at, timeout)
    if op == "claim":
        expired = m.status == "processing" and m.started_at + timeout <= at
        ready = m.status == "pending" and m.available_at <= at
        if m.attempts < DEFAULT_ATTEMPTS and (ready or expired):
            error = (m.last_error or RECLAIMED) if expired else m.last_error
            return Message("processing", m.attempts + 1, m.available_at, at, None, None, error)
    elif op == "ack" and m.status in ("processing", "done"):
        done = at if m.completed_at is None else m.completed_at
        return m._replace(status="done", completed_at=done, started_at=None, failed_at=None)
    elif op == "nack" and m.status in ("pending", "processing"):
        error = (reason or "")[:MAX_ERROR_CHARS]
        if error.startswith(PERMANENT) or m.attempts >= DEFAULT_ATTEMPTS:
            return m._replace(status="failed", failed_at=at, started_at=None, last_error=error)
        delay = min(MAX_BACKOFF_SECONDS, 2 ** min(max(m.attempts - 1, 0), 30)) * _SECOND
        return m._replace(
            status="pending", available_at=at + delay, started_at=None, failed_at=None, last_error=error
        )
    return m


def _timer(due: int) -> int:
    """Timers count milliseconds: the first one at or after ``due``."""
    return -(-due // 1000)


class LifecycleProcessor(StatefulProcessor):
    def __init__(self, timeout: int):
        self.timeout = timeout

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.message = handle.getValueState("message", KEPT)

    def stored(self) -> tuple[Message | None, int]:
        if not self.message.exists():
            return None, 0
        *message, step = self.message.get()
        return Message(*message), step

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        old, step = self.stored()
        now = old
        for row in sorted(rows, key=lambda r: (r.at_us, r.seq)):
            last = now
            now = advance(now or enqueued(row.at_us), row.op, row.at_us, row.reason, self.timeout)
            if now != last:  # a message's first operation always shows
                step += 1
                yield Row(
                    id=key[0], seq=row.seq, at=row.at_us, op=row.op, **now._asdict(), step=step
                )
        self.message.update((*now, step))
        before, after = (deadline(m, self.timeout) if m else None for m in (old, now))
        if before != after:
            if before is not None:
                self.handle.deleteTimer(_timer(before))
            if after is not None:
                self.handle.registerTimer(_timer(after))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        old, step = self.stored()
        now = settle(old, timerValues.getCurrentWatermarkInMs() * 1000, self.timeout)
        if now != old:
            self.message.update((*now, step + 1))
            yield Row(
                id=key[0], seq=None, at=now.failed_at, op="expire", **now._asdict(), step=step + 1
            )

    def close(self) -> None:
        pass


def lifecycle(ops: DataFrame, timeout_seconds: int = 30, lateness: str = "10 minutes") -> DataFrame:
    """Stream of state changes for a stream of operations (id, seq, op_at, op, reason).

    ``id`` is unique over all queues. ``lateness`` is how long timers wait for late operations;
    it refuses none: the watermarked column ends before the grouping, so nothing is filtered
    by it.
    """
    # Workers need not have this package installed.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    ops.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    timed = ops.select(
        "id", "seq", F.col("op_at").cast("timestamp").alias("op_at"), "op", "reason"
    ).withColumn("at_us", F.unix_micros("op_at"))
    return (
        timed.withWatermark("op_at", lateness)
        .drop("op_at")
        .groupBy("id")
        .transformWithState(
            LifecycleProcessor(timeout_seconds * _SECOND), TRANSITIONS, "Append", "EventTime"
        )
    )


def current_state(transitions: DataFrame, as_of: Column, timeout_seconds: int = 30) -> DataFrame:
    """Each message's state at ``as_of`` from its transitions.

    A deadline that passed before ``as_of`` counts whether or not its timer ran already.
    """
    rest = [c for c in transitions.columns if c != "id"]
    last = F.max_by(F.struct(*rest), "step")
    state = transitions.groupBy("id").agg(last.alias("s")).select("id", "s.*")
    due = F.col("started_at") + timeout_seconds * _SECOND
    over = (
        (F.col("status") == "processing")
        & (F.col("attempts") >= DEFAULT_ATTEMPTS)
        & (due <= F.unix_micros(as_of.cast("timestamp")))
    )
    error = F.coalesce(F.nullif("last_error", F.lit("")), F.lit(EXPIRED))
    settled = state.withColumn("_over", F.coalesce(over, F.lit(False)))
    return settled.select(
        "id",
        F.when(F.col("_over"), F.lit("failed")).otherwise(F.col("status")).alias("status"),
        "attempts",
        F.timestamp_micros("available_at").alias("available_at"),
        F.timestamp_micros(F.when(~F.col("_over"), F.col("started_at"))).alias("started_at"),
        F.timestamp_micros("completed_at").alias("completed_at"),
        F.timestamp_micros(F.when(F.col("_over"), due).otherwise(F.col("failed_at"))).alias("failed_at"),
        F.when(F.col("_over"), error).otherwise(F.col("last_error")).alias("last_error"),
    )
