"""Message-queue state as DataFrame transitions.

A queue is a snapshot of message rows. Every transition takes the snapshot and ``as_of``
(the moment it happens; nothing reads the clock) and returns the next snapshot or a result.
With ``changed_only`` a transition returns just the rows it touched, to be merged into a table
that can update in place instead of being written anew; ``merge`` does it on frames.
Where a transition touches chosen messages, the chosen ids are joined to the snapshot: a
claim holds at most 10 000 of them, so that side is broadcast and the snapshot is read in one
pass without a shuffle; acks and nacks are broadcast only after a count.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.json import is_document
from marquee.operators.relational import is_small, lowest_n, top_n_per_group

# Fixed values of the queue protocol.
MAX_BATCH = 10_000
MAX_PURGE = 100_000
DEFAULT_ATTEMPTS = 5
MAX_BACKOFF_SECONDS = 300
MAX_ERROR_CHARS = 4000
PERMANENT = "[permanent]"
EXPIRED = "visibility timeout expired after maximum attempts"
RECLAIMED = "visibility timeout expired; message reclaimed"


def _moment(as_of: datetime | str | Column, queue: DataFrame) -> Column:
    column = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return column.cast(queue.schema["available_at"].dataType)


def _named(name: str | None) -> str:
    if name is None or not name.strip(" "):
        raise ValueError("queue name must not be null or empty")
    return name


def _batch(n: int | None) -> int:
    if n is None or not 1 <= n <= MAX_BATCH:
        raise ValueError(f"batch size must be between 1 and {MAX_BATCH}")
    return n


def _timeout(timeout: timedelta | None) -> Column:
    if timeout is None or timeout <= timedelta(0):
        raise ValueError("visibility timeout must be greater than zero")
    return F.lit(timeout)


def _null(queue: DataFrame, column: str) -> Column:
    return F.lit(None).cast(queue.schema[column].dataType)


def enqueue(
    messages: DataFrame, as_of: datetime | str | Column, like: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(pending rows, refused rows) for messages (id, queue_name, payload).

    Ids come from the source, for instance file number and line, so producers need no
    shared counter. ``like`` gives the snapshot layout. A blank queue name or a missing
    payload refuses the message; so does a payload that is not JSON.
    """
    now = _moment(as_of, like)
    reason = (
        F.when(
            F.col("queue_name").isNull() | (F.trim("queue_name") == ""),
            F.lit("queue name must not be null or empty"),
        )
        .when(F.col("payload").isNull(), F.lit("payload must not be null"))
        .when(~F.coalesce(F.expr(is_document("payload")), F.lit(False)), F.lit("payload must be JSON"))
    )
    checked = messages.withColumn("reason", reason)
    fresh = {
        "status": F.lit("pending"),
        "attempt_count": F.lit(0),
        "max_attempts": F.lit(DEFAULT_ATTEMPTS),
        "available_at": now,
        "created_at": now,
        "updated_at": now,
    }
    rows = checked.filter(F.col("reason").isNull()).select(
        *(
            fresh[c].alias(c) if c in fresh
            else F.col(c) if c in messages.columns
            else _null(like, c).alias(c)
            for c in like.columns
        )
    )
    return rows, checked.filter(F.col("reason").isNotNull())


def _set(
    queue: DataFrame, when: Column, changes: dict[str, Column], changed_only: bool
) -> DataFrame:
    """``queue`` with ``changes`` applied to the rows where ``when`` is true."""
    hit = F.coalesce(when, F.lit(False))
    if changed_only:
        queue, hit = queue.filter(hit), F.lit(True)
    return queue.select(
        *(
            F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in queue.columns
        )
    )


def expire_exhausted(
    queue: DataFrame,
    name: str,
    timeout: timedelta,
    as_of: datetime | str | Column,
    changed_only: bool = False,
) -> DataFrame:
    """Fail timed-out messages of queue ``name`` that have no attempts left."""
    now = _moment(as_of, queue)
    exhausted = (
        (F.col("queue_name") == _named(name))
        & (F.col("status") == "processing")
        & (F.col("processing_started_at") <= now - _timeout(timeout))
        & (F.col("attempt_count") >= F.col("max_attempts"))
    )
    return _set(
        queue,
        exhausted,
        {
            "status": F.lit("failed"),
            "failed_at": now,
            "processing_started_at": _null(queue, "processing_started_at"),
            "last_error": F.coalesce(F.nullif("last_error", F.lit("")), F.lit(EXPIRED)),
            "updated_at": now,
        },
        changed_only,
    )


def _claimable(timeout: timedelta, now: Column) -> Column:
    ready = (F.col("status") == "pending") & (F.col("available_at") <= now)
    expired = (F.col("status") == "processing") & (
        F.col("processing_started_at") <= now - _timeout(timeout)
    )
    return (F.col("attempt_count") < F.col("max_attempts")) & (ready | expired)


def claim_ids(
    queue: DataFrame,
    name: str,
    as_of: datetime | str | Column,
    n: int = 10,
    timeout: timedelta = timedelta(seconds=30),
) -> DataFrame:
    """Ids of the ``n`` lowest claimable messages of one queue."""
    ready = queue.filter((F.col("queue_name") == _named(name)))
    ready = ready.filter(_claimable(timeout, _moment(as_of, queue))).select("id")
    return lowest_n(ready, "id", _batch(n))


def claim(
    queue: DataFrame,
    name: str,
    as_of: datetime | str | Column,
    n: int = 10,
    timeout: timedelta = timedelta(seconds=30),
) -> DataFrame:
    """(msg_id, payload) of the messages a dequeue hands out.

    Only ids go through the top-n; payloads are fetched for the ids that won, at most MAX_BATCH.
    """
    ids = claim_ids(queue, name, as_of, n, timeout)
    return queue.join(F.broadcast(ids), "id", "left_semi").select(
        F.col("id").alias("msg_id"), "payload"
    )


def claim_all_ids(
    queue: DataFrame,
    as_of: datetime | str | Column,
    n: int = 10,
    timeout: timedelta = timedelta(seconds=30),
) -> DataFrame:
    """(queue_name, id, position) of the ``n`` lowest claimable messages of every queue."""
    ready = queue.filter(_claimable(timeout, _moment(as_of, queue))).select("queue_name", "id")
    return top_n_per_group(
        ready, ["queue_name"], [F.asc("id")], _batch(n), rank="position", salt_by=["id"]
    )


def apply_claim(
    queue: DataFrame,
    ids: DataFrame,
    as_of: datetime | str | Column,
    changed_only: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """The snapshot after the claimed ``ids`` went to processing.

    ``rows`` is the caller's bound on their number; only a small one is hinted for broadcast.
    """
    now = _moment(as_of, queue)
    claimed = ids.select("id", F.lit(True).alias("_claimed"))
    if rows is not None and is_small(rows):
        claimed = F.broadcast(claimed)
    marked = queue.join(claimed, "id", "left")
    reclaimed = F.coalesce(F.nullif("last_error", F.lit("")), F.lit(RECLAIMED))
    out = _set(
        marked,
        F.col("_claimed"),
        {
            "status": F.lit("processing"),
            "attempt_count": F.col("attempt_count") + 1,
            "processing_started_at": now,
            "completed_at": _null(queue, "completed_at"),
            "failed_at": _null(queue, "failed_at"),
            "last_error": F.when(F.col("status") == "processing", reclaimed).otherwise(
                F.col("last_error")
            ),
            "updated_at": now,
        },
        changed_only,
    )
    return out.select(*queue.columns)


def dequeue(
    queue: DataFrame,
    name: str,
    as_of: datetime | str | Column,
    n: int = 10,
    timeout: timedelta = timedelta(seconds=30),
    changed_only: bool = False,
) -> DataFrame:
    """The snapshot after a dequeue: exhausted messages failed, claimed ones processing.

    The two sets are disjoint (attempts left or not), so the ids come from the snapshot as
    given.
    """
    ids = claim_ids(queue, name, as_of, n, timeout)
    if changed_only:
        expired = expire_exhausted(queue, name, timeout, as_of, changed_only=True)
        return expired.unionByName(apply_claim(queue, ids, as_of, True, n))
    return apply_claim(expire_exhausted(queue, name, timeout, as_of), ids, as_of, rows=n)


def _small_ids(ids: DataFrame, text: Column | None = None) -> bool:
    """Whether ids (and their text) are few enough to broadcast, from one pass over them.

    A null id raises.
    """
    width = F.sum(F.octet_length(text)) if text is not None else F.lit(0)
    rows, nulls, size = ids.agg(
        F.count("*"), F.count_if(F.col("id").isNull()), F.coalesce(width, F.lit(0))
    ).head()
    if nulls:
        raise ValueError("message id must not be null")
    return is_small(rows, size)


def ack(
    queue: DataFrame, ids: DataFrame, as_of: datetime | str | Column, changed_only: bool = False
) -> DataFrame:
    """Mark messages done. Only processing or done ones change; unknown ids do nothing."""
    now = _moment(as_of, queue)
    small = _small_ids(ids)
    acked = ids.select("id").distinct().withColumn("_acked", F.lit(True))
    out = _set(
        queue.join(F.broadcast(acked) if small else acked, "id", "left"),
        F.col("_acked") & F.col("status").isin("processing", "done"),
        {
            "status": F.lit("done"),
            "completed_at": F.coalesce("completed_at", now),
            "processing_started_at": _null(queue, "processing_started_at"),
            "failed_at": _null(queue, "failed_at"),
            "updated_at": now,
        },
        changed_only,
    )
    return out.select(*queue.columns)


def backoff(attempts: Column) -> Column:
    """Retry delay: 1, 2, 4 ... seconds by attempt, at most 300."""
    exponent = F.least(F.greatest(attempts - 1, F.lit(0)), F.lit(30))
    seconds = F.least(F.lit(MAX_BACKOFF_SECONDS), F.pow(F.lit(2), exponent).cast("int"))
    return F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def nack(
    queue: DataFrame, reasons: DataFrame, as_of: datetime | str | Column, changed_only: bool = False
) -> DataFrame:
    """Give messages back, or fail them for good.

    ``reasons`` holds (id, reason). A permanent reason or no attempts left fails the
    message; otherwise it is pending again after ``backoff``. Done and failed messages stay,
    except that a failed one without ``failed_at`` gets it. Several reasons for one id count
    as one nack: a permanent one wins, then the smallest text.
    """
    now = _moment(as_of, queue)
    text = F.left(F.coalesce("reason", F.lit("")), F.lit(MAX_ERROR_CHARS))
    small = _small_ids(reasons, text)
    given = reasons.select("id", text.alias("_reason"))
    rank = F.struct(~F.col("_reason").startswith(PERMANENT), F.col("_reason"))
    given = given.groupBy("id").agg(F.min(rank).getField("_reason").alias("_reason"))
    nacked = F.col("_reason").isNotNull()
    open_ = ~F.col("status").isin("done", "failed")
    final = F.col("_reason").startswith(PERMANENT) | (
        F.col("attempt_count") >= F.col("max_attempts")
    )
    failed_at = F.when(
        F.col("status") == "failed", F.coalesce("failed_at", now)
    ).when(F.col("status") == "done", F.col("failed_at")).when(final, now)
    marked = queue.join(F.broadcast(given) if small else given, "id", "left")
    out = _set(
        marked,
        nacked,
        {
            "status": F.when(~open_, F.col("status"))
            .when(final, F.lit("failed"))
            .otherwise(F.lit("pending")),
            "available_at": F.when(~open_ | final, F.col("available_at")).otherwise(
                now + backoff(F.col("attempt_count"))
            ),
            "processing_started_at": F.when(~open_, F.col("processing_started_at")),
            "failed_at": failed_at,
            "last_error": F.when(~open_, F.col("last_error")).otherwise(F.col("_reason")),
            "updated_at": F.when(~open_, F.col("updated_at")).otherwise(now),
        },
        changed_only,
    )
    return out.select(*queue.columns)


def merge(queue: DataFrame, changed: DataFrame) -> DataFrame:
    """``queue`` with the rows of ``changed`` in place of those of the same id."""
    return queue.join(changed.select("id"), "id", "left_anti").select(*queue.columns).unionByName(changed)


def metrics(queue: DataFrame, name: str | None = None) -> DataFrame:
    """Message counts by status and the oldest pending message, per queue."""
    rows = queue if name is None else queue.filter(F.col("queue_name") == name)
    counts = [
        F.count_if(F.col("status") == status).alias(status)
        for status in ("pending", "processing", "done", "failed")
    ]
    oldest = F.min(F.when(F.col("status") == "pending", F.col("created_at")))
    return (
        rows.groupBy("queue_name")
        .agg(*counts, F.count("*").alias("total"), oldest.alias("oldest_pending_at"))
        .orderBy("queue_name")
    )


def inflight(queue: DataFrame, name: str) -> DataFrame:
    """One row: how many messages of the queue are pending or being processed."""
    open_ = queue.filter(
        (F.col("queue_name") == name) & F.col("status").isin("pending", "processing")
    )
    return open_.agg(F.count("*").alias("inflight"))


def depth_series(queue: DataFrame, every: str = "1 hour") -> DataFrame:
    """(queue_name, step_end, depth): messages in flight at the end of each time step.

    Arrivals and departures fold into steps first, so the running sum reads one row per
    queue and step, not one per message.
    """
    left = F.coalesce("completed_at", "failed_at", "updated_at")
    gone = F.col("status").isin("done", "failed")
    moves = F.array(
        F.struct(F.col("created_at").alias("at"), F.lit(1).alias("delta")),
        F.struct(F.when(gone, left).alias("at"), F.lit(-1).alias("delta")),
    )
    steps = (
        queue.select("queue_name", F.explode(moves).alias("m"))
        .filter(F.col("m.at").isNotNull())
        .groupBy("queue_name", F.window("m.at", every).getField("end").alias("step_end"))
        .agg(F.sum("m.delta").alias("delta"))
    )
    running = Window.partitionBy("queue_name").orderBy("step_end")
    return steps.select("queue_name", "step_end", F.sum("delta").over(running).alias("depth"))


def backpressure(depths: DataFrame, high: int, low: int) -> DataFrame:
    """``depths`` plus ``paused``: set once depth reaches ``high``, cleared at ``low``."""
    if not 0 <= low < high:
        raise ValueError("low water must be non-negative and below high water")
    signal = F.when(F.col("depth") >= high, True).when(F.col("depth") <= low, False)
    so_far = Window.partitionBy("queue_name").orderBy("step_end")
    held = F.last(signal, ignorenulls=True).over(so_far)
    return depths.withColumn("paused", F.coalesce(held, F.lit(False)))


def purge_victims(
    queue: DataFrame,
    name: str,
    as_of: datetime | str | Column,
    older_than: timedelta = timedelta(minutes=2),
    limit: int = 5000,
) -> DataFrame:
    """Ids of the oldest done messages a purge removes."""
    _named(name)
    if older_than is None or older_than < timedelta(0):
        raise ValueError("older-than interval must be non-negative")
    if limit is None or not 1 <= limit <= MAX_PURGE:
        raise ValueError(f"purge limit must be between 1 and {MAX_PURGE}")
    done = queue.filter(
        (F.col("queue_name") == name)
        & (F.col("status") == "done")
        & (F.col("completed_at") <= _moment(as_of, queue) - F.lit(older_than))
    )
    return lowest_n(done.select("id"), "id", limit)


def purge(
    queue: DataFrame,
    name: str,
    as_of: datetime | str | Column,
    older_than: timedelta = timedelta(minutes=2),
    limit: int = 5000,
) -> DataFrame:
    """The snapshot without the purged messages; at most 100 000 ids are broadcast."""
    victims = purge_victims(queue, name, as_of, older_than, limit)
    return queue.join(F.broadcast(victims), "id", "left_anti")
