"""The consumer loop over a stored queue: claim, land, ack or nack, log, purge."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from marquee.operators.queue import MAX_BATCH
from marquee.plans.ingest import batch_event
from marquee.sources.queue_store import QueueStore
from marquee.sources.store import Store
from marquee.streaming.ingest import Writer, land_messages, record_batch


@dataclass(frozen=True)
class Consumed:
    """What a run of the loop did with a queue."""

    batches: int
    processed: int
    nacked: int
    invalid: int
    purged: int


def _next_batch(store: Store, run: str) -> int:
    """The number after the last batch of ``run``; one that broke off keeps its own."""
    begun = store.read(f"inbox/run={run}", "id BIGINT, epoch BIGINT, round INT, part STRING")
    last = begun.agg(F.max("epoch")).head()[0]
    return 0 if last is None else last + 1


def process(
    queued: QueueStore,
    store: Store,
    name: str,
    clock: Callable[[], datetime],
    batch_size: int = MAX_BATCH,
    timeout: timedelta = timedelta(seconds=30),
    references: bool = True,
    write: Writer | None = None,
    purge_every: int = 20,
    compact_every: int = 100,
    wait: Callable[[], bool] = lambda: False,
) -> Consumed:
    """Consume queue ``name`` until it hands out nothing and ``wait`` (called then) says no.

    A batch is claimed, its messages land in their tables, and the outcome goes back to the
    queue: landed ones are acked, malformed ones fail for good, and those whose parent is
    missing or whose table could not be written are given back with the queue's backoff. If
    the loop breaks off after landing, the claim times out and the messages come again; their
    keys are in the tables by then, so they are acked without another row.

    ``clock`` says when things happen; nothing else reads the time. Every ``purge_every``
    batches done messages leave the queue, every ``compact_every`` its changes are folded.
    """
    run = f"queue-{name}"
    epoch = _next_batch(store, run)
    done = Consumed(0, 0, 0, 0, 0)
    while True:
        claimed = queued.dequeue(name, clock(), batch_size, timeout)
        if claimed.isEmpty():
            if wait():
                continue
            return done
        messages = claimed.select(
            F.col("msg_id").alias("id"), "payload", (F.col("attempt_count") - 1).alias("attempts")
        )
        place = (run, epoch, 0)
        pinned = store.pin()
        _, outcomes = land_messages(messages, pinned, place, references, write or store.write_run)
        now = clock()
        landed = outcomes.filter(F.col("outcome") == "ack")
        others = outcomes.filter(F.col("outcome") != "ack")
        queued.ack(landed.select("id"), now)
        if not others.isEmpty():
            # The queue itself knows how many attempts a message has left.
            queued.nack(others.select("id", "reason"), now)
        record_batch(pinned, place, batch_event(outcomes, F.lit(now)))
        counts = {r.outcome: r["count"] for r in outcomes.groupBy("outcome").count().collect()}
        epoch += 1
        purged = 0
        if purge_every and epoch % purge_every == 0:
            purged = queued.purge(name, clock())
        if compact_every and epoch % compact_every == 0:
            queued.compact()
        done = Consumed(
            done.batches + 1,
            done.processed + counts.get("ack", 0),
            done.nacked + counts.get("retry", 0) + counts.get("failed", 0),
            done.invalid + counts.get("permanent", 0),
            done.purged + purged,
        )
