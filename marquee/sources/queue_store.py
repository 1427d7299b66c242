"""A message queue kept as a table: numbered changes over a base, and counts beside them.

``operators.queue`` says what a transition does to a snapshot; here the snapshot is stored. A
transition reads the current rows, works out the rows it changes, and writes only those as the
next numbered change. Readers take the base without the ids that changed, and the latest change
of each of these. Each change is published by its counts, written last and read first: the
messages of each queue and status, carried forward by signed differences. So a transition that
breaks off before leaves files which the next one replaces, and metrics never scan the messages.

``compact`` folds the changes into a base of the next generation. There is one writer per queue
table; readers may come at any time.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators import queue
from marquee.operators.relational import is_small, small_side
from marquee.schemas import MESSAGE_QUEUE, STATUSES
from marquee.sources.buckets import ROWS_PER_FILE
from marquee.sources.store import Store

#: A changed message: its status before (NULL for a new one), and whether it was removed.
CHANGE = f"{MESSAGE_QUEUE}, was STRING, gone BOOLEAN"
#: Messages by queue, status and, while they are pending, the hour they were created in. The row
#: without a status counts the changed rows since the base.
COUNTS = "queue_name STRING, status STRING, hour TIMESTAMP, n BIGINT"
GENERATION = "number INT"


@dataclass(frozen=True)
class _State:
    generation: int
    version: int  # changes up to here are published
    counts: DataFrame


@dataclass(frozen=True)
class QueueStore:
    store: Store
    name: str = "queue"

    # --- reading

    def _at(self, generation: int, part: str) -> str:
        return f"{self.name}/gen={generation}/{part}"

    def _state(self) -> _State:
        generation = self.store.snapshot(f"{self.name}/generations", GENERATION)[1]
        counts, version = self.store.snapshot(self._at(generation, "counts"), COUNTS)
        return _State(generation, version, counts)

    def _changes(self, state: _State) -> DataFrame:
        rows = self.store.read(self._at(state.generation, "changes"), f"{CHANGE}, version INT")
        return rows.filter(F.col("version") <= state.version)

    def _rows(self, state: _State) -> DataFrame:
        """The messages as of ``state``."""
        base = self.store.read(self._at(state.generation, "base"), MESSAGE_QUEUE)
        changed = state.counts.filter("status IS NULL").agg(F.sum("n")).head()[0] or 0
        if not changed:
            return base
        changes = self._changes(state)
        # A transition changes a message once, so (id, version) is one row.
        latest = changes.groupBy("id").agg(F.max("version").alias("version"))
        if is_small(changed):
            latest = F.broadcast(latest)
        current = changes.join(latest, ["id", "version"], "left_semi").filter(~F.col("gone"))
        return base.join(latest, "id", "left_anti").unionByName(current.select(*base.columns))

    def rows(self) -> DataFrame:
        """The queue's messages as of the last published transition."""
        return self._rows(self._state())

    def metrics(self, name: str | None = None) -> DataFrame:
        """``operators.queue.metrics`` from the kept counts.

        Of the messages only those pending from the oldest such hour of their queue are read.
        """
        state = self._state()
        counts = state.counts.filter(F.col("status").isNotNull())
        if name is not None:
            counts = counts.filter(F.col("queue_name") == name)
        by_status = [
            F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n"))), F.lit(0)).alias(s)
            for s in STATUSES
        ]
        totals = counts.groupBy("queue_name").agg(*by_status, F.sum("n").alias("total"))
        hours = counts.filter(F.col("status") == "pending").groupBy("queue_name")
        hours = hours.agg(F.min("hour").alias("hour"))
        first, last = hours.agg(F.min("hour"), F.max("hour")).head()
        pending = self._rows(state).filter(
            (F.col("status") == "pending")
            & (F.col("created_at") >= F.lit(first).cast("timestamp"))
            & (F.col("created_at") < F.lit(last).cast("timestamp") + F.expr("INTERVAL 1 HOUR"))
        )
        pending = pending.select("queue_name", "created_at", _hour().alias("hour"))
        oldest = (
            pending.join(small_side(hours), ["queue_name", "hour"], "left_semi")
            .groupBy("queue_name")
            .agg(F.min("created_at").alias("oldest_pending_at"))
        )
        return totals.join(oldest, "queue_name", "left").orderBy("queue_name")

    def inflight(self, name: str) -> int:
        """How many messages of the queue are pending or being processed, from the counts."""
        counts = self._state().counts.filter(F.col("queue_name") == name)
        open_ = counts.filter(F.col("status").isin("pending", "processing"))
        return open_.agg(F.sum("n")).head()[0] or 0

    # --- transitions

    def _commit(self, state: _State, changed: DataFrame) -> DataFrame:
        """Write and publish changed rows (CHANGE); returns them as written."""
        version = state.version + 1
        self.store.write_run(changed, self._at(state.generation, "changes"), f"version={version}")
        path = f"{self.store.path(self._at(state.generation, 'changes'))}/version={version}"
        written = self.store.spark.read.schema(CHANGE).parquet(path)
        counts = _counted(state.counts.unionByName(_moves(written)))
        self.store.write_snapshot(
            counts.coalesce(1), self._at(state.generation, "counts"), version
        )
        return written

    def load(self, messages: DataFrame) -> None:
        """Take over a snapshot of another queue as the base; whatever is here is replaced."""
        self._write_base(self._state().generation + 1, messages)

    def enqueue(self, messages: DataFrame, as_of: datetime | str | Column) -> DataFrame:
        """Queue messages (id, queue_name, payload); returns those refused, with the reason."""
        like = self.store.spark.createDataFrame([], MESSAGE_QUEUE)
        fresh, refused = queue.enqueue(messages, as_of, like)
        fresh = fresh.withColumns(
            {"was": F.lit(None).cast("string"), "gone": F.lit(False)}
        )
        self._commit(self._state(), fresh)
        return refused

    def _remembered(self, state: _State) -> DataFrame:
        """The messages with their status kept as ``was``; transitions pass it through."""
        return self._rows(state).withColumns({"was": F.col("status"), "gone": F.lit(False)})

    def dequeue(
        self,
        name: str,
        as_of: datetime | str | Column,
        n: int = 10,
        timeout: timedelta = timedelta(seconds=30),
    ) -> DataFrame:
        """Claim up to ``n`` messages: (msg_id, payload, attempt_count), read from what was written."""
        state = self._state()
        changed = queue.dequeue(self._remembered(state), name, as_of, n, timeout, changed_only=True)
        claimed = self._commit(state, changed).filter(F.col("status") == "processing")
        return claimed.select(F.col("id").alias("msg_id"), "payload", "attempt_count")

    def ack(self, ids: DataFrame, as_of: datetime | str | Column) -> None:
        """Mark messages (id) done."""
        state = self._state()
        self._commit(state, queue.ack(self._remembered(state), ids, as_of, changed_only=True))

    def nack(self, reasons: DataFrame, as_of: datetime | str | Column) -> None:
        """Give messages (id, reason) back, or fail them for good."""
        state = self._state()
        self._commit(state, queue.nack(self._remembered(state), reasons, as_of, changed_only=True))

    def purge(
        self,
        name: str,
        as_of: datetime | str | Column,
        older_than: timedelta = timedelta(minutes=2),
        limit: int = 5000,
    ) -> int:
        """Remove the oldest messages done for long; returns how many."""
        state = self._state()
        rows = self._remembered(state)
        victims = queue.purge_victims(rows, name, as_of, older_than, limit)
        # At most MAX_PURGE ids.
        removed = rows.join(F.broadcast(victims), "id", "left_semi")
        # A removed row's payload is never read again.
        removed = removed.withColumns({"gone": F.lit(True), "payload": F.lit(None).cast("string")})
        return self._commit(state, removed).count()

    # --- upkeep

    def _write_base(self, generation: int, messages: DataFrame) -> None:
        store = self.store
        # Ranges of (queue, id): a queue's messages are in few files, whose statistics say so.
        fields = (field.split() for field in MESSAGE_QUEUE.split(","))
        ranged = messages.select(*(F.col(name).cast(kind).alias(name) for name, kind in fields))
        files = messages.count() // ROWS_PER_FILE + 1
        ranged = ranged.repartitionByRange(files, "queue_name", "id").sortWithinPartitions(
            "queue_name", "id"
        )
        ranged.write.mode("overwrite").parquet(store.path(self._at(generation, "base")))
        base = store.read(self._at(generation, "base"), MESSAGE_QUEUE)
        fresh = base.withColumns({"was": F.lit(None).cast("string"), "gone": F.lit(False)})
        counts = _counted(_moves(fresh).filter(F.col("status").isNotNull()))
        store.write_snapshot(counts.coalesce(1), self._at(generation, "counts"), 1)
        # The first change will be number 2; what an earlier attempt left is not to be read.
        if store.exists(self._at(generation, "changes")):
            store.clear(self._at(generation, "changes"))
        row = store.spark.createDataFrame([(generation,)], GENERATION)
        store.write_snapshot(row.coalesce(1), f"{self.name}/generations", generation)

    def compact(self) -> None:
        """Fold the changes into a new base and publish it.

        The generation before the one replaced is removed: a reader that began before the
        publishing still finds its files.
        """
        state = self._state()
        self._write_base(state.generation + 1, self._rows(state))
        before = state.generation - 1
        if before >= 0 and self.store.exists(self._at(before, "counts")):
            self.store.clear(f"{self.name}/gen={before}")


def _hour() -> Column:
    return F.date_trunc("hour", "created_at")


def _moves(changed: DataFrame) -> DataFrame:
    """Signed counts (COUNTS) of what changed rows come from and go to, and of the rows."""
    def side(status: Column, n: int) -> Column:
        hour = F.when(status == "pending", _hour())
        return F.struct(status.alias("status"), hour.alias("hour"), F.lit(n).cast("long").alias("n"))

    to = F.when(~F.col("gone"), side(F.col("status"), 1))
    of = F.when(F.col("was").isNotNull(), side(F.col("was"), -1))
    row = side(F.lit(None).cast("string"), 1)
    moves = changed.select("queue_name", F.inline(F.array_compact(F.array(to, of, row))))
    return moves.withColumn("queue_name", F.when(F.col("status").isNotNull(), F.col("queue_name")))


def _counted(moves: DataFrame) -> DataFrame:
    counts = moves.groupBy("queue_name", "status", "hour").agg(F.sum("n").alias("n"))
    return counts.filter("n <> 0").select("queue_name", "status", "hour", "n")
