"""Queued messages to typed tables, as a stream of idempotent batches.

The stream's checkpoint takes the place of claiming: each batch is handed out until it is
finished. Everything a batch writes goes to folders named after it, and the tables it
compares with leave that batch out, so a repeated batch replaces its own output and nothing
else. There is one writer per store.

A message to retry waits until it is due. The stream's next batch takes what is due by then, and
``retry_due`` and ``drain`` do without new input: they are further rounds of the stream's last
batch, and the next batch goes on from the last of them.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators import normalize
from marquee.operators.queue import DEFAULT_ATTEMPTS, MAX_ERROR_CHARS, backoff
from marquee.operators.relational import shuffled_side
from marquee.plans.ingest import PRODUCED, batch_event, land
from marquee.schemas import DATASETS, LEVELS, Dataset
from marquee.sources.buckets import bucket_of, buckets, spread, touched_buckets
from marquee.sources.store import Store

log = logging.getLogger("marquee")

OUTCOMES = "id BIGINT, table_name STRING, outcome STRING, reason STRING, attempts INT"
REFUSED = "refused"
#: What waits after a round. A row without an id marks the round, so that it shows when none does.
WAITING = "id BIGINT, payload STRING, attempts INT, available_at TIMESTAMP"
#: Messages that never land, kept as they came.
REJECTED = "id BIGINT, payload STRING, outcome STRING, reason STRING"
PLACE = "run STRING, epoch BIGINT, round INT"
ROUND = f"{PLACE}, bucket INT"

Writer = Callable[[DataFrame, str, str], None]


def produced_messages(
    spark: SparkSession, store_dir: str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the messages ``plans.ingest.produce`` wrote.

    Landing a batch reads the keys in those buckets of its tables and their parents that it
    touches, which for a large batch are all, so by default everything that waits makes one
    batch. ``files_per_batch`` bounds it where latency or back-pressure matters more.
    """
    reader = spark.readStream.schema(f"{PRODUCED}, source INT, after BIGINT")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    produced = reader.parquet(Store(spark, store_dir).path("produced"))
    return produced.filter("NOT refused").select("id", "payload")


def landed(
    store: Store,
    dataset: Dataset,
    run: str,
    epoch: int,
    turn: int,
    inclusive: bool,
    within: Sequence[int] | None = None,
) -> DataFrame:
    """Rows of a table as of a round of a batch of ``run``: without it, or with it included.

    ``within`` names the buckets to read; the others' files are not opened.
    """
    rows = _stored(store, dataset)
    if within is not None:
        rows = rows.filter(F.col("bucket").isin(*within))
    last = turn if inclusive else turn - 1
    earlier = (F.col("epoch") < epoch) | ((F.col("epoch") == epoch) & (F.col("round") <= last))
    return rows.filter((F.col("run") != run) | earlier)


def _stored(store: Store, dataset: Dataset) -> DataFrame:
    here = f"tables/{dataset.table}/gen={store.generation()}"
    return store.read(here, f"{ddl(dataset)}, {ROUND}")


def ddl(dataset: Dataset) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dataset.schema.fields)


def outcome_log(store: Store) -> DataFrame:
    """What became of the messages of every batch: a row per message and attempt."""
    rows = store.read(f"outcomes/gen={store.generation()}", OUTCOMES)
    return rows.select("id", "table_name", "outcome", "reason", "attempts")


def table(spark: SparkSession, store_dir: str, name: str) -> DataFrame:
    """All landed rows of a table."""
    return _stored(Store(spark, store_dir), DATASETS[name]).drop("run", "epoch", "round", "bucket")


def _waiting(store: Store, run: str, epoch: int, turn: int) -> DataFrame:
    """What waits before a round: after the round before, or the last one of the batch before."""
    rows = store.read(
        f"waiting/run={run}/epoch={epoch if turn else epoch - 1}", f"{WAITING}, round INT"
    )
    last = turn - 1 if turn else rows.agg(F.max("round")).head()[0]
    return rows.filter((F.col("round") == last) & F.col("id").isNotNull()).drop("round")


def consume(
    batch: DataFrame,
    epoch: int,
    store: Store,
    run: str = "main",
    references: bool = True,
    write: Writer | None = None,
    as_of: Column | None = None,
    turn: int = 0,
) -> None:
    """Land one batch of messages (id, payload) and record what became of each.

    Messages that wait and are due at ``as_of`` (by default, now) join the batch; the others
    wait on. ``turn`` numbers the rounds of a batch, of which the stream's own is 0.
    """
    now = F.lit(datetime.now(timezone.utc)) if as_of is None else as_of.cast("timestamp")
    _refuse_lost_checkpoint(store, run, epoch)
    write, store = write or store.write_run, store.pin()
    waiting = _waiting(store, run, epoch, turn)
    claimed = batch.select("id", "payload", F.lit(0).alias("attempts")).unionByName(
        waiting.filter(F.col("available_at") <= now).drop("available_at")
    )
    place = (run, epoch, turn)
    parsed, written = land_messages(claimed, store, place, references, write)
    retry = written.filter(F.col("outcome") == "retry")
    retries = retry.groupBy("id").agg(F.max("attempts").alias("attempts"))
    again = parsed.select("id", "payload").join(shuffled_side(retries), "id")
    again = again.withColumn("available_at", now + backoff(F.col("attempts")))
    mark = store.spark.createDataFrame([(None, None, None, None)], WAITING)
    later = waiting.filter(F.col("available_at") > now)
    here = f"run={run}/epoch={epoch}/round={turn}"
    store.write_run(mark.unionByName(again).unionByName(later), "waiting", here)
    record_batch(store, place, batch_event(written, now))


def record_batch(store: Store, place: tuple[str, int, int], event: DataFrame) -> None:
    """Write the event of the batch at ``place``, the last thing a batch does."""
    run, epoch, turn = place
    name = f"{run}-{epoch}-{turn}" if turn else f"{run}-{epoch}"
    here = f"gen={store.generation()}/writer=consumer/batch={name}"
    store.write_run(event, "events", here)


def land_messages(
    claimed: DataFrame,
    store: Store,
    place: tuple[str, int, int],
    references: bool = True,
    write: Writer | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(parsed messages, their outcomes), both as written, of messages (id, payload, attempts).

    The parsed batch is written once, split by target table, and everything after reads its
    part of that: nothing is parsed again, for another table or after a lost executor. Tables
    land in waves: all at once that refer to earlier waves only, so that a parent and its child
    may come in one batch.
    """
    run, epoch, turn = place
    here = f"run={run}/epoch={epoch}/round={turn}"
    recorded = f"gen={store.generation()}/{here}"
    write = write or store.write_run
    count = buckets(store)
    part = F.when(F.col("reason").isNull(), F.col("table_name")).otherwise(F.lit(REFUSED))
    parsed = normalize.normalize_messages(claimed).withColumn("part", part)
    inbox = f"{store.path('inbox')}/{here}"
    parsed.write.mode("overwrite").partitionBy("part").parquet(inbox)
    parsed = store.spark.read.schema(parsed.schema).parquet(inbox)

    counts = {r.part: r["count"] for r in parsed.groupBy("part").count().collect()}  # 8 parts
    outcomes = parsed.filter(F.col("part") == REFUSED).select(
        "id",
        "table_name",
        F.lit("permanent").alias("outcome"),
        normalize.permanent_reason().alias("reason"),
        (F.col("attempts") + 1).alias("attempts"),
    )
    store.write_run(outcomes, "outcomes", f"{recorded}/part={REFUSED}")

    def land_one(dataset: Dataset) -> None:
        mine = normalize.accepted_messages(
            parsed.filter(F.col("part") == dataset.table), dataset, "id", "attempts"
        )
        try:
            rows = counts[dataset.table]
            retry = _land_table(mine, dataset, store, place, references, rows, write, count)
        except AnalysisException:
            raise  # a fault of the job, not of its data or the store
        except (PySparkException, Py4JJavaError, OSError) as error:
            # One table failing must not lose the others.
            log.exception("landing %s failed; its messages are retried", dataset.table)
            text = f"landing error: {error}"[:MAX_ERROR_CHARS]
            retry = mine.select("id").distinct().withColumn("reason", F.lit(text))
        retry = shuffled_side(retry, rows)
        done = mine.select("id", "attempts").join(retry, "id", "left")
        store.write_run(_outcomes(done, dataset.table), "outcomes", f"{recorded}/part={dataset.table}")

    for level in LEVELS:
        _at_once(store.spark, land_one, [d for d in level if d.table in counts])
    written = store.spark.read.schema(OUTCOMES).parquet(f"{store.path('outcomes')}/{recorded}")
    ended = written.filter(F.col("outcome").isin("permanent", "failed"))
    few = sum(counts.values())
    rejected = parsed.select("id", "payload").join(shuffled_side(ended, few), "id")
    store.write_run(rejected.select("id", "payload", "outcome", "reason"), "rejected", recorded)
    return parsed, written


def _at_once(spark: SparkSession, job: Callable[[Dataset], None], datasets: list[Dataset]) -> None:
    """``job`` for each table, side by side; the first fault is raised once all have ended."""
    if len(datasets) == 1:
        job(datasets[0])
    elif datasets:
        with ThreadPoolExecutor(len(datasets)) as pool:
            done = [pool.submit(inheritable_thread_target(spark)(job), d) for d in datasets]
        for one in done:
            one.result()


def retry_due(
    spark: SparkSession,
    store_dir: str,
    run: str = "main",
    references: bool = True,
    write: Writer | None = None,
    as_of: datetime | None = None,
) -> datetime | None:
    """Consume the messages that wait and are due, without new input.

    Returns when the next one is due (UTC), or None if nothing waits any more. Not to be called
    while the stream runs; a batch that was broken off must be finished by the stream first.
    """
    store = Store(spark, store_dir)
    now = as_of or datetime.now(timezone.utc)
    place = F.struct("epoch", "round")
    rounds = store.read(f"waiting/run={run}", f"{WAITING}, epoch BIGINT, round INT")
    last = rounds.agg(F.max(place)).head()[0]
    if last is None:
        return None
    begun = store.read(f"inbox/run={run}", "id BIGINT, epoch BIGINT, round INT, part STRING")
    begun = begun.agg(F.max("epoch")).head()[0]
    if begun is not None and begun > last["epoch"]:
        raise ValueError(f"batch {begun} of run {run!r} is not finished; run the stream first")
    if (due := _next_due(store, run, last["epoch"], last["round"] + 1)) is None or due > now:
        return due
    nothing = spark.createDataFrame([], "id BIGINT, payload STRING")
    turn = last["round"] + 1
    consume(nothing, last["epoch"], store, run, references, write, F.lit(now), turn)
    return _next_due(store, run, last["epoch"], turn + 1)


def _next_due(store: Store, run: str, epoch: int, turn: int) -> datetime | None:
    first = F.unix_micros(F.min("available_at"))
    micros = _waiting(store, run, epoch, turn).agg(first).head()[0]
    return None if micros is None else datetime.fromtimestamp(micros / 1e6, timezone.utc)


def drain(
    spark: SparkSession,
    store_dir: str,
    run: str = "main",
    references: bool = True,
    write: Writer | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> None:
    """Retry what waits, each message when it is due, until all are in or have failed."""
    while (due := retry_due(spark, store_dir, run, references, write)) is not None:
        sleep(max(0.1, (due - datetime.now(timezone.utc)).total_seconds()))


def _land_table(mine, dataset, store, place, references, rows, write, count) -> DataFrame:
    """Insert one table's rows; (id, reason) of the messages to retry.

    Rows are kept by bucket of their key, and only the buckets that the batch's keys and
    references fall in are read.
    """
    run, epoch, turn = place

    def parents(name: str, column: str) -> DataFrame:
        within = touched_buckets(mine, [column], count, rows)
        return landed(store, DATASETS[name], *place, inclusive=True, within=within)

    within = touched_buckets(mine, dataset.key, count, rows)
    target = landed(store, dataset, *place, inclusive=False, within=within)
    fresh, orphans = land(
        mine.drop("attempts"), dataset, target, parents if references else None, rows
    )
    fresh = fresh.withColumn("bucket", bucket_of(dataset.key, count))
    here = f"gen={store.generation()}/run={run}/epoch={epoch}/round={turn}"
    write(spread(fresh, ["bucket"], dataset.key, rows / count), f"tables/{dataset.table}", here)
    return orphans.distinct().select("id", F.lit("a referenced row is missing").alias("reason"))


def _outcomes(done: DataFrame, name: str) -> DataFrame:
    """Acked, or retried while attempts are left, or failed."""
    attempts = F.col("attempts") + 1
    outcome = (
        F.when(F.col("reason").isNull(), F.lit("ack"))
        .when(attempts >= DEFAULT_ATTEMPTS, F.lit("failed"))
        .otherwise(F.lit("retry"))
    )
    return done.select(
        "id",
        F.lit(name).alias("table_name"),
        outcome.alias("outcome"),
        "reason",
        attempts.alias("attempts"),
    )


def _refuse_lost_checkpoint(store: Store, run: str, epoch: int) -> None:
    """A new checkpoint counts from 0 again and would replace batches that are done."""
    # Every batch begins with its inbox, which a purge empties but leaves. Only the next batch's
    # folder is looked for, however many there are.
    if store.exists(f"inbox/run={run}/epoch={epoch + 1}"):
        raise ValueError(
            f"run {run!r} already has batch {epoch + 1}; give a new checkpoint a new run name"
        )


def purge(store: Store, epochs: Iterable[int], run: str = "main") -> None:
    """Remove the payloads that finished batches of a run still hold.

    Neither the last batch nor the one before may be among ``epochs``. Outcomes stay, and so do
    messages that never landed (``rejected``).
    """
    for epoch in epochs:
        for name in ("inbox", "waiting"):
            if store.exists(folder := f"{name}/run={run}/epoch={epoch}"):
                store.clear(folder)


def purge_produced(spark: SparkSession, store_dir: str, run: str = "main") -> int:
    """Remove the queued messages of producer runs that ended; returns how many runs.

    A run of ``produce`` has ended when each of its messages landed, failed or was refused, in a
    batch before the last one begun: the stream will not ask for those again. Dead letters stay.
    """
    store = Store(spark, store_dir)
    here = f"outcomes/gen={store.generation()}"
    outcomes = store.read(here, f"{OUTCOMES}, run STRING, epoch BIGINT").filter(
        (F.col("run") == run) & (F.col("outcome") != "retry")
    )
    begun = store.read(f"inbox/run={run}", "id BIGINT, epoch BIGINT, round INT, part STRING")
    last = begun.agg(F.max("epoch")).head()[0] or 0
    queued = store.read("produced", f"{PRODUCED}, source INT, after BIGINT").filter("NOT refused")
    ended = outcomes.filter(F.col("epoch") < last).select("id", F.lit(1).alias("ended"))
    runs = (
        queued.select("id", "source", "after")
        .join(ended.distinct(), "id", "left")
        .groupBy("source", "after")
        .agg(F.count_if(F.col("ended").isNull()).alias("open"))
        .filter("open = 0")
        .collect()  # a row per run of the producer
    )
    for row in runs:
        store.clear(f"produced/source={row.source}/after={row.after}/refused=false")
    return len(runs)


def run_ingest(
    messages: DataFrame,
    store_dir: str,
    checkpoint: str,
    run: str = "main",
    references: bool = True,
    write: Writer | None = None,
    as_of: Column | None = None,
    purge_every: int = 20,
) -> StreamingQuery:
    """Consume what is there now, batch by batch, and stop; ``drain`` retries what waits then.

    Every ``purge_every`` batches (0: never) the payloads of the batches before are removed.
    """
    store = Store(messages.sparkSession, store_dir)

    def each(batch: DataFrame, epoch: int) -> None:
        consume(batch, epoch, store, run, references, write, as_of)
        if purge_every and epoch % purge_every == 0:
            # The last two batches stay: one may be repeated, and needs what waits after the other.
            purge(store, range(max(0, epoch - 1 - purge_every), epoch - 1), run)

    return (
        messages.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
