"""Loading jobs: dumps to queued messages, messages to typed tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from marquee.operators import normalize
from marquee.operators import relational as rel
from marquee.schemas import DATASETS, EVENT_LOG, PRODUCER_PROGRESS, Dataset
from marquee.sources import manifest, tsv
from marquee.sources.store import Store

log = logging.getLogger("marquee")


def outcomes(normalized: DataFrame) -> DataFrame:
    """(id, table_name, outcome, reason) of every message.

    ``ack`` for a message that makes a valid record, ``permanent`` with the nack reason for
    one that never will.
    """
    good = F.col("reason").isNull()
    return normalized.select(
        "id",
        "table_name",
        F.when(good, F.lit("ack")).otherwise(F.lit("permanent")).alias("outcome"),
        normalize.permanent_reason().alias("reason"),
    )


def batch_event(done: DataFrame, at: Column) -> DataFrame:
    """One event-log row with the counters of a consumed batch; the others add up to claimed."""
    counters = F.struct(
        F.count("*").alias("claimed"),
        F.count_if(F.col("outcome") == "ack").alias("processed"),
        F.count_if(F.col("outcome") == "retry").alias("nacked"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
        F.count_if(F.col("outcome") == "permanent").alias("invalid"),
    )
    return done.agg(F.to_json(counters).alias("payload")).select(
        F.lit("consumer_batch_complete").alias("event_type"),
        "payload",
        F.lit(None).cast("string").alias("source_file"),
        at.alias("created_at"),
    )


def events_latest(
    events: DataFrame, event_type: str, n: int, at: str = "created_at", key: str = "source_file"
) -> DataFrame:
    """The ``n`` latest events of a type."""
    mine = events.filter(F.col("event_type") == event_type)
    return mine.orderBy(F.desc(at), F.desc(key)).limit(n)


@dataclass(frozen=True)
class Produced:
    """What a run did with one source."""

    source_file: str
    table: str
    enqueued: int
    malformed: int
    completed: bool


SOURCES = "number INT, source_file STRING, source_size_bytes BIGINT, source_mtime_ns BIGINT"
PRODUCED = "id BIGINT, source_line BIGINT, payload STRING, reason STRING, raw STRING, refused BOOLEAN"


@dataclass(frozen=True)
class Marks:
    """Production pauses at ``high`` messages in flight and goes on at ``low``."""

    high: int
    low: int

    def __post_init__(self):
        if not 0 <= self.low < self.high:
            raise ValueError("low water must be non-negative and below high water")


PRESSURE = "paused BOOLEAN"


def in_flight(store: Store) -> int:
    """Messages queued and not yet landed, failed or refused, by the counts in the event log."""

    def counted(name: str) -> Column:
        return F.coalesce(F.get_json_object("payload", f"$.{name}").cast("bigint"), F.lit(0))

    left = counted("run_enqueued") - counted("processed") - counted("failed") - counted("invalid")
    return event_log(store).agg(F.sum(left)).head()[0] or 0


def _room(store: Store, marks: Marks) -> int:
    """How many more messages may be queued: none from the high mark on, down to the low one."""
    depth = in_flight(store)
    state, version = store.snapshot("pressure", PRESSURE)
    before = version > 0 and state.head().paused
    paused = depth >= marks.high or (before and depth > marks.low)
    if paused != before:
        log.info("production %s at %d messages in flight", "pauses" if paused else "goes on", depth)
        now = store.spark.createDataFrame([(paused,)], PRESSURE)
        store.write_snapshot(now, "pressure", version + 1)
    return 0 if paused else marks.high - depth


def produce(
    spark: SparkSession,
    data_dir: str,
    store_dir: str,
    as_of: datetime,
    selectors: Sequence[str] = (),
    provenance: bool = False,
    max_rows: int = 0,
    restart: bool = False,
    partitions: int | None = None,
    prefer_plain: bool = False,
    marks: Marks | None = None,
    wait: Callable[[], None] | None = None,
) -> list[Produced]:
    """Turn the dump files of a folder into queued messages.

    Per source, lines after the recorded one are converted and written once, accepted rows
    as messages and refused ones as dead letters side by side (``refused`` is the partition
    column); then progress and an event row are recorded. A crash in between repeats that
    source's run into the same folder. A source that changed since it was read raises unless
    ``restart``; a completed one is skipped. ``max_rows`` caps the accepted rows of a source.

    With ``marks`` a run queues no more than there is room for, and a source takes as many runs
    as it needs. Each run reads the source's lines again, so ``high`` should be a good part of a
    source. While production is paused, ``wait`` is called until there is room again; without
    it the job ends there, and the next call goes on.

    A gzip file is decompressed by one task and spread after that (over ``partitions``, or as
    its size suggests); large dumps are better plain.
    """
    store = Store(spark, store_dir)
    names = [n for d in DATASETS.values() for n in (d.filename, d.plain_filename)]
    files = manifest.scan_manifest(spark, data_dir).filter(F.col("source_file").isin(*names))
    listing = {row.source_file: row for row in files.collect()}  # at most two per dataset
    sources = tsv.select_sources(list(listing), selectors, prefer_plain)
    done: list[Produced] = []
    for dataset, name in sources:
        left, first = max_rows, restart
        while True:
            cap = left
            if marks:
                while not (room := _room(store, marks)):
                    if wait is None:
                        return done
                    wait()
                cap = min(left, room) if left else room
            mine = files.filter(F.col("source_file") == name)
            run = _produce_run(
                store, mine, listing[name], dataset, data_dir, as_of, provenance, cap, first, partitions
            )
            if run is None:
                break
            done.append(run)
            left, first = left - run.enqueued, False
            if run.completed or cap == 0 or (max_rows and left <= 0):
                break
    return done


def _produce_run(
    store: Store,
    files: DataFrame,
    source: Row,
    dataset: Dataset,
    data_dir: str,
    as_of: datetime,
    provenance: bool,
    max_rows: int,
    restart: bool,
    partitions: int | None,
) -> Produced | None:
    """One run over one source, from where the last one ended; None if that was its end."""
    spark, name = store.spark, source.source_file
    progress, version = store.snapshot("progress", PRODUCER_PROGRESS)
    if restart:
        progress = manifest.reset_progress(progress, [name])
    state = manifest.manifest_status(files, progress).head()
    if state.status == "changed":
        raise ValueError(f"{name} changed since it was read; check it, then restart it")
    if state.status == "complete":
        log.info("skipping %s: already read to its end", name)
        return None
    before = progress.filter(F.col("source_file") == name).head()
    number = _source_number(store, source)
    run = f"source={number}/after={state.resume_after}"
    target = f"{store.path('produced')}/{run}"
    raw = tsv.read_tsv(spark, f"{data_dir.rstrip('/')}/{name}", dataset, partitions)
    raw = raw.filter(F.col("source_line") > state.resume_after)
    messages = _messages(raw, dataset, number, provenance, max_rows)
    messages.write.mode("overwrite").partitionBy("refused").parquet(target)
    rows = spark.read.schema(PRODUCED).parquet(target)
    counts = rows.agg(
        F.count_if(~F.col("refused")).alias("enqueued"),
        F.count_if("refused").alias("malformed"),
        F.coalesce(F.max("source_line"), F.lit(state.resume_after)).alias("last_line"),
    ).head()
    completed = not max_rows or raw.filter(F.col("source_line") > counts.last_line).isEmpty()
    update = spark.createDataFrame(
        [(
            name, dataset.table, source.source_size_bytes, source.source_mtime_ns,
            counts.last_line, (before.rows_enqueued if before else 0) + counts.enqueued,
            (before.malformed_rows if before else 0) + counts.malformed, completed, as_of,
        )],
        PRODUCER_PROGRESS,
    )
    event = update.select(
        F.lit("producer_file_checkpoint").alias("event_type"),
        F.to_json(
            F.struct(
                F.col("table_name").alias("table"),
                F.lit(counts.enqueued).alias("run_enqueued"),
                F.lit(counts.malformed).alias("run_malformed"),
                F.col("rows_enqueued").alias("total_enqueued"),
                "completed",
            )
        ).alias("payload"),
        "source_file",
        F.col("updated_at").alias("created_at"),
    )
    here = f"gen={store.generation()}/writer=producer/batch={number}-{state.resume_after}"
    store.write_run(event.coalesce(1), "events", here)
    merged = manifest.upsert_progress(progress, update).coalesce(1)
    store.write_snapshot(merged, "progress", version + 1)
    return Produced(name, dataset.table, counts.enqueued, counts.malformed, completed)


def _source_number(store: Store, source: Row) -> int:
    """The number of a source in this state (name, size, time); a new state gets a new one.

    It is kept before anything is written under it, so a repeated run finds it again.
    """
    known, version = store.snapshot("sources", SOURCES)
    identity = (source.source_file, source.source_size_bytes, source.source_mtime_ns)
    size, time = F.col("source_size_bytes"), F.col("source_mtime_ns")
    same = known.filter(F.col("source_file") == identity[0])
    same = same.filter((size == identity[1]) & (time == identity[2])).head()
    if same:
        return same.number
    number = version + 1
    added = store.spark.createDataFrame([(number, *identity)], SOURCES)
    store.write_snapshot(known.unionByName(added).coalesce(1), "sources", number)
    return number


def _messages(
    raw: DataFrame, dataset: Dataset, number: int, provenance: bool, max_rows: int
) -> DataFrame:
    """Raw rows as messages, or as dead letters where ``refused``."""
    classified = normalize.classify(raw, dataset, provenance)
    refused = F.col("reason").isNotNull()
    record = {c: F.col(f"record.{c}") for c in (*dataset.columns, "metadata")}
    return tsv.up_to_accepted(classified, max_rows).select(
        # Unique and in order of source and line, without a counter the tasks would share.
        (F.lit(number).cast("bigint") * (1 << 40) + F.col("source_line")).alias("id"),
        "source_line",
        F.when(~refused, normalize.envelope(dataset.table, record)).alias("payload"),
        "reason",
        F.when(refused, normalize.raw_json(dataset)).alias("raw"),
        refused.alias("refused"),
    )


def event_log(store: Store) -> DataFrame:
    """The events of all producer and consumer batches."""
    rows = store.read(f"events/gen={store.generation()}", f"{EVENT_LOG}, writer STRING, batch STRING")
    return rows.drop("writer", "batch")


def dead_letter_log(store: Store) -> DataFrame:
    """Refused rows of all runs: source, line, reason and raw fields."""
    rows = store.read("produced", f"{PRODUCED}, source INT, after BIGINT").filter("refused")
    sources = store.snapshot("sources", SOURCES)[0].withColumnRenamed("number", "source")
    return rows.join(sources, "source").select("source_file", "source_line", "reason", "raw")


def land(
    batch: DataFrame,
    dataset: Dataset,
    target: DataFrame,
    parents: Callable[[str, str], DataFrame] | None = None,
    rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, ids to retry) for one table's accepted messages (id, columns).

    The first message of a key wins and keys the target holds are left alone. With
    ``parents`` (table and referring column to rows) messages whose parents are missing are
    retried; the others of the batch are not held up by them.
    """
    insertable, orphans = batch, batch.limit(0)
    if parents and dataset.references:
        references = [(fk, parents(table, fk), pk) for fk, table, pk in dataset.references]
        insertable, orphans = rel.split_orphans(batch, references, rows)
    first = rel.first_per_key(insertable, dataset.key, ["id"])
    fresh = rel.without_existing(first, target, dataset.key, rows)
    return fresh.select(*dataset.columns, "metadata"), orphans.select("id")
