"""The stored queue: transitions against the snapshot operators, crashes, counts, compaction."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marquee.operators import queue
from marquee.plans import ingest, worker
from marquee.schemas import MESSAGE_QUEUE
from marquee.sources.queue_store import QueueStore
from marquee.sources.store import Store
from marquee.streaming import ingest as stream

START = datetime(2024, 1, 1)
MINUTE = timedelta(minutes=1)


@pytest.fixture
def queued(spark, tmp_path):
    return QueueStore(Store(spark, str(tmp_path)))


def messages(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, queue_name STRING, payload STRING")


def put(queued, name, *ids, at=START):
    rows = [(i, name, json.dumps({"value": i})) for i in ids]
    return queued.enqueue(messages(queued.store.spark, rows), at)


def ids_of(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id BIGINT")


def reasons_of(spark, *rows):
    return spark.createDataFrame(list(rows), "id BIGINT, reason STRING")


def by_id(queued):
    return {r.id: r for r in queued.rows().collect()}


def test_life_of_a_message(spark, queued):
    put(queued, "a", 1)
    assert queued.dequeue("other", START).isEmpty()
    claimed = queued.dequeue("a", START, 1, MINUTE).collect()
    assert [(r.msg_id, json.loads(r.payload)) for r in claimed] == [(1, {"value": 1})]
    assert queued.dequeue("a", START, 1, MINUTE).isEmpty()
    queued.ack(ids_of(spark, 1), START)
    assert by_id(queued)[1].status == "done"


def test_nack_gives_back_until_attempts_are_used(spark, queued):
    put(queued, "a", 1)
    at = START
    for attempt in range(1, 6):
        assert queued.dequeue("a", at, 1, MINUTE).count() == 1
        queued.nack(reasons_of(spark, (1, "no")), at)
        row = by_id(queued)[1]
        assert (row.status, row.attempt_count) == ("pending" if attempt < 5 else "failed", attempt)
        at = row.available_at
    assert row.last_error == "no" and row.failed_at is not None


def test_permanent_nack_and_refused_messages(spark, queued):
    refused = queued.enqueue(
        messages(spark, [(1, "a", "{}"), (2, " ", "{}"), (3, "a", None), (4, "a", "{")]), START
    )
    assert sorted(r.id for r in refused.collect()) == [2, 3, 4]
    queued.dequeue("a", START)
    queued.nack(reasons_of(spark, (1, "[permanent] bad")), START)
    assert by_id(queued)[1].status == "failed"


def test_timed_out_claims_come_again(queued):
    put(queued, "a", 1)
    assert queued.dequeue("a", START, 1, MINUTE).count() == 1
    assert queued.dequeue("a", START + MINUTE / 2, 1, MINUTE).isEmpty()
    again = queued.dequeue("a", START + 2 * MINUTE, 1, MINUTE).collect()
    assert [(r.msg_id, r.attempt_count) for r in again] == [(1, 2)]
    assert by_id(queued)[1].last_error == queue.RECLAIMED


def test_as_the_snapshot_operators(spark, queued):
    """Random transitions: the stored rows and counts are those of a snapshot carried along."""
    rng = random.Random(4)
    plain = spark.createDataFrame([], MESSAGE_QUEUE)
    keep = lambda df: spark.createDataFrame(df.collect(), MESSAGE_QUEUE)
    next_id, at = 0, START
    for step in range(9):
        at += MINUTE
        name = rng.choice("ab")
        kind = ["enqueue", "dequeue", "ack", "nack", "purge"][step % 5 if step < 5 else rng.randrange(5)]
        known = [r.id for r in plain.select("id").collect()] or [0]
        chosen = rng.sample(known, min(len(known), 6))
        if kind == "enqueue":
            rows = messages(spark, [(next_id + i, rng.choice("ab"), "{}") for i in range(12)])
            next_id += 12
            plain = plain.unionByName(queue.enqueue(rows, at, plain)[0])
            queued.enqueue(rows, at)
        elif kind == "dequeue":
            plain = queue.dequeue(plain, name, at, 5, MINUTE)
            queued.dequeue(name, at, 5, MINUTE)
        elif kind == "ack":
            plain = queue.ack(plain, ids_of(spark, *chosen, -5), at)
            queued.ack(ids_of(spark, *chosen, -5), at)
        elif kind == "nack":
            reasons = reasons_of(spark, *((i, "[permanent] x" if i % 4 == 0 else "y") for i in chosen))
            plain = queue.nack(plain, reasons, at)
            queued.nack(reasons, at)
        else:
            before = plain.count()
            plain = queue.purge(plain, name, at, timedelta(0), 3)
            assert queued.purge(name, at, timedelta(0), 3) == before - plain.count()
        plain = keep(plain)
        if step in (4, 7):
            queued.compact()
        assert sorted(queued.rows().collect()) == sorted(plain.collect())
        assert queued.metrics().collect() == queue.metrics(plain).collect()
        if step % 3 == 2:
            assert queued.metrics("a").collect() == queue.metrics(plain, "a").collect()
            assert queued.inflight("a") == queue.inflight(plain, "a").head()[0]


def test_a_transition_that_breaks_off_leaves_nothing(spark, queued, monkeypatch):
    put(queued, "a", *range(5))
    before = sorted(queued.rows().collect())

    def broken(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:  # written, but not published
        patch.setattr(Store, "write_snapshot", broken)
        with pytest.raises(KeyboardInterrupt):
            queued.dequeue("a", START)
        with pytest.raises(KeyboardInterrupt):
            queued.compact()
    assert sorted(queued.rows().collect()) == before
    queued.compact()
    assert sorted(queued.rows().collect()) == before
    assert queued.dequeue("a", START, 2).count() == 2
    assert queued.metrics().head().processing == 2


def test_compaction_keeps_rows_and_drops_files(queued):
    for i in range(6):
        put(queued, "a", i)
    rows = queued.rows()
    files = len(set(rows.inputFiles()))
    before = sorted(rows.collect())
    queued.compact()
    assert sorted(queued.rows().collect()) == before == sorted(rows.collect())  # both generations
    assert len(queued.rows().inputFiles()) < files
    queued.compact()
    assert sorted(queued.rows().collect()) == before


def test_metrics_read_one_hour_of_the_messages(spark, queued):
    put(queued, "a", *range(100), at=START)
    put(queued, "a", *range(100, 200), at=START + 5 * MINUTE)
    row = queued.metrics().head()
    assert (row.pending, row.total, row.oldest_pending_at) == (200, 200, START)
    queued.dequeue("a", START + 6 * MINUTE, 100)
    assert queued.metrics().head().oldest_pending_at == START + 5 * MINUTE
    assert queued.metrics("nobody").isEmpty()


# --- the consumer loop


def catalogue(n):
    title = lambda i: {"tconst": f"tt{i}", "title_type": "movie"}
    rating = lambda i: {"tconst": f"tt{i}", "average_rating": 5, "num_votes": i}
    rows = [{"table": "title_ratings", "data": rating(i)} for i in range(n)]  # children first
    rows += [{"table": "title_basics", "data": title(i)} for i in range(n - 1)]
    rows += [{"table": "title_basics", "data": title(0)}, {"table": "nope", "data": {}}]
    return [(i, "imports", json.dumps(m)) for i, m in enumerate(rows)]


class Clock:
    def __init__(self):
        self.now = START

    def __call__(self):
        self.now += timedelta(seconds=1)
        return self.now


def test_loop_lands_and_answers(spark, queued):
    clock = Clock()
    queued.enqueue(messages(spark, catalogue(6)), clock())

    def wait():  # until what was given back is due
        clock.now += 10 * MINUTE
        return not queued.metrics("imports").filter("pending > 0").isEmpty()

    done = worker.process(
        queued, queued.store, "imports", clock, batch_size=5, purge_every=2, compact_every=3, wait=wait
    )
    store = queued.store
    assert stream.table(spark, store.root, "title_basics").count() == 5
    assert stream.table(spark, store.root, "title_ratings").count() == 5  # tt5 never comes
    row = queued.metrics("imports").head()
    assert (row.pending, row.processing, row.failed) == (0, 0, 2)
    assert row.done + done.purged == 11 and done.processed == 11 and done.invalid == 1
    failed = {r.id: r for r in queued.rows().filter("status = 'failed'").collect()}
    assert failed[5].last_error == "a referenced row is missing" and failed[5].attempt_count == 5
    assert failed[12].last_error.startswith("[permanent]")
    events = ingest.event_log(store).collect()
    assert len(events) == done.batches
    counts = [json.loads(e.payload) for e in events]
    assert sum(c["processed"] for c in counts) == 11


def test_loop_that_breaks_off_after_landing(spark, queued, monkeypatch):
    clock = Clock()
    queued.enqueue(messages(spark, catalogue(3)), clock())

    def broken(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(QueueStore, "ack", broken)
        with pytest.raises(KeyboardInterrupt):
            worker.process(queued, queued.store, "imports", clock)
    assert stream.table(spark, queued.store.root, "title_ratings").count() == 2
    clock.now += 5 * MINUTE
    done = worker.process(queued, queued.store, "imports", clock)
    assert done.processed == 5
    assert stream.table(spark, queued.store.root, "title_ratings").count() == 2
    assert queued.metrics().head().done == 5


def test_one_failing_table_is_given_back(spark, queued):
    clock, store = Clock(), queued.store

    def write(df, name, run):
        if name.endswith("title_ratings"):
            raise OSError("disk full")
        store.write_run(df, name, run)

    queued.enqueue(messages(spark, catalogue(3)), clock())
    done = worker.process(queued, store, "imports", clock, write=write)
    assert done.processed == 3 and done.nacked in (3, 6, 9)  # the clock may reach the retries
    waiting = queued.rows().filter("status = 'pending'")
    assert waiting.count() == 3
    assert waiting.filter(F.col("last_error").contains("disk full")).count() == 3
