"""Queue transitions on literal snapshots, after the reference's own test list."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marquee.operators import queue as q
from marquee.schemas import MESSAGE_QUEUE

T0 = datetime(2024, 1, 1, 12, 0, 0)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], MESSAGE_QUEUE)


def push(spark, empty, *messages, when=T0):
    frame = spark.createDataFrame(list(messages), "id BIGINT, queue_name STRING, payload STRING")
    return q.enqueue(frame, when, empty)[0]


def one(df, id=1):
    return df.filter(F.col("id") == id).head()


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id BIGINT")


def reasons(spark, *values):
    return spark.createDataFrame(list(values), "id BIGINT, reason STRING")


def test_enqueue_makes_pending_messages(spark, empty):
    rows = push(spark, empty, (1, "test_single", '{"table":"title_basics"}'))
    assert rows.columns == empty.columns
    row = one(rows)
    assert (row.status, row.attempt_count, row.max_attempts) == ("pending", 0, 5)
    assert row.available_at == row.created_at == row.updated_at == T0


def test_enqueue_refuses_blank_names_and_missing_payloads(spark, empty):
    frame = spark.createDataFrame(
        [(1, " ", "{}"), (2, None, "{}"), (3, "a", None), (4, "a", "{"), (5, "a", "1")],
        "id BIGINT, queue_name STRING, payload STRING",
    )
    rows, refused = q.enqueue(frame, T0, empty)
    assert [r.id for r in rows.collect()] == [5]
    assert refused.count() == 4


def test_claim_then_ack(spark, empty):
    rows = push(spark, empty, (1, "a", '{"v":1}'))
    assert [tuple(r) for r in q.claim(rows, "a", T0, 1).collect()] == [(1, '{"v":1}')]
    claimed = q.dequeue(rows, "a", at(1), 1)
    assert one(claimed).status == "processing" and one(claimed).attempt_count == 1
    done = q.ack(claimed, ids(spark, 1, 99), at(2))
    row = one(done)
    assert (row.status, row.completed_at, row.processing_started_at) == ("done", at(2), None)
    again = one(q.ack(done, ids(spark, 1), at(9)))
    assert again.completed_at == at(2) and again.updated_at == at(9)


def test_ack_leaves_pending_and_failed_alone(spark, empty):
    rows = push(spark, empty, (1, "a", "{}"))
    assert one(q.ack(rows, ids(spark, 1), at(1))) == one(rows)


def test_null_ids_raise(spark, empty):
    rows = push(spark, empty, (1, "a", "{}"))
    with pytest.raises(Exception, match="message id must not be null"):
        q.ack(rows, ids(spark, None), T0).collect()
    with pytest.raises(Exception, match="message id must not be null"):
        q.nack(rows, reasons(spark, (None, "x")), T0).collect()


def test_nack_retries_with_backoff(spark, empty):
    rows = push(spark, empty, (1, "test_nack", '{"value":1}'))
    now = 0
    for attempt, delay in enumerate([1, 2, 4, 8], start=1):
        rows = q.dequeue(rows, "test_nack", at(now), 1)
        rows = q.nack(rows, reasons(spark, (1, f"failure {attempt}")), at(now))
        row = one(rows)
        assert (row.status, row.attempt_count) == ("pending", attempt)
        assert row.available_at == at(now + delay) and row.last_error == f"failure {attempt}"
        assert q.claim(rows, "test_nack", at(now + delay - 1)).count() == 0
        now += delay
    rows = q.dequeue(rows, "test_nack", at(now), 1)
    assert one(q.nack(rows, reasons(spark, (1, "last")), at(now))).status == "failed"


def test_backoff_is_capped(spark):
    attempts = spark.createDataFrame([(n,) for n in (0, 1, 9, 10, 31, 100)], "n INT")
    seconds = attempts.select(F.lit(T0) + q.backoff(F.col("n"))).collect()
    assert [int((r[0] - T0).total_seconds()) for r in seconds] == [1, 1, 256, 300, 300, 300]


def test_batch_of_three(spark, empty):
    rows = push(spark, empty, *((i, "test_batch", f'{{"value":{i}}}') for i in (3, 1, 2, 4)))
    assert sorted(r.msg_id for r in q.claim(rows, "test_batch", T0, 3).collect()) == [1, 2, 3]


def test_unknown_queue_is_empty(spark, empty):
    rows = push(spark, empty, (1, "a", "{}"))
    assert q.claim(rows, "queue_does_not_exist", T0).count() == 0


def test_queues_are_isolated(spark, empty):
    rows = push(spark, empty, (1, "queue_a", "{}"), (2, "queue_b", "{}"))
    assert [r.msg_id for r in q.claim(rows, "queue_a", T0).collect()] == [1]
    assert [r.msg_id for r in q.claim(rows, "queue_b", T0).collect()] == [2]
    both = q.claim_all_ids(rows, T0).orderBy("id").collect()
    assert [(r.queue_name, r.id, r.position) for r in both] == [("queue_a", 1, 1), ("queue_b", 2, 1)]


def test_claim_all_beyond_the_group_limit(spark, empty):
    frame = spark.range(5000).select(
        "id", F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("queue_name"), F.lit("{}").alias("payload")
    )
    rows = q.enqueue(frame, T0, empty)[0]
    got = q.claim_all_ids(rows, T0, n=1500)
    expected = [i for i in range(5000) if i % 5][:1500]
    assert sorted(r.id for r in got.filter("queue_name = 'a'").collect()) == expected
    assert got.filter("queue_name = 'b'").count() == 1000


def test_visibility_timeout_reclaims(spark, empty):
    rows = q.dequeue(push(spark, empty, (1, "v", '{"value":9}')), "v", at(0), 1)
    assert q.claim(rows, "v", at(29)).count() == 0
    again = one(q.dequeue(rows, "v", at(30), 1))
    assert (again.status, again.attempt_count, again.last_error) == ("processing", 2, q.RECLAIMED)


def test_exhausted_messages_fail_on_dequeue(spark, empty):
    rows = push(spark, empty, (1, "r", "{}")).withColumn("max_attempts", F.lit(1))
    rows = q.dequeue(rows, "r", at(0), 1)
    late = one(q.dequeue(rows, "r", at(31), 1))
    assert (late.status, late.failed_at, late.last_error) == ("failed", at(31), q.EXPIRED)
    assert late.processing_started_at is None


def test_pending_message_without_attempts_is_left(spark, empty):
    rows = push(spark, empty, (1, "r", "{}")).withColumn("max_attempts", F.lit(0))
    assert one(q.dequeue(rows, "r", at(60), 1)).status == "pending"


def test_retry_limit(spark, empty):
    rows = push(spark, empty, (1, "test_retry", '{"value":10}')).withColumn("max_attempts", F.lit(2))
    for n, status in ((0, "pending"), (5, "failed")):
        rows = q.nack(q.dequeue(rows, "test_retry", at(n), 1), reasons(spark, (1, "failure")), at(n))
        assert one(rows).status == status


def test_duplicate_payloads_are_kept(spark, empty):
    rows = push(spark, empty, (1, "d", '{"same":true}'), (2, "d", '{"same":true}'))
    assert rows.filter("queue_name = 'd'").count() == 2


def test_permanent_nack_fails_at_once(spark, empty):
    rows = q.dequeue(push(spark, empty, (1, "m", '{"unexpected":true}')), "m", at(0), 1)
    reason = "[permanent] payload must contain table and data"
    row = one(q.nack(rows, reasons(spark, (1, reason)), at(1)))
    assert (row.status, row.failed_at, row.last_error) == ("failed", at(1), reason)


def test_nack_cuts_long_reasons_and_prefers_permanent(spark, empty):
    rows = q.dequeue(push(spark, empty, (1, "m", "{}"), (2, "m", "{}")), "m", at(0), 2)
    out = q.nack(rows, reasons(spark, (1, "x" * 5000), (2, "a"), (2, "[permanent] b"), (2, None)), at(1))
    assert len(one(out, 1).last_error) == 4000
    assert one(out, 2).status == "failed"


def test_metrics_and_inflight(spark, empty):
    rows = push(spark, empty, *((i, "a", "{}") for i in range(5)), (9, "b", "{}"))
    rows = q.dequeue(rows, "a", at(0), 2)
    by_name = {r.queue_name: r for r in q.metrics(rows).collect()}
    a = by_name["a"]
    assert (a.pending, a.processing, a.done, a.failed, a.total) == (3, 2, 0, 0, 5)
    assert a.oldest_pending_at == T0 and by_name["b"].total == 1
    assert q.inflight(rows, "a").head().inflight == 5
    assert q.metrics(rows, "b").count() == 1


def test_purge_takes_the_lowest_old_ids(spark, empty):
    rows = push(spark, empty, *((i, "a", "{}") for i in range(6)))
    rows = q.ack(q.dequeue(rows, "a", at(0), 4), ids(spark, 0, 1, 2, 3), at(10))
    assert q.purge_victims(rows, "a", at(129)).count() == 0
    left = q.purge(rows, "a", at(130), limit=3)
    assert sorted(r.id for r in left.collect()) == [3, 4, 5]


def test_argument_bounds(empty):
    for bad in (0, 10_001, None):
        with pytest.raises(ValueError):
            q.claim(empty, "a", T0, bad)
    for name in ("", "  ", None):
        with pytest.raises(ValueError):
            q.claim(empty, name, T0)
    with pytest.raises(ValueError):
        q.claim(empty, "a", T0, 1, timedelta(0))
    with pytest.raises(ValueError):
        q.purge(empty, "a", T0, timedelta(seconds=-1))
    for bad in (0, 100_001):
        with pytest.raises(ValueError):
            q.purge(empty, "a", T0, limit=bad)
    with pytest.raises(ValueError):
        q.backpressure(empty, high=5, low=5)


def test_backpressure_holds_between_marks(spark):
    depths = spark.createDataFrame(
        [("a", at(i), d) for i, d in enumerate([5, 20, 15, 11, 10, 15, 19, 25])],
        "queue_name STRING, step_end TIMESTAMP, depth BIGINT",
    )
    flags = q.backpressure(depths, high=20, low=10).orderBy("step_end").collect()
    assert [r.paused for r in flags] == [False, True, True, True, False, False, False, True]


def test_changed_rows_merge_into_the_full_result(spark, empty):
    rows = push(spark, empty, *((i, "ab"[i % 2], "{}") for i in range(20)))
    rows = rows.withColumn("max_attempts", F.when(F.col("id") < 4, 1).otherwise(5))
    rows = q.dequeue(rows, "a", at(0), 6)
    given = reasons(spark, *((i, "x") for i in range(5, 12)))
    transitions = [
        lambda r, **kw: q.expire_exhausted(r, "a", timedelta(seconds=30), at(60), **kw),
        lambda r, **kw: q.dequeue(r, "a", at(60), 5, **kw),
        lambda r, **kw: q.ack(r, ids(spark, 0, 6, 7, 99), at(60), **kw),
        lambda r, **kw: q.nack(r, given, at(60), **kw),
    ]
    for step in transitions:
        changed = step(rows, changed_only=True)
        assert 0 < changed.count() < 20
        merged = q.merge(rows, changed)
        assert sorted(merged.collect(), key=lambda r: r.id) == sorted(step(rows).collect(), key=lambda r: r.id)
