"""The life-cycle stream against the plain fold of its transition function."""

import random

from pyspark.sql import functions as F

from marquee.streaming import lifecycle as L

SECOND = 1_000_000
TIMEOUT = 30 * SECOND


def test_transitions():
    m = L.enqueued(0)
    m = L.advance(m, "claim", 0, None, TIMEOUT)
    assert (m.status, m.attempts, m.started_at) == ("processing", 1, 0)
    assert L.advance(m, "claim", 29 * SECOND, None, TIMEOUT) == m
    again = L.advance(m, "claim", 30 * SECOND, None, TIMEOUT)
    assert (again.attempts, again.last_error) == (2, L.RECLAIMED)
    back = L.advance(again, "nack", 40 * SECOND, "boom", TIMEOUT)
    assert (back.status, back.available_at) == ("pending", 42 * SECOND)
    assert L.advance(back, "claim", 41 * SECOND, None, TIMEOUT) == back
    late = L.advance(m, "ack", 500 * SECOND, None, TIMEOUT)
    assert (late.status, late.completed_at) == ("done", 500 * SECOND)
    assert L.advance(m, "nack", 1, "[permanent] x", TIMEOUT).status == "failed"
    last = m._replace(attempts=5)
    gone = L.advance(last, "ack", 31 * SECOND, None, TIMEOUT)
    assert (gone.status, gone.failed_at, gone.last_error) == ("failed", TIMEOUT, L.EXPIRED)


def test_stream_equals_fold_across_batches(spark, tmp_path):
    rng = random.Random(7)
    ops, clock = [], 1_700_000_000 * SECOND
    for seq in range(900):
        clock += rng.randrange(1, 20) * SECOND
        ops.append((rng.randrange(40), seq, clock, rng.choice(["claim"] * 6 + ["ack", "nack", "tick"]), "boom"))
    expected = {}
    for id_, _, at, op, reason in ops:
        expected[id_] = L.advance(expected.get(id_) or L.enqueued(at), op, at, reason, TIMEOUT)
    end = clock + 3600 * SECOND
    expected = {k: L.settle(m, end, TIMEOUT) for k, m in expected.items()}

    folder = str(tmp_path / "ops")
    schema = "id BIGINT, seq BIGINT, us BIGINT, op STRING, reason STRING"
    (tmp_path / "ops").mkdir()
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    frame = source.select("id", "seq", F.timestamp_micros("us").alias("op_at"), "op", "reason")
    for part in range(3):  # restarted from its checkpoint for every file
        rows = ops[part * 300:(part + 1) * 300]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        (
            L.lifecycle(frame, lateness="1 second").writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True).start().awaitTermination()
        )
    changes = spark.read.schema(L.TRANSITIONS).parquet(str(tmp_path / "out"))
    state = L.current_state(changes, F.timestamp_micros(F.lit(end)))
    micros = [F.unix_micros(c).alias(c) for c in ("available_at", "started_at", "completed_at", "failed_at")]
    got = {
        r.id: L.Message(r.status, r.attempts, r.available_at, r.started_at, r.completed_at, r.failed_at, r.last_error)
        for r in state.select("id", "status", "attempts", *micros, "last_error").collect()
    }
    assert got == expected
    assert changes.filter("op = 'expire'").count() > 0


def test_late_operations_apply_when_they_arrive(spark, tmp_path):
    """An ack far behind the watermark still finishes its message."""
    folder, schema = str(tmp_path / "ops"), "id BIGINT, seq BIGINT, us BIGINT, op STRING, reason STRING"
    t = 1_700_000_000 * SECOND
    batches = [
        [(1, 1, t, "claim", None), (2, 2, t, "claim", None)],
        [(3, 3, t + 7200 * SECOND, "claim", None)],
        [(4, 4, t + 10_800 * SECOND, "claim", None)],
        [(1, 5, t + 20 * SECOND, "ack", None), (2, 6, t + 25 * SECOND, "nack", "boom")],
    ]
    source = None
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(schema).parquet(folder)
        frame = source.select("id", "seq", F.timestamp_micros("us").alias("op_at"), "op", "reason")
        (
            L.lifecycle(frame, lateness="1 second").writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True).start().awaitTermination()
        )
    changes = spark.read.schema(L.TRANSITIONS).parquet(str(tmp_path / "out"))
    state = L.current_state(changes, F.timestamp_micros(F.lit(t + 20_000 * SECOND)))
    assert {r.id: r.status for r in state.collect()} == {
        1: "done", 2: "pending", 3: "processing", 4: "processing"
    }
    assert changes.groupBy("id").agg(F.max("step")).count() == 4
