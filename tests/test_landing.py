"""Landing by buckets of the key and in waves, and rewriting stores in fewer files."""

import json
import re

import pytest
from pyspark.sql import functions as F

from marquee.plans import ingest
from marquee.schemas import DATASETS, LEVELS
from marquee.sources import buckets
from marquee.sources.store import Store
from marquee.streaming import compaction
from marquee.streaming import ingest as stream

BASICS = DATASETS["title_basics"]


def message(table, **data):
    return {"table": table, "data": data}


def batch_of(spark, *payloads, first=0):
    rows = [(first + i, json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "id BIGINT, payload STRING")


def titles(n, first=0):
    return [message("title_basics", tconst=f"tt{first + i}", title_type="movie") for i in range(n)]


@pytest.fixture
def small_broadcasts(spark):
    """A broadcast of 2 MB or more fails, as larger ones do where memory is short."""
    spark.conf.set("spark.sql.maxBroadcastTableSize", "2m")
    yield
    spark.conf.unset("spark.sql.maxBroadcastTableSize")


def read_buckets(df):
    """The buckets that the plan's scan is limited to, None if it is not."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    found = re.findall(r"bucket#\d+ (?:IN \(([\d,]+)\)|= (\d+))", filters)
    return {int(n) for group in found for n in ",".join(group).split(",") if n} if found else None


def test_levels_follow_the_references():
    before = set()
    for level in LEVELS:
        for dataset in level:
            assert {parent for _, parent, _ in dataset.references} <= before
        before |= {d.table for d in level}
    assert before == set(DATASETS) and [len(x) for x in LEVELS] == [2, 5]


def test_small_batch_reads_its_buckets_only(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    stream.consume(batch_of(spark, *titles(500)), 0, store)
    count = buckets.buckets(store)
    everything = stream.landed(store, BASICS, "main", 1, 0, inclusive=False)
    assert read_buckets(everything) is None
    assert everything.select("bucket").distinct().count() == count == buckets.BUCKETS
    monkeypatch.setattr(buckets, "BUCKETS", 7)  # a store keeps its own number
    assert buckets.buckets(store) == count

    keys = spark.createDataFrame([("tt3",), (None,)], "tconst STRING")
    within = buckets.touched_buckets(keys, ["tconst"], count, 2)
    assert len(within) == 1
    one = stream.landed(store, BASICS, "main", 1, 0, inclusive=False, within=within)
    assert read_buckets(one) == set(within)
    assert one.filter("tconst = 'tt3'").count() == 1
    assert buckets.touched_buckets(keys, ["tconst"], count, 10**6) is None

    read = []
    real = stream.landed
    monkeypatch.setattr(stream, "landed", lambda *a, **k: read.append(k["within"]) or real(*a, **k))
    again = batch_of(spark, *titles(1, 3), message("title_ratings", tconst="tt3", num_votes=1), first=900)
    stream.consume(again, 1, store)
    assert read and all(len(numbers) == 1 for numbers in read)
    assert stream.table(spark, store.root, "title_basics").count() == 500
    assert stream.table(spark, store.root, "title_ratings").count() == 1


def test_parents_and_children_in_one_batch(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = [
        message("title_principals", tconst="tt1", ordering=1, nconst="nm1"),
        message("title_episode", tconst="tt1", parent_tconst="tt2"),
        message("title_crew", tconst="tt1", directors=["nm1"]),
        message("title_akas", title_id="tt1", ordering=1),
        message("title_ratings", tconst="tt1", num_votes=1),
        message("name_basics", nconst="nm1"),
        *titles(2, 1),
    ]
    stream.consume(batch_of(spark, *rows), 0, store)
    assert {t: stream.table(spark, store.root, t).count() for t in DATASETS} == {
        t: 2 if t == "title_basics" else 1 for t in DATASETS
    }
    assert {r.outcome for r in stream.outcome_log(store).collect()} == {"ack"}


def test_tables_of_a_wave_fail_apart(spark, tmp_path):
    store = Store(spark, str(tmp_path))

    def write(df, name, run):
        if name.endswith(("title_crew", "title_akas")):
            raise OSError("disk full")
        store.write_run(df, name, run)

    rows = [
        *titles(1, 1),
        message("title_crew", tconst="tt1"),
        message("title_akas", title_id="tt1", ordering=1),
        message("title_ratings", tconst="tt1", num_votes=1),
    ]
    stream.consume(batch_of(spark, *rows), 0, store, write=write)
    found = {(r.table_name, r.outcome) for r in stream.outcome_log(store).collect()}
    assert found == {
        ("title_basics", "ack"), ("title_ratings", "ack"), ("title_crew", "retry"), ("title_akas", "retry")
    }


def contents(spark, store):
    tables = {t: sorted(map(str, stream.table(spark, store.root, t).collect())) for t in DATASETS}
    outcomes = sorted(map(str, stream.outcome_log(store).collect()))
    return tables, outcomes, sorted(map(str, ingest.event_log(store).collect())), ingest.in_flight(store)


def loaded(spark, root):
    store = Store(spark, root)
    for epoch in range(3):
        rating = message("title_ratings", tconst=f"tt{10 * epoch}", num_votes=epoch)
        rows = [*titles(10, 10 * epoch), rating, message("nope")]
        stream.consume(batch_of(spark, *rows, first=100 * epoch), epoch, store)
    return store


def test_compaction_changes_files_only(spark, tmp_path):
    store = loaded(spark, str(tmp_path))
    before, old = contents(spark, store), stream.table(spark, store.root, "title_basics")
    count = lambda: len(stream.table(spark, store.root, "title_basics").inputFiles())
    outcome_files = len(stream.outcome_log(store).inputFiles())
    assert compaction.compact(spark, store.root) == 1
    assert contents(spark, store) == before
    assert len(stream.outcome_log(store).inputFiles()) < outcome_files
    assert old.count() == 30  # a reader that began before
    assert compaction.compact(spark, store.root) == 2
    assert contents(spark, store) == before
    assert count() <= 64
    # The last batch can still be repeated, and the next one comes.
    rows = [*titles(10, 20), message("title_ratings", tconst="tt20", num_votes=2), message("nope")]
    stream.consume(batch_of(spark, *rows, first=200), 2, store)
    assert [len(x) for x in contents(spark, store)[:3]] == [len(x) for x in before[:3]]
    stream.consume(batch_of(spark, *titles(5, 28), first=500), 3, store)
    assert stream.table(spark, store.root, "title_basics").count() == 33
    assert stream.purge_produced(spark, store.root) == 0


def test_compaction_that_breaks_off_is_repeated(spark, tmp_path, monkeypatch):
    store = loaded(spark, str(tmp_path))
    before = contents(spark, store)

    def broken(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(Store, "publish_generation", broken)
        with pytest.raises(KeyboardInterrupt):
            compaction.compact(spark, store.root)
    assert store.generation() == 0 and contents(spark, store) == before
    stream.consume(batch_of(spark, *titles(1, 99), first=900), 3, store)
    assert compaction.compact(spark, store.root) == 1
    assert stream.table(spark, store.root, "title_basics").count() == 31


def test_hot_bucket_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "ROWS_PER_FILE", 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(1000).select(F.lit(3).alias("bucket"), F.col("id").cast("string").alias("tconst"))
    buckets.spread(rows, ["bucket"], ["tconst"], 1000).write.partitionBy("bucket").parquet(f"{tmp_path}/t")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spark.read.parquet(f"{tmp_path}/t").inputFiles()) > 1


def test_large_batch_broadcasts_no_outcomes(spark, tmp_path, small_broadcasts):
    store, n = Store(spark, str(tmp_path)), 110_000
    orphan = """concat('{"table":"title_ratings","data":{"tconst":"tt', id, '","average_rating":"5.0","num_votes":1}}')"""
    batch = spark.range(2 * n).selectExpr("id", f"IF(id % 2 = 0, '[1]', {orphan}) AS payload")
    stream.consume(batch, 0, store)
    outcomes = {r.outcome: r["count"] for r in stream.outcome_log(store).groupBy("outcome").count().collect()}
    assert outcomes == {"permanent": n, "retry": n}
    rejected = store.read("rejected", stream.REJECTED)
    assert rejected.filter("payload = '[1]' AND id % 2 = 0").select("id").distinct().count() == n == rejected.count()
    waiting = store.read("waiting", stream.WAITING).filter("id IS NOT NULL")
    assert waiting.filter("id % 2 = 1").select("id").distinct().count() == n == waiting.count()


def test_large_batch_broadcasts_no_keys(spark, tmp_path, small_broadcasts):
    store, n = Store(spark, str(tmp_path)), 110_000
    title = """concat('{"table":"title_basics","data":{"tconst":"tt', id div 2, '","title_type":"movie"}}')"""
    rating = """concat('{"table":"title_ratings","data":{"tconst":"tt', id div 2, '","average_rating":"5.0","num_votes":1}}')"""
    batch = spark.range(2 * n).selectExpr("id", f"IF(id % 2 = 0, {title}, {rating}) AS payload")
    for epoch in (0, 1):  # the second time all keys are there
        stream.consume(batch, epoch, store)
        assert [r.outcome for r in stream.outcome_log(store).select("outcome").distinct().collect()] == ["ack"]
        for name in ("title_basics", "title_ratings"):
            assert stream.table(spark, str(tmp_path), name).count() == n
