"""Dumps to messages to tables, on files with the format's odd corners."""

import gzip
import json
import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from marquee.operators import relational as rel
from marquee.plans import ingest
from marquee.schemas import DATASETS
from marquee.sources import layout, manifest, tsv
from marquee.sources.store import Store
from marquee.streaming import ingest as stream
from marquee.streaming.produce import run_produce

NOW = datetime(2024, 1, 1)

BASICS = [
    "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\textra",
    'tt1\tmovie\tSay "Hi"\tOne\t0\t2001\t\\N\t90\tDrama,,Comedy,\tx',
    "tt2\tmovie\tTwo\t\t1\t\\N\t\\N\t\\N\t\\N",
    "",
    "bad\tmovie\tThree\tThree\t0\t2001\t\\N\t90\tDrama",
    "tt4\tmovie\tFour\tFour\tmaybe\t19x5\t\\N\t90\tDrama",
    "tt5\tmovie",
    "tt6\tmovie\tSix\tSix\t0\t2001\t\\N\t99999999999\tDrama\tx\ty",
    "tt7\ttvSeries\tSeven\tSeven\t0\t2001\t\\N\t90\t",
]
RATINGS = ["averageRating\ttconst\tnumVotes", "8.25\ttt1\t10", "11.0\ttt2\t1", "NaN\ttt5\t1", "5.0\ttt404\t1"]
EPISODES = ["tconst\tparentTconst\tseasonNumber\tepisodeNumber", "tt2\ttt7\t1\t1", "tt5\t\\N\t1\t2"]


def write(folder, name, lines):
    data = ("\n".join(lines) + "\n").encode()
    path = os.path.join(folder, name)
    with (gzip.open if name.endswith(".gz") else open)(path, "wb") as out:
        out.write(data)
    return path


@pytest.fixture
def dumps(tmp_path):
    folder = str(tmp_path / "dumps")
    os.mkdir(folder)
    write(folder, "title.basics.tsv.gz", BASICS)
    write(folder, "title.ratings.tsv", RATINGS)
    return folder


def queued(spark, root):
    rows = Store(spark, root).read("produced", ingest.PRODUCED).filter("NOT refused")
    messages = sorted((r.id, json.loads(r.payload)) for r in rows.collect())
    return {(m["table"], m["data"]["tconst"]): m["data"] for _, m in messages}


def test_read_tsv_keeps_fields_as_they_are(spark, dumps):
    rows = tsv.read_tsv(spark, f"{dumps}/title.basics.tsv.gz", DATASETS["title_basics"], 3)
    by_line = {r.source_line: r for r in rows.collect()}
    assert sorted(by_line) == [2, 3, 4, 5, 6, 7, 8]  # blank lines are not counted
    assert by_line[2].primaryTitle == 'Say "Hi"' and by_line[2].genres == "Drama,,Comedy,"
    assert by_line[3].originalTitle == "" and by_line[3].startYear == "\\N"
    assert by_line[6].primaryTitle is None and by_line[6].genres is None
    assert by_line[8].source_file == "title.basics.tsv.gz" and by_line[8].genres == ""


def test_line_numbers_across_splits(spark, tmp_path):
    lines = [RATINGS[0]] + [f"5.0\ttt{i}\t{i}" for i in range(2, 30_000)]
    write(str(tmp_path), "title.ratings.tsv", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        rows = tsv.read_tsv(spark, f"{tmp_path}/title.ratings.tsv", DATASETS["title_ratings"])
        assert tsv._lines(spark, f"{tmp_path}/title.ratings.tsv").rdd.getNumPartitions() > 10
        wrong = rows.filter(F.col("tconst") != F.concat(F.lit("tt"), F.col("source_line")))
        assert rows.count() == 29_998 and wrong.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_missing_headers_raise(spark, tmp_path):
    path = write(str(tmp_path), "title.ratings.tsv", ["tconst\tvotes", "tt1\t1"])
    with pytest.raises(ValueError, match="missing headers: averageRating, numVotes"):
        tsv.read_tsv(spark, path, DATASETS["title_ratings"])


def test_select_sources(caplog):
    names = ["title.basics.tsv", "title.basics.tsv.gz", "title.crew.tsv"]
    picked = tsv.select_sources(names)
    assert [n for _, n in picked] == ["title.basics.tsv.gz", "title.crew.tsv"]
    assert "title.ratings.tsv.gz" in caplog.text
    assert [n for _, n in tsv.select_sources(names, ["title_crew"])] == ["title.crew.tsv"]
    assert [n for _, n in tsv.select_sources(names, ["title.basics.tsv"])] == ["title.basics.tsv.gz"]
    with pytest.raises(ValueError, match="unknown file/table selectors: nope"):
        tsv.select_sources(names, ["nope"])


def test_produce_writes_messages_and_dead_letters(spark, dumps, tmp_path):
    root = str(tmp_path / "store")
    done = ingest.produce(spark, dumps, root, NOW, provenance=True)
    assert [(d.table, d.enqueued, d.malformed, d.completed) for d in done] == [
        ("title_basics", 4, 3, True), ("title_ratings", 2, 2, True)
    ]
    store = Store(spark, root)
    messages = queued(spark, root)
    assert len(messages) == 6
    first = messages["title_basics", "tt1"]
    assert first["genres"] == ["Drama", "Comedy"] and first["is_adult"] is False
    assert first["metadata"] == {"source_file": "title.basics.tsv.gz", "source_line": 2}
    assert messages["title_basics", "tt5"]["genres"] is None
    assert messages["title_ratings", "tt1"]["average_rating"] == 8.3
    dead = {(r.source_file, r.source_line): r.reason for r in ingest.dead_letter_log(store).collect()}
    assert dead == {
        ("title.basics.tsv.gz", 4): "invalid tconst: 'bad'",
        ("title.basics.tsv.gz", 5): "invalid boolean: 'maybe'",
        ("title.basics.tsv.gz", 7): "invalid integer: '99999999999'",
        ("title.ratings.tsv", 3): "invalid rating: '11.0'",
        ("title.ratings.tsv", 4): "invalid rating: 'NaN'",
    }
    assert ingest.produce(spark, dumps, root, NOW) == []  # both complete
    events = {r.source_file: json.loads(r.payload) for r in ingest.event_log(store).collect()}
    assert events["title.ratings.tsv"] == {
        "table": "title_ratings", "run_enqueued": 2, "run_malformed": 2, "total_enqueued": 2, "completed": True
    }


def test_produce_resumes_after_the_cap(spark, dumps, tmp_path):
    root = str(tmp_path / "store")
    runs = [ingest.produce(spark, dumps, root, NOW, ["title_basics"], max_rows=n) for n in (2, 1, 5)]
    assert [(r[0].enqueued, r[0].malformed, r[0].completed) for r in runs] == [
        (2, 0, False), (1, 2, False), (1, 1, True)
    ]
    assert [t for _, t in queued(spark, root)] == ["tt1", "tt2", "tt5", "tt7"]
    progress = Store(spark, root).snapshot("progress", ingest.PRODUCER_PROGRESS)[0].head()
    assert (progress.last_line, progress.rows_enqueued, progress.malformed_rows) == (8, 4, 3)


def test_changed_source_raises_until_restarted(spark, dumps, tmp_path):
    root = str(tmp_path / "store")
    ingest.produce(spark, dumps, root, NOW, ["title_ratings"])
    write(dumps, "title.ratings.tsv", RATINGS + ["6.0\ttt7\t3"])
    with pytest.raises(ValueError, match="changed"):
        ingest.produce(spark, dumps, root, NOW, ["title_ratings"])
    again = ingest.produce(spark, dumps, root, NOW, ["title_ratings"], restart=True)
    assert again[0].enqueued == 3 and len(queued(spark, root)) == 3
    ids = Store(spark, root).read("produced", ingest.PRODUCED).select("id")
    assert ids.count() == ids.distinct().count()  # queued again under ids of their own


def test_repeated_run_replaces_its_messages(spark, dumps, tmp_path, monkeypatch):
    root = str(tmp_path / "store")

    def crash(*_):
        raise OSError("lost before progress was kept")

    with monkeypatch.context() as patch:
        patch.setattr(manifest, "upsert_progress", crash)
        with pytest.raises(OSError):
            ingest.produce(spark, dumps, root, NOW, ["title_basics"])
    ingest.produce(spark, dumps, root, NOW, ["title_ratings"])
    ingest.produce(spark, dumps, root, NOW, ["title_basics"])
    rows = Store(spark, root).read("produced", ingest.PRODUCED)
    assert rows.count() == 11 and rows.select("id").distinct().count() == 11
    assert ingest.dead_letter_log(Store(spark, root)).count() == 5


def test_watching_a_folder(spark, dumps, tmp_path):
    root, checkpoint = str(tmp_path / "store"), str(tmp_path / "cp")
    run_produce(spark, dumps, root, checkpoint).awaitTermination()
    assert len(queued(spark, root)) == 6
    write(dumps, "title.episode.tsv", EPISODES)
    write(dumps, "notes.txt", ["not a dump"])
    run_produce(spark, dumps, root, checkpoint).awaitTermination()
    assert len(queued(spark, root)) == 7


def test_manifest_and_reset(spark, dumps):
    files = manifest.scan_manifest(spark, dumps)
    assert {r.source_file for r in files.collect()} == {"title.basics.tsv.gz", "title.ratings.tsv"}
    progress = spark.createDataFrame(
        [("a", "t", 1, 1, 5, 4, 0, True, NOW), ("b", "t", 1, 1, 5, 4, 0, True, NOW)], ingest.PRODUCER_PROGRESS
    )
    assert [r.source_file for r in manifest.reset_progress(progress, ["a"]).collect()] == ["b"]


def consume_all(spark, root, tmp_path, **kw):
    messages = stream.produced_messages(spark, root, kw.pop("files", None))
    query = stream.run_ingest(messages, root, str(tmp_path / "checkpoint"), **kw)
    query.awaitTermination()


def outcomes(spark, root):
    rows = Store(spark, root).read("outcomes", stream.OUTCOMES).collect()
    return sorted((r.table_name, r.outcome, r.attempts) for r in rows)


def test_dumps_to_tables(spark, dumps, tmp_path):
    root = str(tmp_path / "store")
    write(dumps, "title.episode.tsv", EPISODES)
    ingest.produce(spark, dumps, root, NOW)
    consume_all(spark, root, tmp_path)
    titles = stream.table(spark, root, "title_basics")
    assert titles.schema == DATASETS["title_basics"].schema
    assert sorted(r.tconst for r in titles.collect()) == ["tt1", "tt2", "tt5", "tt7"]
    rated = stream.table(spark, root, "title_ratings").collect()
    assert [(r.tconst, str(r.average_rating), r.num_votes) for r in rated] == [("tt1", "8.3", 10)]
    assert stream.table(spark, root, "title_episode").count() == 1
    assert ("title_ratings", "retry", 1) in outcomes(spark, root)  # tt404 has no title yet

    kinds = {r.event_type for r in ingest.event_log(Store(spark, root)).collect()}
    assert kinds == {"producer_file_checkpoint", "consumer_batch_complete"}

    # A second run without news does nothing; the parent arriving lets the orphan in.
    consume_all(spark, root, tmp_path)
    assert titles.count() == 4
    write(dumps, "title.basics.tsv.gz", BASICS + ["tt404\tmovie\tLate\tLate\t0\t2001\t\\N\t90\t\\N"])
    ingest.produce(spark, dumps, root, NOW, ["title_basics"], restart=True)
    consume_all(spark, root, tmp_path)
    assert stream.table(spark, root, "title_basics").count() == 5
    assert stream.table(spark, root, "title_ratings").count() == 2
    assert ("title_ratings", "ack", 2) in outcomes(spark, root)


def batch_of(spark, *payloads):
    rows = [(i, json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "id BIGINT, payload STRING")


def rating(tconst, votes):
    return {"table": "title_ratings", "data": {"tconst": tconst, "average_rating": 5, "num_votes": votes}}


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_repeated_batch_changes_nothing(spark, tmp_path, monkeypatch, broadcast_rows):
    monkeypatch.setattr(rel, "BROADCAST_ROWS", broadcast_rows)
    store = Store(spark, str(tmp_path))
    batch = batch_of(spark, rating("tt1", 1), rating("tt1", 2), rating("tt2", 3), {"table": "x"})
    later = batch_of(spark, rating("tt2", 9), rating("tt3", 4))
    for epoch, frame in ((0, batch), (1, later), (1, later)):
        stream.consume(frame, epoch, store, references=False)
    landed = stream.table(spark, store.root, "title_ratings").collect()
    assert sorted((r.tconst, r.num_votes) for r in landed) == [("tt1", 1), ("tt2", 3), ("tt3", 4)]
    assert [o[1] for o in outcomes(spark, store.root)].count("ack") == 5
    with pytest.raises(ValueError, match="new checkpoint"):
        stream.consume(batch, 0, store, references=False)


def test_one_failing_table_does_not_stop_the_others(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    crew = {"table": "title_crew", "data": {"tconst": "tt1", "directors": ["nm1"]}}

    def write_run(df, name, run):
        if name.endswith("title_ratings"):
            raise OSError("disk full")
        store.write_run(df, name, run)

    batch = batch_of(spark, rating("tt1", 1), crew)
    at = F.lit("2024-01-01 00:00:00")
    stream.consume(batch, 0, store, references=False, write=write_run, as_of=at)
    assert stream.table(spark, store.root, "title_crew").count() == 1
    assert outcomes(spark, store.root) == [("title_crew", "ack", 1), ("title_ratings", "retry", 1)]
    stream.consume(batch.limit(0), 1, store, references=False, as_of=at)
    assert stream.table(spark, store.root, "title_ratings").isEmpty()  # not due yet
    later = F.lit("2024-01-01 00:00:01")
    stream.consume(batch.limit(0), 2, store, references=False, as_of=later)
    assert stream.table(spark, store.root, "title_ratings").count() == 1


def test_messages_fail_after_five_attempts(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    batch = batch_of(spark, rating("tt1", 1))
    for epoch in range(6):
        at = F.lit(NOW + timedelta(hours=epoch))
        stream.consume(batch if epoch == 0 else batch.limit(0), epoch, store, as_of=at)
    assert outcomes(spark, store.root) == [
        *(("title_ratings", "failed", 5),), *(("title_ratings", "retry", n) for n in (1, 2, 3, 4))
    ]


def test_retries_need_no_new_input(spark, dumps, tmp_path):
    root = str(tmp_path / "store")
    ingest.produce(spark, dumps, root, NOW)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    consume_all(spark, root, tmp_path, as_of=F.lit(start))
    due = stream.retry_due(spark, root, as_of=start)
    assert due == start + timedelta(seconds=1)  # too early: nothing ran
    waits = [1]
    while due is not None:  # no parent ever comes
        now, due = due, stream.retry_due(spark, root, as_of=due)
        waits += [(due - now).total_seconds()] if due else []
    assert waits == [1, 2, 4, 8]
    ratings = [o for o in outcomes(spark, root) if o[0] == "title_ratings" and o[1] != "ack"]
    wanted = [("title_ratings", "failed", 5), *(("title_ratings", "retry", n) for n in (1, 2, 3, 4))]
    assert [o for o in ratings if o[1] != "permanent"] == wanted
    assert stream.retry_due(spark, root) is None
    # The stream goes on after the rounds, and repeating its last batch leaves them alone.
    before = stream.table(spark, root, "title_basics").count()
    write(dumps, "title.basics.tsv.gz", BASICS + ["tt404\tmovie\tLate\tLate\t0\t2001\t\\N\t90\t\\N"])
    ingest.produce(spark, dumps, root, NOW, ["title_basics"], restart=True)
    consume_all(spark, root, tmp_path)
    assert stream.table(spark, root, "title_basics").count() == before + 1


def test_drain_lands_a_late_parent(spark, tmp_path):
    store, slept = Store(spark, str(tmp_path)), []
    title = {"table": "title_basics", "data": {"tconst": "tt1", "title_type": "movie"}}
    stream.consume(batch_of(spark, rating("tt1", 1)), 0, store)

    def parent_comes(seconds):
        if not slept:
            parent = spark.createDataFrame([(9, json.dumps(title))], "id BIGINT, payload STRING")
            stream.consume(parent, 0, store, run="other")
        slept.append(seconds)
        time.sleep(seconds)

    stream.drain(spark, store.root, sleep=parent_comes)
    assert stream.table(spark, store.root, "title_ratings").count() == 1
    assert stream.table(spark, store.root, "title_basics").count() == 1


def test_broken_off_batch_goes_first(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    batch = batch_of(spark, rating("tt1", 1))
    stream.consume(batch, 0, store)

    def broken(df, name, run):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        stream.consume(batch_of(spark, rating("tt2", 1)), 1, store, references=False, write=broken)
    with pytest.raises(ValueError, match="not finished"):
        stream.retry_due(spark, store.root)


def test_production_pauses_at_high_water_and_resumes_at_low(spark, dumps, tmp_path):
    root, store = str(tmp_path / "store"), Store(spark, str(tmp_path / "store"))
    marks = ingest.Marks(3, 0)
    shape = lambda runs: [(r.table, r.enqueued, r.completed) for r in runs]
    assert shape(ingest.produce(spark, dumps, root, NOW, marks=marks)) == [("title_basics", 3, False)]
    assert ingest.in_flight(store) == 3
    assert ingest.produce(spark, dumps, root, NOW, marks=marks) == []
    consume_all(spark, root, tmp_path)
    assert ingest.in_flight(store) == 0
    assert shape(ingest.produce(spark, dumps, root, NOW, marks=marks)) == [
        ("title_basics", 1, True), ("title_ratings", 2, True)
    ]
    write(dumps, "title.episode.tsv", EPISODES)
    assert ingest.produce(spark, dumps, root, NOW, marks=marks) == []
    consume_all(spark, root, tmp_path)
    assert ingest.in_flight(store) == 1  # the orphan waits
    assert ingest.produce(spark, dumps, root, NOW, marks=marks) == []  # below high, not yet at low
    assert shape(ingest.produce(spark, dumps, root, NOW, marks=ingest.Marks(3, 1))) == [
        ("title_episode", 1, True)
    ]
    with pytest.raises(ValueError, match="low water"):
        ingest.Marks(3, 3)


def test_production_waits_for_the_consumer(spark, dumps, tmp_path):
    root, waits = str(tmp_path / "store"), []

    def wait():
        waits.append(ingest.in_flight(Store(spark, root)))
        consume_all(spark, root, tmp_path)

    options = {"marks": ingest.Marks(2, 0), "wait": wait, "selectors": ["title_basics"]}
    runs = ingest.produce(spark, dumps, root, NOW, **options)
    assert [(r.enqueued, r.malformed, r.completed) for r in runs] == [(2, 0, False), (2, 3, True)]
    assert waits == [2]
    assert len(queued(spark, root)) == 4


def test_watching_with_marks_waits(spark, dumps, tmp_path):
    root = str(tmp_path / "store")
    wait = lambda: consume_all(spark, root, tmp_path, references=False)
    run_produce(
        spark, dumps, root, str(tmp_path / "cp"), wait=wait, marks=ingest.Marks(2, 1)
    ).awaitTermination()
    assert len(queued(spark, root)) == 6


def test_purge_keeps_what_is_needed(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    bad = {"table": "x"}
    for epoch in range(4):
        batch = batch_of(spark, rating(f"tt{epoch}", 1), bad)
        stream.consume(batch, epoch, store, references=False)
    stream.purge(store, range(0, 2))
    inbox = store.read("inbox", "id BIGINT, run STRING, epoch BIGINT, round INT, part STRING")
    assert sorted({r.epoch for r in inbox.collect()}) == [2, 3]
    stream.consume(batch, 3, store, references=False)  # the last batch can still be repeated
    assert stream.table(spark, store.root, "title_ratings").count() == 4
    assert len(outcomes(spark, store.root)) == 8
    rejected = store.read("rejected", stream.REJECTED).collect()
    assert [(json.loads(r.payload), r.outcome) for r in rejected] == [(bad, "permanent")] * 4
    with pytest.raises(ValueError, match="new checkpoint"):
        stream.consume(batch, 0, store, references=False)
    assert stream.retry_due(spark, store.root) is None


def test_stream_purges_as_it_goes(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "store")
    for part in range(5):
        batch_of(spark, rating(f"tt{part}", 1)).coalesce(1).write.mode("append").parquet(folder)
    messages = spark.readStream.schema("id BIGINT, payload STRING").option("maxFilesPerTrigger", 1).parquet(folder)
    query = stream.run_ingest(messages, root, str(tmp_path / "cp"), references=False, purge_every=2)
    query.awaitTermination()
    assert stream.table(spark, root, "title_ratings").count() == 5
    inbox = Store(spark, root).read("inbox", "id BIGINT, epoch BIGINT, round INT, part STRING")
    assert {r.epoch for r in inbox.collect()} == {3, 4}


def test_ended_producer_runs_are_purged(spark, dumps, tmp_path):
    root = str(tmp_path / "store")
    ingest.produce(spark, dumps, root, NOW)
    consume_all(spark, root, tmp_path)
    assert stream.purge_produced(spark, root) == 0  # the last batch may be repeated
    write(dumps, "title.episode.tsv", EPISODES)
    ingest.produce(spark, dumps, root, NOW)
    consume_all(spark, root, tmp_path, as_of=F.lit(NOW))  # the orphan is not due
    dead = ingest.dead_letter_log(Store(spark, root)).count()
    assert stream.purge_produced(spark, root) == 1
    assert sorted({table for table, _ in queued(spark, root)}) == ["title_episode", "title_ratings"]
    assert ingest.dead_letter_log(Store(spark, root)).count() == dead
    write(dumps, "title.crew.tsv", ["tconst\tdirectors\twriters", "tt1\tnm1\t\\N"])
    ingest.produce(spark, dumps, root, NOW)
    consume_all(spark, root, tmp_path)
    assert stream.table(spark, root, "title_crew").count() == 1


def test_faults_of_the_job_are_raised(spark, tmp_path):
    def wrong(df, name, run):
        raise TypeError("no such argument")

    with pytest.raises(TypeError):
        stream.consume(batch_of(spark, rating("tt1", 1)), 0, Store(spark, str(tmp_path)), references=False, write=wrong)


def test_streaming_lands_what_one_batch_would(spark, tmp_path):
    folder = str(tmp_path / "in")
    for part in range(4):
        rows = [(part * 100 + i, json.dumps(rating(f"tt{(part * 31 + i) % 120}", i))) for i in range(60)]
        spark.createDataFrame(rows, "id BIGINT, payload STRING").coalesce(1).write.mode("append").parquet(folder)
    messages = spark.readStream.schema("id BIGINT, payload STRING").option("maxFilesPerTrigger", 1).parquet(folder)
    root = str(tmp_path / "store")
    for _ in range(2):
        stream.run_ingest(messages, root, str(tmp_path / "cp"), references=False).awaitTermination()
    landed = stream.table(spark, root, "title_ratings")
    everything = spark.read.parquet(folder)
    keys = everything.select(F.get_json_object("payload", "$.data.tconst")).distinct().count()
    assert landed.count() == keys == landed.select("tconst").distinct().count()


def test_layouts(spark, tmp_path):
    titles = spark.createDataFrame(
        [(f"tt{i}", "movie" if i % 2 else "short", f"T{i}", 1990 + i % 5, i, [f"G{i % 3}", None]) for i in range(60)],
        "tconst STRING, title_type STRING, primary_title STRING, start_year INT, runtime_minutes INT, genres ARRAY<STRING>",
    )
    layout.write_movies(titles, str(tmp_path / "movies"))
    movies = spark.read.parquet(str(tmp_path / "movies"))
    assert movies.filter("start_year = 1991").count() == 6 and movies.count() == 30
    layout.write_by_runtime(titles, str(tmp_path / "runtime"))
    assert spark.read.parquet(str(tmp_path / "runtime")).count() == 30
    layout.write_top_votes(titles.selectExpr("tconst", "runtime_minutes * 100 AS num_votes", "1.0 AS average_rating"), str(tmp_path / "votes"))
    assert spark.read.parquet(str(tmp_path / "votes")).count() == 50
    credits = titles.selectExpr("tconst", "tconst AS nconst", "if(runtime_minutes < 7, 'actress', 'writer') AS category")
    layout.write_actors(credits, str(tmp_path / "actors"))
    assert spark.read.parquet(str(tmp_path / "actors")).count() == 7
    layout.write_inverted_index(titles, "genres", "tconst", str(tmp_path / "index"))
    assert spark.read.parquet(str(tmp_path / "index")).filter("value = 'G1'").count() == 20


def test_bucketed_episodes_group_without_a_shuffle(spark):
    episodes = spark.range(1000).select(
        F.concat(F.lit("tt"), "id").alias("tconst"),
        F.concat(F.lit("tt9"), F.col("id") % 20).alias("parent_tconst"),
        (F.col("id") % 4).cast("int").alias("season_number"),
        F.col("id").cast("int").alias("episode_number"),
    )
    spark.sql("DROP TABLE IF EXISTS episodes_by_series")
    layout.write_episodes(episodes, "episodes_by_series", buckets=4, slices=2)
    counts = spark.table("episodes_by_series").groupBy("parent_tconst").count()
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert counts.count() == 20
    spark.sql("DROP TABLE episodes_by_series")
