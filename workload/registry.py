"""Registered queries: name -> callable(spark, sf_dir) over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators import audit, normalize, queue
from marquee.operators import relational as rel
from marquee.plans import ingest, scenarios
from marquee.schemas import DATASETS
from marquee.session import shared_dir
from marquee.sources import layout, manifest, tsv
from marquee.sources.buckets import bucket_of, buckets, touched_buckets
from marquee.sources.queue_store import QueueStore
from marquee.sources.store import Store
from marquee.streaming import ingest as stream_ingest
from marquee.streaming import lifecycle
from workload.views import AS_OF, stream_view, table, view

Query = Callable[[SparkSession, str], DataFrame]


def _over(fn: Callable[..., DataFrame], *names: str) -> Query:
    """``fn`` applied to the named views."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(*(view(spark, sf_dir, name) for name in names))

    return run


def _scenarios() -> dict[str, Query]:
    titles = ("title_basics", "title_ratings")
    crew = ("title_crew", "title_basics", "name_basics", "title_ratings")
    cast = ("title_principals", "name_basics", "title_basics")
    episodes = ("title_episode", "title_basics", "title_ratings")
    return {
        "s1a_rating_by_genre": _over(scenarios.s1a, *titles),
        "s1b_rating_stddev": _over(scenarios.s1b, *titles),
        "s2a_top_votes": _over(scenarios.s2a, *titles),
        "s2b_top_votes": _over(scenarios.s2b, *titles),
        "s3a_directors": _over(scenarios.s3a, *crew),
        "s3b_directors_min5": _over(scenarios.s3b, *crew),
        "s4a_yearly": _over(scenarios.s4a, *titles),
        "s4b_yearly_median": _over(scenarios.s4b, *titles),
        "s5a_genre_breadth": _over(scenarios.s5a, *cast),
        "s5b_genre_breadth_top20": _over(scenarios.s5b, *cast),
        "s6a_seasons": _over(scenarios.s6a, *episodes),
        "s6b_max_season": _over(scenarios.s6b, *episodes),
        "s7a_genre_pairs": _over(scenarios.s7a, "title_basics"),
        "s7b_genre_pairs_rated": _over(scenarios.s7b, *titles),
        "s8a_longest_by_genre": _over(scenarios.s8a, *titles),
        "s8b_longest_by_genre": _over(scenarios.s8b, *titles),
    }


BASICS = DATASETS["title_basics"]
RATINGS = DATASETS["title_ratings"]
CREW = DATASETS["title_crew"]


def _classified(raw: DataFrame) -> DataFrame:
    return normalize.classify(raw, BASICS)


def _normalize_titles(raw: DataFrame) -> DataFrame:
    return normalize.accepted(_classified(raw)).drop("metadata")


def _normalize_dump(table_name: str) -> Query:
    """Every row of a dump: its typed columns, or why it is refused."""
    dataset = DATASETS[table_name]

    def run(raw: DataFrame) -> DataFrame:
        good = F.col("reason").isNull()
        typed = [
            F.when(good, F.col(f"record.{f.target}")).cast(
                "double" if f.converter == "rating" else f.type
            ).alias(f.target)
            for f in dataset.fields
        ]
        return normalize.classify(raw, dataset).select("source_line", *typed, "reason")

    return _over(run, f"raw_{table_name}")


def _dead_letters(raw: DataFrame) -> DataFrame:
    return normalize.dead_letters(_classified(raw), BASICS, "source_line")


def _provenance(raw: DataFrame) -> DataFrame:
    raw = raw.withColumn("source_file", F.lit(BASICS.filename))
    classified = normalize.classify(raw, BASICS, provenance=True)
    return normalize.accepted(classified).select("tconst", "metadata")


def _max_rows(raw: DataFrame) -> DataFrame:
    capped = tsv.up_to_accepted(_classified(raw), 500)
    return normalize.accepted(capped, "source_line").drop("metadata")


def _envelopes(title_basics: DataFrame) -> DataFrame:
    payloads = normalize.to_envelope(title_basics, "title_basics", "tconst")
    shape = "table STRING, data STRUCT<primary_title: STRING, start_year: STRING, genres: ARRAY<STRING>>"
    return payloads.select("tconst", F.from_json("payload", shape).alias("m")).select(
        "tconst",
        F.col("m.table").alias("table_name"),
        F.col("m.data.primary_title").alias("title"),
        F.col("m.data.start_year").alias("year"),
        F.coalesce(F.size("m.data.genres"), F.lit(-1)).cast("bigint").alias("genre_count"),
    )


def _progress_upsert(source_manifest: DataFrame, producer_progress: DataFrame) -> DataFrame:
    finished = source_manifest.filter(F.col("source_size_bytes") > 1010).select(
        "source_file",
        "table_name",
        "source_size_bytes",
        "source_mtime_ns",
        F.lit(5000).cast("bigint").alias("last_line"),
        F.lit(4999).cast("bigint").alias("rows_enqueued"),
        F.lit(0).cast("bigint").alias("malformed_rows"),
        F.lit(True).alias("completed"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("updated_at"),
    )
    return manifest.upsert_progress(producer_progress, finished)


def _progress_reset(source_manifest: DataFrame, producer_progress: DataFrame) -> DataFrame:
    status = manifest.manifest_status(source_manifest, producer_progress)
    return manifest.reset_progress(producer_progress, status.filter(F.col("status") == "changed"))


def _route(messages: DataFrame) -> DataFrame:
    return normalize.route(messages).select("id", "table_name", "reason")


def _route_repeated(messages: DataFrame) -> DataFrame:
    """Messages whose objects name two tables: the last one counts."""
    twice = F.regexp_replace("payload", r'^\{"table"', '{"table":"title_akas","table"')
    return _route(messages.withColumn("payload", twice))


def _normalize_ratings(messages: DataFrame) -> DataFrame:
    rows = normalize.normalize_messages(messages)
    routed = ~F.coalesce(F.col("reason").rlike("^(payload|unsupported)"), F.lit(False))
    good = F.col("reason").isNull()
    return rows.filter(routed & (F.col("table_name") == "title_ratings")).select(
        "id",
        F.when(good, F.col("record.tconst")).alias("tconst"),
        F.when(good, F.col("record.average_rating").cast("double")).alias("average_rating"),
        F.when(good, F.col("record.num_votes")).alias("num_votes"),
        "reason",
    )


def _ratings(messages: DataFrame) -> DataFrame:
    return normalize.accepted_messages(normalize.normalize_messages(messages), RATINGS, "id")


def _normalize_crew(messages: DataFrame) -> DataFrame:
    rows = normalize.accepted_messages(normalize.normalize_messages(messages), CREW, "id")
    return rows.select("id", "tconst", "directors")


def _outcomes(messages: DataFrame) -> DataFrame:
    return ingest.outcomes(normalize.normalize_messages(messages))


def _rejected(messages: DataFrame) -> DataFrame:
    return _outcomes(messages).filter(F.col("outcome") == "permanent").select("id", "reason")


def _fanout(messages: DataFrame) -> DataFrame:
    done = _outcomes(messages).filter(F.col("outcome") == "ack")
    return done.groupBy("table_name").agg(F.count("*").alias("accepted"))


def _first_wins(messages: DataFrame, title_ratings: DataFrame) -> DataFrame:
    first = rel.first_per_key(_ratings(messages), RATINGS.key, ["id"])
    fresh = rel.without_existing(first, title_ratings, RATINGS.key)
    return fresh.select(
        "tconst", F.col("average_rating").cast("double").alias("average_rating"), "num_votes"
    )


def _land_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``upsert_first_wins`` against ratings stored by buckets of their key."""
    store = Store(spark, shared_dir(spark, "land"))
    count = buckets(store)
    held = view(spark, sf_dir, "title_ratings").withColumn("metadata", F.lit("{}"))
    held = held.withColumn("bucket", bucket_of(RATINGS.key, count))
    store.write_run(held, "tables/title_ratings", "gen=0/run=seed/epoch=0/round=0")
    batch = _ratings(view(spark, sf_dir, "ingest_messages"))
    rows = batch.count()
    within = touched_buckets(batch, RATINGS.key, count, rows)
    target = stream_ingest.landed(store, RATINGS, "main", 0, 0, inclusive=False, within=within)
    fresh, _ = ingest.land(batch, RATINGS, target, rows=rows)
    return fresh.select(
        "tconst", F.col("average_rating").cast("double").alias("average_rating"), "num_votes"
    )


def _dedupe(principals: DataFrame) -> DataFrame:
    return rel.first_per_key(principals, ["tconst", "ordering"], ["nconst", "category"])


def _references(principals, basics, names):
    return rel.split_orphans(
        principals, [("tconst", basics, "tconst"), ("nconst", names, "nconst")]
    )


def _audit(message_queue: DataFrame, principals: DataFrame) -> DataFrame:
    checks = audit.queue_checks() | {
        "failed_has_time": (F.col("status") != "failed") | F.col("failed_at").isNotNull()
    }
    return audit.constraint_audit(
        [
            audit.check_violations(message_queue, ["id"], checks),
            audit.duplicate_keys(message_queue, ["id"], "message_queue_pk"),
            audit.duplicate_keys(principals, ["tconst", "ordering"], "title_principals_natural"),
        ]
    )


def _batch_event(messages: DataFrame) -> DataFrame:
    return ingest.batch_event(_outcomes(messages), F.lit(AS_OF).cast("timestamp_ntz"))


def _audit_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``constraint_audit`` over two batches: kept violations, and touched buckets grouped again."""
    store = Store(spark, shared_dir(spark, "audit"))
    checks = audit.queue_checks() | {
        "failed_has_time": (F.col("status") != "failed") | F.col("failed_at").isNotNull()
    }
    audits = []
    for name, key, constraint, late, checked in (
        ("message_queue", ["id"], "message_queue_pk", F.col("id") % 3 == 0, checks),
        ("title_principals", ["tconst", "ordering"], "title_principals_natural", F.col("ordering") > 3, {}),
    ):
        count = buckets(store)
        rows = view(spark, sf_dir, name).withColumn("bucket", bucket_of(key, count))
        schema, kept = f"{_columns(rows)}, batch INT", None
        for number, part in enumerate((~late, late)):
            batch = rows.filter(part)
            store.write_run(batch, name, f"batch={number}")
            batch = store.read(f"{name}/batch={number}", rows.schema)
            if checked:  # a row's checks hang on no other row
                audits.append(audit.check_violations(batch, key, checked))
            held = store.read(name, schema)
            if kept is None:
                found = audit.bucket_duplicates(held, key, constraint)
            else:
                touched = touched_buckets(batch, key, count, batch.count())
                found = audit.renewed_duplicates(kept, held, touched, key, constraint)
            store.write_snapshot(found, f"kept/{name}", number + 1)
            kept = store.snapshot(f"kept/{name}", audit.KEPT)[0]
        audits.append(kept.drop("bucket"))
    return audit.constraint_audit(audits)


def _columns(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def _stats_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the ratings in four batches, stored and merged, beside the exact ones."""
    ratings = view(spark, sf_dir, "title_ratings")
    store = Store(spark, shared_dir(spark, "stats"))
    batches = ratings.withColumn("batch", F.pmod(F.xxhash64("tconst"), F.lit(4)))
    store.write_run(audit.batch_stats(batches, "batch"), "ratings", "of=all")
    stored = spark.read.parquet(store.path("ratings/of=all"))
    merged = audit.merged_stats(stored, "batch")
    exact = audit.column_stats(ratings, exact=True).select(
        "column", F.col("distinct_values").alias("exact")
    )
    off = F.abs(F.col("distinct_values") - F.col("exact"))
    return merged.join(exact, "column").select(
        "column", "rows", "nulls", "smallest", "largest", (off <= 0.08 * F.col("exact")).alias("near")
    )


def _events_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return ingest.events_latest(events, "error", 20, at="ts", key="event_id").select(
        "event_type", "event_id", "ts"
    )


def _ingestion() -> dict[str, Query]:
    raw, messages = "raw_title_basics", "ingest_messages"
    parents = ("title_principals", "title_basics", "name_basics")
    progress = ("source_manifest", "producer_progress")
    return {
        "normalize_titles": _over(_normalize_titles, raw),
        **{f"normalize_{t}": _normalize_dump(t) for t in DATASETS if t != "title_basics"},
        "dead_letter_titles": _over(_dead_letters, raw),
        "provenance": _over(_provenance, raw),
        "ingest_max_rows": _over(_max_rows, raw),
        "envelope_titles": _over(_envelopes, "title_basics"),
        "manifest_status": _over(manifest.manifest_status, *progress),
        "progress_upsert": _over(_progress_upsert, *progress),
        "progress_reset": _over(_progress_reset, *progress),
        "route_messages": _over(_route, messages),
        "route_duplicate_keys": _over(_route_repeated, messages),
        "normalize_messages": _over(_normalize_ratings, messages),
        "normalize_crew_messages": _over(_normalize_crew, messages),
        "rejected_messages": _over(_rejected, messages),
        "fanout_counts": _over(_fanout, "catalog_messages"),
        "upsert_first_wins": _over(_first_wins, messages, "title_ratings"),
        "land_pruned": _land_pruned,
        "dedupe_principals": _over(_dedupe, "title_principals"),
        "orphans_principals": _over(lambda *t: _references(*t)[1], *parents),
        "insertable_principals": _over(lambda *t: _references(*t)[0], *parents),
        "constraint_audit": _over(_audit, "message_queue", "title_principals"),
        "constraint_audit_delta": _audit_delta,
        "batch_event": _over(_batch_event, messages),
        "events_latest": _events_latest,
    }


def _enqueue(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("role").alias("queue_name"),
        F.when(F.col("text").isNotNull(), F.to_json(F.struct("text"))).alias("payload"),
    )
    return queue.enqueue(turns, AS_OF, view(spark, sf_dir, "message_queue"))[0]


def _ack(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return queue.ack(view(spark, sf_dir, "message_queue"), ids, AS_OF)


def _nack(message_queue: DataFrame, ops: DataFrame) -> DataFrame:
    reasons = ops.select(F.col("seq").alias("id"), "reason")
    return queue.nack(message_queue, reasons, AS_OF)


def _stored_queue(spark: SparkSession, sf_dir: str) -> QueueStore:
    """A stored queue after every transition: each reads, changes and writes the table."""
    queued = QueueStore(Store(spark, shared_dir(spark, "queue")))
    queued.load(view(spark, sf_dir, "message_queue"))
    turns = table(spark, sf_dir, "conversations").select(
        (-1 - (F.col("conv_id") * 1000 + F.col("turn"))).alias("id"),
        F.col("role").alias("queue_name"),
        F.when(F.col("text").isNotNull(), F.to_json(F.struct("text"))).alias("payload"),
    )
    queued.enqueue(turns, AS_OF)
    claimed = queued.dequeue("q1", AS_OF, n=100).select(F.col("msg_id").alias("id"))
    queued.ack(claimed.filter("id % 2 = 0"), AS_OF)
    why = F.when(F.col("id") % 3 == 0, F.lit("[permanent] bad")).otherwise(F.lit("boom"))
    queued.nack(claimed.filter("id % 2 <> 0").withColumn("reason", why), AS_OF)
    queued.compact()
    queued.purge("q1", AS_OF)
    return queued


TIMES = (
    "created_at", "updated_at", "available_at", "processing_started_at", "completed_at",
    "failed_at", "oldest_pending_at",
)


def _plain_times(df: DataFrame) -> DataFrame:
    times = {c: F.col(c).cast("timestamp_ntz") for c in TIMES if c in df.columns}
    return df.withColumns(times)


def _queue_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(_stored_queue(spark, sf_dir).rows())


def _queue_store_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(_stored_queue(spark, sf_dir).metrics())


def _queue() -> dict[str, Query]:
    half_minute = timedelta(seconds=30)
    q = "message_queue"
    return {
        "queue_enqueue": _enqueue,
        "queue_expire": _over(lambda m: queue.expire_exhausted(m, "q1", half_minute, AS_OF), q),
        "queue_claim": _over(lambda m: queue.claim(m, "q1", AS_OF), q),
        "queue_claim_all": _over(lambda m: queue.claim_all_ids(m, AS_OF, n=100), q),
        "queue_after_dequeue": _over(lambda m: queue.dequeue(m, "q1", AS_OF), q),
        "queue_ack": _ack,
        "queue_nack": _over(_nack, q, "queue_ops"),
        "queue_metrics": _over(queue.metrics, q),
        "queue_metrics_one": _over(lambda m: queue.metrics(m, "q3"), q),
        "queue_inflight": _over(lambda m: queue.inflight(m, "q1"), q),
        "queue_backpressure": _over(
            lambda m: queue.backpressure(queue.depth_series(m), high=500, low=250), q
        ),
        "queue_purge_victims": _over(lambda m: queue.purge_victims(m, "q1", AS_OF), q),
        "queue_after_purge": _over(lambda m: queue.purge(m, "q1", AS_OF), q),
        "queue_store_roundtrip": _queue_store,
        "queue_metrics_incremental": _queue_store_metrics,
    }


def _json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return rel.json_contains(events, "props", {"k": 42})


def _by_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``genres_contains_all`` answered from a stored index; the titles are fetched for its ids."""
    titles, path = view(spark, sf_dir, "title_basics"), shared_dir(spark, "postings")
    layout.write_inverted_index(titles, "genres", "tconst", path)
    ids = layout.holding_all(spark, path, "tconst", ["Drama", "Comedy"])
    return titles.join(ids, "tconst", "left_semi").select("tconst", "genres")


def _top_votes(title_ratings: DataFrame) -> DataFrame:
    top = layout.curate_top_votes(title_ratings)
    return top.withColumn("average_rating", F.col("average_rating").cast("double"))


def _tables() -> dict[str, Query]:
    b = "title_basics"
    genres = ["tconst", "genres"]
    return {
        "array_any_join": _over(
            lambda n, c: rel.array_any_join(n, c, "nconst", "directors").select(
                "tconst", "nconst", "primary_name"
            ),
            "name_basics",
            "title_crew",
        ),
        "genres_contains_all": _over(
            lambda t: rel.with_genres(t, every=["Drama", "Comedy"]).select(*genres), b
        ),
        "genres_overlap": _over(
            lambda t: rel.with_genres(t, some=["Film-Noir", "Western"]).select(*genres), b
        ),
        "genres_by_postings": _by_postings,
        "json_path_filter": _json_path,
        "genre_postings": _over(lambda t: rel.inverted_index(t, "genres", "tconst"), b),
        "genre_posting_counts": _over(lambda t: layout.posting_counts(t, "genres", "tconst"), b),
        "column_stats": _over(lambda t: audit.column_stats(t, exact=True), "title_ratings"),
        "column_stats_merged": _stats_merged,
        "curate_movies": _over(layout.curate_movies, b),
        "curate_by_runtime": _over(layout.curate_by_runtime, b),
        "curate_top_votes": _over(_top_votes, "title_ratings"),
        "curate_actors": _over(layout.curate_actors, "title_principals"),
    }


def _life(ops: DataFrame, folder: str) -> None:
    """One run of the life-cycle stream over all that ``ops`` brings."""
    (
        lifecycle.lifecycle(ops)
        .writeStream.format("parquet")
        .option("path", f"{folder}/changes")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _state(spark: SparkSession, folder: str) -> DataFrame:
    written = spark.read.schema(lifecycle.TRANSITIONS).parquet(f"{folder}/changes")
    state = lifecycle.current_state(written, F.lit("2024-03-01 00:00:00"))
    times = ["available_at", "started_at", "completed_at", "failed_at"]
    return state.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def _lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "lifecycle")
    _life(stream_view(spark, sf_dir, "queue_ops"), folder)
    return _state(spark, folder)


def _lifecycle_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All acks arrive after all other operations, most of them far behind the watermark."""
    folder = shared_dir(spark, "lifecycle-late")
    ops = view(spark, sf_dir, "queue_ops")
    for part in (F.col("op") != "ack", F.col("op") == "ack"):
        ops.filter(part).write.mode("append").parquet(f"{folder}/ops")
        _life(spark.readStream.schema(ops.schema).parquet(f"{folder}/ops"), folder)
    return _state(spark, folder)


def _consumed(spark: SparkSession, sf_dir: str) -> str:
    """A store into which one run of the consumer landed messages of all seven tables."""
    folder = shared_dir(spark, "ingest")
    messages = stream_view(spark, sf_dir, "catalog_messages")
    query = stream_ingest.run_ingest(messages, f"{folder}/store", f"{folder}/checkpoint")
    query.awaitTermination()
    return f"{folder}/store"


#: What the result of ``stream_ingest`` shows of each table, beside the key.
SHOWN = {
    "title_basics": "primary_title, start_year, array_join(genres, ',')",
    "name_basics": "primary_name, birth_year",
    "title_ratings": "average_rating, num_votes",
    "title_crew": "array_join(directors, ',')",
    "title_episode": "parent_tconst, season_number, episode_number",
    "title_akas": "title, is_original_title",
    "title_principals": "nconst, category, characters",
}


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, out = _consumed(spark, sf_dir), None
    for name, shown in SHOWN.items():
        key = ", ".join(DATASETS[name].key)
        rows = stream_ingest.table(spark, store, name).select(
            F.lit(name).alias("table_name"),
            F.expr(f"concat_ws('|', {key})").alias("key"),
            F.expr(f"concat_ws('|', {shown})").alias("shown"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _consume_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = stream_ingest.outcome_log(Store(spark, _consumed(spark, sf_dir)))
    return log.select("id", "table_name", "outcome", "reason", "attempts")


def _streams() -> dict[str, Query]:
    return {
        "queue_lifecycle": _lifecycle,
        "queue_lifecycle_late": _lifecycle_late,
        "stream_ingest": _stream_ingest,
        "consume_outcomes": _consume_outcomes,
    }


def queries() -> dict[str, Query]:
    return {**_scenarios(), **_ingestion(), **_queue(), **_tables(), **_streams()}
