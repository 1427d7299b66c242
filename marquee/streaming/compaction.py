"""Run tables of a store rewritten in few files, published together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.schemas import DATASETS, EVENT_LOG
from marquee.sources.buckets import spread
from marquee.sources.store import Store
from marquee.streaming.ingest import OUTCOMES, PLACE, REJECTED, ROUND, ddl

#: The batch number that rewritten rows of a run carry: before every batch of the stream.
REWRITTEN = -1
PART = "part STRING"


def _last_batches(store: Store) -> dict[str, int]:
    """The last batch begun of each run: it may be repeated and then replaces its own rows."""
    begun = store.read("inbox", f"id BIGINT, {PLACE}, {PART}")
    last = begun.groupBy("run").agg(F.max("epoch").alias("epoch"))
    return {r.run: r.epoch for r in last.collect()}  # a row per run name


def _finished(last: dict[str, int]) -> Column:
    done = F.lit(False)
    for run, epoch in last.items():
        done = done | ((F.col("run") == run) & (F.col("epoch") < epoch))
    return done


def compact(spark: SparkSession, store_dir: str) -> int:
    """Rewrite tables, outcomes, rejected messages and events; returns the new generation.

    The rows of a run's finished batches come together, by bucket and key where the table has
    buckets; those of its last batch keep their own folder, as a repeated batch replaces it.
    Everything is written beside what is read and then published as one generation, so readers
    see the old files or the new ones, and a job that breaks off before leaves only files that
    the next one replaces. The generation before the one just replaced is removed, so that jobs
    which began before the publishing can end. To be called while no batch runs.
    """
    store = Store(spark, store_dir).pin()
    old, new = store.pinned, store.pinned + 1
    last = _last_batches(store)
    finished = _finished(last)
    names = [f"tables/{table}" for table in DATASETS]
    for name, dataset in zip(names, DATASETS.values()):
        rows = store.read(f"{name}/gen={old}", f"{ddl(dataset)}, {ROUND}")
        _rewrite(store, _moved(rows, finished), f"{name}/gen={new}", ["bucket"], dataset.key)
    for name, columns in (("outcomes", OUTCOMES), ("rejected", REJECTED)):
        parts = f"{PLACE}, {PART}" if name == "outcomes" else PLACE
        rows = _moved(store.read(f"{name}/gen={old}", f"{columns}, {parts}"), finished)
        by = []
        if name == "outcomes":
            by = ["part"]
            whole = F.when(F.col("epoch") == REWRITTEN, F.lit("all")).otherwise(F.col("part"))
            rows = rows.withColumn("part", whole)
        _rewrite(store, rows, f"{name}/gen={new}", by, ["id"])
    events = store.read(f"events/gen={old}", f"{EVENT_LOG}, writer STRING, batch STRING")
    # A producer's run may be repeated whenever; there is one event for each.
    again = [f"{run}-{epoch}" for run, epoch in last.items()]
    stays = (F.col("writer") == "producer") | F.col("batch").isin(*again)
    for name in again:
        stays = stays | F.col("batch").startswith(f"{name}-")
    events = events.withColumn("batch", F.when(stays, F.col("batch")).otherwise(F.lit("all")))
    _write(events.coalesce(1), store, f"events/gen={new}", ["writer", "batch"])
    store.publish_generation(new)
    for name in (*names, "outcomes", "rejected", "events"):
        if old and store.exists(f"{name}/gen={old - 1}"):
            store.clear(f"{name}/gen={old - 1}")
    return new


def _moved(rows: DataFrame, finished: Column) -> DataFrame:
    return rows.withColumns(
        {
            "epoch": F.when(finished, F.lit(REWRITTEN).cast("long")).otherwise(F.col("epoch")),
            "round": F.when(finished, F.lit(0)).otherwise(F.col("round")),
        }
    )


def _rewrite(store: Store, rows: DataFrame, path: str, by: list[str], key) -> None:
    place = ["run", "epoch", "round", *by]
    sizes = rows.groupBy(*place).agg(F.count("*").alias("n"))
    largest = sizes.agg(F.max("n")).head()[0] or 0
    _write(spread(rows, place, key, largest), store, path, place)


def _write(rows: DataFrame, store: Store, path: str, place: list[str]) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*place).parquet(store.path(path))
