"""Curated layouts: narrow, pre-filtered, sorted copies that make later scans skip data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.relational import inverted_index
from marquee.plans.scenarios import ACTING


def curate_movies(title_basics: DataFrame) -> DataFrame:
    """Movie rows with the columns the movie scenarios read."""
    movies = title_basics.filter(F.col("title_type") == "movie")
    return movies.select("start_year", "tconst", "primary_title", "genres", "runtime_minutes")


def write_movies(title_basics: DataFrame, path: str) -> None:
    """Movies by year: ranged on (year, id), so a crowded year spreads over several tasks
    and files, each sorted by id; year filters prune partitions."""
    ranged = curate_movies(title_basics).repartitionByRange("start_year", "tconst")
    ranged.sortWithinPartitions("start_year", "tconst").write.partitionBy("start_year").parquet(path)


def curate_by_runtime(title_basics: DataFrame) -> DataFrame:
    """Movies with a runtime, longest first, for top-runtime reads."""
    timed = title_basics.filter(
        (F.col("title_type") == "movie") & F.col("runtime_minutes").isNotNull()
    )
    return timed.select("runtime_minutes", "tconst", "primary_title", "genres")


def write_by_runtime(title_basics: DataFrame, path: str) -> None:
    order = [F.desc("runtime_minutes"), F.asc("tconst")]
    ranged = curate_by_runtime(title_basics).repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.parquet(path)


def curate_top_votes(title_ratings: DataFrame, min_votes: int = 1000) -> DataFrame:
    """Ratings with at least ``min_votes`` votes, most voted first."""
    popular = title_ratings.filter(F.col("num_votes") >= min_votes)
    return popular.select("num_votes", "tconst", "average_rating")


def write_top_votes(title_ratings: DataFrame, path: str, min_votes: int = 1000) -> None:
    order = [F.desc("num_votes"), F.asc("tconst")]
    ranged = curate_top_votes(title_ratings, min_votes).repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.parquet(path)


def curate_actors(title_principals: DataFrame) -> DataFrame:
    """Acting credits as (nconst, tconst)."""
    return title_principals.filter(F.col("category").isin(*ACTING)).select("nconst", "tconst")


def write_actors(title_principals: DataFrame, path: str) -> None:
    ranged = curate_actors(title_principals).repartitionByRange("nconst", "tconst")
    ranged.sortWithinPartitions("nconst", "tconst").write.parquet(path)


def write_episodes(
    title_episode: DataFrame, table: str, buckets: int = 64, slices: int = 8
) -> None:
    """Episodes bucketed by series, so grouping or joining by series needs no shuffle.

    Rows are spread over (bucket, slice) pairs first, so an endless series is written by
    ``slices`` tasks; choose ``buckets`` for files of a few hundred MB.
    """
    bucket = F.pmod(F.hash("parent_tconst"), F.lit(buckets))
    part = F.pmod(F.xxhash64("tconst"), F.lit(slices))
    columns = ["parent_tconst", "season_number", "tconst", "episode_number"]
    spread = title_episode.select(*columns).repartition(buckets * slices, bucket, part)
    writer = spread.write.bucketBy(buckets, "parent_tconst")
    writer.sortBy("parent_tconst", "season_number").format("parquet").saveAsTable(table)


def posting_counts(df: DataFrame, array: str, key: str) -> DataFrame:
    """(value, n): in how many rows each array value occurs."""
    return inverted_index(df, array, key).groupBy("value").agg(F.count("*").alias("n"))


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def write_inverted_index(df: DataFrame, array: str, key: str, path: str, buckets: int = 64) -> None:
    """Postings in folders by a hash of the value, ranged and sorted on (value, id) in each.

    A lookup opens the folders of the values it asks for; a hot value fills several files.
    """
    postings = inverted_index(df, array, key).withColumn("bucket", _bucket(F.col("value"), buckets))
    ranged = postings.repartitionByRange("bucket", "value", key)
    ordered = ranged.sortWithinPartitions("bucket", "value", key)
    ordered.write.partitionBy("bucket").parquet(path)


def postings_of(
    spark: SparkSession, path: str, key: str, values: Sequence[str], buckets: int = 64
) -> DataFrame:
    """(value, key) rows of the asked values from a stored index; other folders stay closed."""
    schema = f"value STRING, {key} STRING, bucket INT"
    wanted = sorted(set(values))
    # The hashes of literals are worked out while planning, so this prunes folders.
    folders = F.col("bucket").isin(*(_bucket(F.lit(v), buckets) for v in wanted))
    rows = spark.read.schema(schema).parquet(path).filter(folders & F.col("value").isin(*wanted))
    return rows.select("value", key)


def holding_all(
    spark: SparkSession, path: str, key: str, values: Sequence[str], buckets: int = 64
) -> DataFrame:
    """Keys whose array holds every one of ``values``, from the postings alone.

    Relational division: a key's postings of the asked values are as many as the values. The
    counts fold in the map tasks; the arrays are not read.
    """
    if not values:
        raise ValueError("ask for at least one value")
    rows = postings_of(spark, path, key, values, buckets)
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") == len(set(values))).select(key)


def holding_any(
    spark: SparkSession, path: str, key: str, values: Sequence[str], buckets: int = 64
) -> DataFrame:
    """Keys whose array holds one of ``values`` or more, from the postings alone."""
    return postings_of(spark, path, key, values, buckets).select(key).distinct()
