"""The eight catalogue scenarios, two variants each.

Joins on ``tconst`` come first and carry only the columns needed, arrays are exploded after
them, and people's names join the aggregated rows, one per person, rather than the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.numeric import exact_avg, exact_stddev, median
from marquee.operators.relational import increasing_pairs, top_n_per_group, unordered_pairs

# The spellings of series types, and the acting categories.
SERIES_TYPES = ("tvSeries", "tvMiniSeries", "tvseries", "tvminiseries")
ACTING = ("actor", "actress")
ACTING_OR_SELF = ("actor", "actress", "self")


def _movies(title_basics: DataFrame) -> DataFrame:
    return title_basics.filter(F.col("title_type") == "movie")


def s1a(title_basics: DataFrame, title_ratings: DataFrame) -> DataFrame:
    """Average rating of movies by genre."""
    rated = title_ratings.filter(F.col("average_rating").isNotNull())
    movies = _movies(title_basics).select("tconst", "genres")
    return (
        movies.join(rated.select("tconst", "average_rating"), "tconst")
        .select(F.explode("genres").alias("genre"), "average_rating")
        .filter(F.col("genre").isNotNull())
        .groupBy("genre")
        .agg(
            F.count("*").alias("rated_movie_count"),
            exact_avg(F.col("average_rating")).alias("average_rating"),
        )
        .orderBy(F.desc("average_rating"), "genre")
    )


def s1b(title_basics: DataFrame, title_ratings: DataFrame) -> DataFrame:
    """Average and spread by genre; the NULL genre and unrated entries count as well."""
    movies = _movies(title_basics).select("tconst", "genres")
    return (
        movies.join(title_ratings.select("tconst", "average_rating"), "tconst")
        .select(F.explode("genres").alias("genre"), "average_rating")
        .groupBy("genre")
        .agg(
            F.count("*").alias("title_count"),
            exact_avg(F.col("average_rating")).alias("avg_rating"),
            exact_stddev(F.col("average_rating")).alias("stddev_rating"),
        )
        .orderBy(F.desc_nulls_first("avg_rating"), F.asc_nulls_last("genre"))
    )


def s2a(
    title_basics: DataFrame, title_ratings: DataFrame, min_votes: int = 1000, n: int = 10
) -> DataFrame:
    """Movies with the most votes."""
    movies = _movies(title_basics).select("tconst", "primary_title", "start_year", "genres")
    popular = title_ratings.filter(F.col("num_votes") >= min_votes)
    return (
        movies.join(popular.select("tconst", "average_rating", "num_votes"), "tconst")
        .orderBy(F.desc("num_votes"), "tconst")
        .limit(n)
        .select(
            "tconst",
            "primary_title",
            "start_year",
            F.col("average_rating").cast("double").alias("average_rating"),
            "num_votes",
            "genres",
        )
    )


# The second variant leaves ties open; with the id as tie-break the two are one query.
s2b = s2a


def _directed(title_crew: DataFrame, title_basics: DataFrame) -> DataFrame:
    """(tconst, directors) of movies; ``tconst`` is unique in both inputs."""
    movies = _movies(title_basics).select("tconst")
    return title_crew.select("tconst", "directors").join(movies, "tconst")


def _by_director(credits: DataFrame, average: str) -> DataFrame:
    """Movie count and average per director, each director once per movie."""
    return (
        credits.select(F.explode(F.array_distinct("directors")).alias("nconst"), "average_rating")
        .filter(F.col("nconst").isNotNull())
        .groupBy("nconst")
        .agg(
            F.count("*").alias("movie_count"),
            exact_avg(F.col("average_rating")).alias(average),
        )
    )


def s3a(
    title_crew: DataFrame,
    title_basics: DataFrame,
    name_basics: DataFrame,
    title_ratings: DataFrame,
    n: int = 20,
) -> DataFrame:
    """Directors with the most movies, rated or not."""
    ratings = title_ratings.select("tconst", "average_rating")
    credits = _directed(title_crew, title_basics).join(ratings, "tconst", "left")
    return (
        name_basics.select("nconst", "primary_name")
        .join(_by_director(credits, "average_movie_rating"), "nconst")
        .orderBy(F.desc("movie_count"), "nconst")
        .limit(n)
    )


def s3b(
    title_crew: DataFrame,
    title_basics: DataFrame,
    name_basics: DataFrame,
    title_ratings: DataFrame,
    min_movies: int = 5,
    n: int = 20,
) -> DataFrame:
    """Directors with the most movies that have a rating row, from ``min_movies`` on.

    Names, not crews, decide membership (``nconst = ANY(directors)``): exploding the
    distinct elements turns that into an equi-join.
    """
    ratings = title_ratings.select("tconst", "average_rating")
    credits = _directed(title_crew, title_basics).join(ratings, "tconst")
    busy = _by_director(credits, "avg_movie_rating").filter(F.col("movie_count") >= min_movies)
    return (
        name_basics.select("nconst", "primary_name")
        .join(busy, "nconst")
        .orderBy(F.desc("movie_count"), "nconst")
        .limit(n)
    )


def s4a(title_basics: DataFrame, title_ratings: DataFrame, since: int = 2000) -> DataFrame:
    """Average rating of movies by year."""
    movies = _movies(title_basics).filter(F.col("start_year") >= since)
    rated = title_ratings.filter(F.col("average_rating").isNotNull())
    return (
        movies.select("tconst", "start_year")
        .join(rated.select("tconst", "average_rating"), "tconst")
        .groupBy("start_year")
        .agg(
            F.count("*").alias("rated_movie_count"),
            exact_avg(F.col("average_rating")).alias("average_rating"),
        )
        .orderBy("start_year")
    )


def s4b(
    title_basics: DataFrame, title_ratings: DataFrame, since: int = 2000, min_votes: int = 100
) -> DataFrame:
    """Average and median by year over movies with at least ``min_votes`` votes."""
    movies = _movies(title_basics).filter(F.col("start_year") >= since)
    voted = title_ratings.filter(F.col("num_votes") >= min_votes)
    return (
        movies.select("tconst", "start_year")
        .join(voted.select("tconst", "average_rating"), "tconst")
        .groupBy("start_year")
        .agg(
            F.count("*").alias("movie_count"),
            exact_avg(F.col("average_rating")).alias("avg_rating"),
            median(F.col("average_rating")).alias("median_rating"),
        )
        .orderBy("start_year")
    )


def _person_genres(
    title_principals: DataFrame, title_basics: DataFrame, categories: Sequence[str]
) -> DataFrame:
    """Distinct (nconst, genre) over movies, the NULL genre included.

    Duplicates fold in the map tasks, so a person in a third of all rows shuffles at most
    one row per genre and task.
    """
    acting = title_principals.filter(
        F.col("category").isin(*categories) & F.col("nconst").isNotNull()
    )
    movies = _movies(title_basics).select("tconst", "genres")
    return (
        acting.select("nconst", "tconst")
        .join(movies, "tconst")
        .select("nconst", F.explode("genres").alias("genre"))
        .distinct()
    )


def s5a(
    title_principals: DataFrame,
    name_basics: DataFrame,
    title_basics: DataFrame,
    more_than: int = 5,
    categories: Sequence[str] = ACTING,
) -> DataFrame:
    """Actors seen in more than ``more_than`` movie genres, with the sorted genres."""
    breadth = (
        _person_genres(title_principals, title_basics, categories)
        .filter(F.col("genre").isNotNull())
        .groupBy("nconst")
        .agg(
            F.count("*").alias("distinct_genre_count"),
            F.sort_array(F.collect_list("genre")).alias("genres"),
        )
        .filter(F.col("distinct_genre_count") > more_than)
    )
    return (
        name_basics.select("nconst", "primary_name")
        .join(breadth, "nconst")
        .orderBy(F.desc("distinct_genre_count"), "nconst")
    )


def s5b(
    title_principals: DataFrame,
    name_basics: DataFrame,
    title_basics: DataFrame,
    n: int = 20,
    categories: Sequence[str] = ACTING_OR_SELF,
) -> DataFrame:
    """People with the most movie genres; a NULL genre is listed last but not counted."""
    null_tail = F.when(F.bool_or(F.col("genre").isNull()), F.array(F.lit(None).cast("string")))
    breadth = (
        _person_genres(title_principals, title_basics, categories)
        .groupBy("nconst")
        .agg(
            F.count("genre").alias("genre_count"),
            F.concat(
                F.sort_array(F.collect_list("genre")),
                F.coalesce(null_tail, F.array().cast("array<string>")),
            ).alias("genres_list"),
        )
    )
    return (
        name_basics.select("nconst", "primary_name")
        .join(breadth, "nconst")
        .orderBy(F.desc("genre_count"), "nconst")
        .limit(n)
    )


def s6a(
    title_episode: DataFrame,
    title_basics: DataFrame,
    title_ratings: DataFrame,
    series_types: Sequence[str] = SERIES_TYPES,
    n: int = 20,
) -> DataFrame:
    """Series with the most distinct numbered seasons.

    Episodes are folded per series before any join, so one endless series is one row there.
    Ratings do not affect the order and join the top rows only.
    """
    seasons = (
        title_episode.filter(F.col("parent_tconst").isNotNull())
        .groupBy(F.col("parent_tconst").alias("tconst"))
        .agg(
            F.count_distinct(F.when(F.col("season_number") > 0, F.col("season_number"))).alias(
                "season_count"
            ),
            F.count("*").alias("episode_count"),
        )
    )
    series = title_basics.filter(F.col("title_type").isin(*series_types))
    order = [F.desc("season_count"), F.desc("episode_count"), F.asc("tconst")]
    top = series.select("tconst", "primary_title").join(seasons, "tconst").orderBy(*order).limit(n)
    ratings = title_ratings.select("tconst", F.col("average_rating").cast("double"))
    return (
        top.join(ratings, "tconst", "left")
        .select("tconst", "primary_title", "season_count", "episode_count", "average_rating")
        .orderBy(*order)
    )


def s6b(
    title_episode: DataFrame,
    title_basics: DataFrame,
    title_ratings: DataFrame,
    series_types: Sequence[str] = SERIES_TYPES,
    n: int = 20,
) -> DataFrame:
    """Series with the highest season number; a series without any sorts first."""
    episodes = (
        title_episode.filter(F.col("parent_tconst").isNotNull())
        .select(F.col("parent_tconst"), F.col("tconst").alias("episode"), "season_number")
        .groupBy(F.col("parent_tconst").alias("tconst"))
        .agg(
            F.max("season_number").alias("total_seasons"),
            F.count_distinct("episode").alias("total_episodes"),
        )
    )
    series = title_basics.filter(F.col("title_type").isin(*series_types))
    ratings = title_ratings.select(
        "tconst", F.col("average_rating").cast("double").alias("avg_rating")
    )
    order = [F.desc_nulls_first("total_seasons"), F.asc("tconst")]
    top = series.select("tconst", "primary_title").join(episodes, "tconst").orderBy(*order).limit(n)
    return (
        top.join(ratings, "tconst", "left")
        .select("tconst", "primary_title", "total_seasons", "total_episodes", "avg_rating")
        .orderBy(*order)
    )


def s7a(title_basics: DataFrame, n: int = 20) -> DataFrame:
    """Most common unordered genre pairs over movies."""
    movies = _movies(title_basics).filter(F.size("genres") >= 2).select("genres")
    return (
        unordered_pairs(movies, "genres", "genre_1", "genre_2")
        .groupBy("genre_1", "genre_2")
        .agg(F.count("*").alias("movie_count"))
        .orderBy(F.desc("movie_count"), "genre_1", "genre_2")
        .limit(n)
    )


def s7b(title_basics: DataFrame, title_ratings: DataFrame, n: int = 20) -> DataFrame:
    """Most common pairs over movies with a rating row; repeated genres count repeatedly."""
    movies = _movies(title_basics).filter(F.size("genres") >= 2).select("tconst", "genres")
    rated = movies.join(title_ratings.select("tconst", "average_rating"), "tconst")
    return (
        increasing_pairs(rated.drop("tconst"), "genres", "genre1", "genre2")
        .groupBy("genre1", "genre2")
        .agg(
            F.count("*").alias("pair_count"),
            exact_avg(F.col("average_rating")).alias("avg_rating"),
        )
        .orderBy(F.desc("pair_count"), "genre1", "genre2")
        .limit(n)
    )


def _longest(title_basics: DataFrame, n: int, null_genre: bool) -> DataFrame:
    timed = _movies(title_basics).filter(F.col("runtime_minutes").isNotNull())
    entries = timed.select(
        F.explode("genres").alias("genre"), "tconst", "primary_title", "runtime_minutes", "start_year"
    )
    if not null_genre:
        entries = entries.filter(F.col("genre").isNotNull())
    order = [F.desc("runtime_minutes"), F.asc("tconst")]
    return top_n_per_group(entries, ["genre"], order, n, rank="genre_rank", salt_by=["tconst"])


def s8a(title_basics: DataFrame, title_ratings: DataFrame, n: int = 5) -> DataFrame:
    """The longest movies of each genre with their ratings, which join after the cut."""
    ratings = title_ratings.select("tconst", F.col("average_rating").cast("double"))
    return (
        _longest(title_basics, n, null_genre=False)
        .join(ratings, "tconst", "left")
        .select(
            "genre",
            "genre_rank",
            "tconst",
            "primary_title",
            "runtime_minutes",
            "start_year",
            "average_rating",
        )
        .orderBy("genre", "genre_rank")
    )


def s8b(title_basics: DataFrame, title_ratings: DataFrame, n: int = 5) -> DataFrame:
    """As ``s8a`` with the NULL genre as a group of its own, without rank and year."""
    ratings = title_ratings.select("tconst", F.col("average_rating").cast("double"))
    return (
        _longest(title_basics, n, null_genre=True)
        .join(ratings, "tconst", "left")
        .select("genre", "tconst", "primary_title", "runtime_minutes", "average_rating")
        .orderBy(F.asc_nulls_last("genre"), F.desc("runtime_minutes"), "tconst")
    )
