"""Operators and scenarios on hand-made frames with the edge cases, and plan shapes."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marquee.functions.numeric import exact_avg, exact_stddev
from marquee.operators import audit
from marquee.operators import relational as rel
from marquee.plans import scenarios as S
from workload.views import view

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def titles(spark):
    rows = [
        ("tt1", "movie", "One", 2001, 90, ["Drama", "Sci-Fi", "Drama"]),
        ("tt2", "movie", "Two", 2001, 120, ["Film-Noir", None]),
        ("tt3", "movie", "Three", 1999, 120, []),
        ("tt4", "movie", "Four", None, None, None),
        ("tt5", "tvSeries", "Five", 2005, 30, ["Drama"]),
        ("tt6", "movie", "Six", 2002, 80, ["Drama", "drama"]),
        ("tt7", "tvMiniSeries", "Seven", 2005, 30, ["Drama"]),
    ]
    return spark.createDataFrame(
        rows,
        "tconst STRING, title_type STRING, primary_title STRING, start_year INT,"
        " runtime_minutes INT, genres ARRAY<STRING>",
    )


@pytest.fixture(scope="module")
def ratings(spark):
    rows = [("tt1", Decimal("7.1"), 1000), ("tt2", None, 5000), ("tt6", Decimal("8.2"), 999)]
    return spark.createDataFrame(rows, "tconst STRING, average_rating DECIMAL(3,1), num_votes INT")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_average_rounds_once(spark):
    low = spark.range(4999).select(F.lit("5.1").cast("decimal(3,1)").alias("x"))
    high = spark.range(95002).select(F.lit("5.0").cast("decimal(3,1)").alias("x"))
    both = low.union(high)
    assert both.agg(exact_avg(F.col("x"))).head()[0] == 5.00
    assert both.agg(F.round(F.avg("x"), 2)).head()[0] == Decimal("5.01")  # what it avoids


def test_stddev(spark):
    values = spark.createDataFrame([(Decimal("1.0"),), (Decimal("2.0"),), (Decimal("4.0"),), (None,)], "x DECIMAL(3,1)")
    assert values.agg(exact_stddev(F.col("x"))).head()[0] == 1.53
    assert values.limit(1).agg(exact_stddev(F.col("x"))).head()[0] is None


def test_genres_of_rated_movies(titles, ratings):
    assert rows(S.s1a(titles, ratings)) == [
        ("drama", 1, 8.2), ("Drama", 3, 7.47), ("Sci-Fi", 1, 7.1)
    ]
    assert rows(S.s1b(titles, ratings)) == [
        ("Film-Noir", 1, None, None), (None, 1, None, None), ("drama", 1, 8.2, None),
        ("Drama", 3, 7.47, 0.64), ("Sci-Fi", 1, 7.1, None),
    ]


def test_top_votes_threshold(titles, ratings):
    assert [r.tconst for r in S.s2a(titles, ratings).collect()] == ["tt2", "tt1"]


def test_directors_count_once_per_movie(spark, titles, ratings):
    crew = spark.createDataFrame(
        [("tt1", ["nm1", "nm1", None]), ("tt2", ["nm1"]), ("tt3", ["nm2", "nm9"]), ("tt4", None), ("tt5", ["nm2"])],
        "tconst STRING, directors ARRAY<STRING>",
    )
    names = spark.createDataFrame([("nm1", "A"), ("nm2", "B")], "nconst STRING, primary_name STRING")
    assert rows(S.s3a(crew, titles, names, ratings)) == [("nm1", "A", 2, 7.1), ("nm2", "B", 1, None)]
    assert rows(S.s3b(crew, titles, names, ratings, min_movies=2)) == [("nm1", "A", 2, 7.1)]
    joined = rel.array_any_join(names, crew, "nconst", "directors")
    assert joined.count() == 4


def test_null_genre_is_listed_last_not_counted(spark, titles):
    cast = spark.createDataFrame(
        [("tt1", 1, "nm1", "actor"), ("tt2", 1, "nm1", "self"), ("tt1", 2, None, "actor")],
        "tconst STRING, ordering INT, nconst STRING, category STRING",
    )
    names = spark.createDataFrame([("nm1", "A")], "nconst STRING, primary_name STRING")
    assert rows(S.s5b(cast, names, titles)) == [("nm1", "A", 3, ["Drama", "Film-Noir", "Sci-Fi", None])]
    assert rows(S.s5a(cast, names, titles, more_than=1)) == [("nm1", "A", 2, ["Drama", "Sci-Fi"])]


def test_seasons(spark, titles, ratings):
    episodes = spark.createDataFrame(
        [("tt50", "tt5", 0), ("tt51", "tt5", 1), ("tt51", "tt5", 1), ("tt70", "tt7", None), ("tt1", "tt1", 3), ("tt8", None, 1)],
        "tconst STRING, parent_tconst STRING, season_number INT",
    )
    assert rows(S.s6a(episodes, titles, ratings)) == [
        ("tt5", "Five", 1, 3, None), ("tt7", "Seven", 0, 1, None)
    ]
    assert rows(S.s6b(episodes, titles, ratings)) == [
        ("tt7", "Seven", None, 1, None), ("tt5", "Five", 1, 2, None)
    ]
    assert rows(S.s6b(episodes, titles, ratings, series_types=["tvseries"])) == []


def test_pairs(titles, ratings):
    assert rows(S.s7a(titles)) == [("Drama", "Sci-Fi", 1), ("Drama", "drama", 1)]
    assert rows(S.s7b(titles, ratings)) == [("Drama", "Sci-Fi", 2, 7.1), ("Drama", "drama", 1, 8.2)]


def test_longest(titles, ratings):
    assert rows(S.s8a(titles, ratings, n=1)) == [
        ("Drama", 1, "tt1", "One", 90, 2001, 7.1), ("Film-Noir", 1, "tt2", "Two", 120, 2001, None),
        ("Sci-Fi", 1, "tt1", "One", 90, 2001, 7.1), ("drama", 1, "tt6", "Six", 80, 2002, 8.2),
    ]
    assert (None, "tt2", "Two", 120, None) in rows(S.s8b(titles, ratings))


def test_first_per_key_orders_by_id(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", "x"), (2, "b", None)], "id INT, k STRING, v STRING")
    assert sorted(rows(rel.first_per_key(df, ["k"], ["id"]))) == [(1, "a", "x"), (2, "b", None)]


def test_without_existing_agrees_with_and_without_broadcast(spark):
    batch = spark.range(0, 100).select("id", (F.col("id") % 7).alias("v"))
    target = spark.range(50, 1000)
    small = rel.without_existing(batch, target, ["id"], rows=100)
    large = rel.without_existing(batch, target, ["id"])
    assert sorted(rows(small)) == sorted(rows(large)) and small.count() == 50


def test_orphans_and_insertable_partition_the_input(spark):
    child = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "fk STRING, i INT")
    parent = spark.createDataFrame([("a",), ("b",)], "pk STRING")
    for n in (None, 3):
        good, bad = rel.split_orphans(child, [("fk", parent, "pk")], n)
        assert sorted(r.i for r in good.collect()) == [1, 2] and [r.i for r in bad.collect()] == [3]


@pytest.mark.parametrize("n", [1, 10, 1000, 70_000, 150_000, 500_000])
def test_lowest_n_by_histogram(spark, n):
    df = spark.range(300_000).select((F.col("id") * 3 + 7).alias("k")).repartition(5)
    got = rel.lowest_n(df, "k", n, direct=5)
    expected = min(n, 300_000)
    summary = got.agg(F.count("*"), F.countDistinct("k"), F.max("k")).head()
    assert tuple(summary) == (expected, expected, (expected - 1) * 3 + 7)


def test_top_n_per_group_salted(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), "id")
    got = rel.top_n_per_group(df, ["g"], [F.desc("id")], 1200, salt_by=["id"], salts=4)
    assert got.groupBy("g").count().filter("count = 1200").count() == 3
    assert got.agg(F.min("id")).head()[0] == 20_000 - 3600


def test_array_filters(titles):
    def got(**kw):
        return sorted(r.tconst for r in rel.with_genres(titles, **kw).collect())

    assert got(every=["Drama", "Sci-Fi"]) == ["tt1"]
    assert got(some=["Film-Noir", "drama"]) == ["tt2", "tt6"]
    assert got(every=["Nope"]) == []


def test_audit(spark):
    df = spark.createDataFrame(
        [(1, "pending", -1, 5), (2, "odd", 6, 0), (2, None, 0, 5)],
        "id BIGINT, status STRING, attempt_count INT, max_attempts INT",
    )
    found = audit.constraint_audit(
        [audit.check_violations(df, ["id"], audit.queue_checks()), audit.duplicate_keys(df, ["id"], "pk")]
    )
    assert sorted(rows(found)) == [
        ("message_queue_attempt_count", "1", 1), ("message_queue_attempt_limit", "2", 1),
        ("message_queue_max_attempts", "2", 1), ("message_queue_status", "2", 1), ("pk", "2", 2),
    ]


def test_column_stats_sketch_is_close(spark):
    df = spark.range(10_000).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("half"))
    stats = {r.column: r for r in audit.column_stats(df).collect()}
    assert stats["half"].nulls == 5000 and stats["id"].rows == 10_000
    assert abs(stats["id"].distinct_values - 10_000) < 1000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_membership_join_is_an_equi_join(spark):
    tables = [view(spark, SF, n) for n in ("title_crew", "title_basics", "name_basics", "title_ratings")]
    for scenario in (S.s3a, S.s3b):
        text = plan(scenario(*tables))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_rank_cut_happens_before_the_shuffle(spark):
    text = plan(S.s8a(view(spark, SF, "title_basics"), view(spark, SF, "title_ratings")))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_top_k_needs_no_global_sort(spark):
    text = plan(S.s2a(view(spark, SF, "title_basics"), view(spark, SF, "title_ratings")))
    assert "TakeOrderedAndProject" in text


def test_filters_and_columns_reach_the_scan(spark, titles, ratings, tmp_path):
    titles.write.parquet(str(tmp_path / "titles"))
    ratings.write.parquet(str(tmp_path / "ratings"))
    stored = [spark.read.parquet(str(tmp_path / t)) for t in ("titles", "ratings")]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(S.s2a(*stored))
    assert "GreaterThanOrEqual(num_votes,1000)" in text and "EqualTo(title_type,movie)" in text
    yearly = plan(S.s4a(*stored))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(start_year,2000)" in yearly
    assert "genres" not in yearly and "num_votes" not in yearly and "runtime" not in yearly


def test_scenarios_stay_in_the_jvm(spark):
    names = ("title_principals", "name_basics", "title_basics")
    for df in (S.s5a(*(view(spark, SF, n) for n in names)), S.s7a(view(spark, SF, "title_basics"))):
        assert "Python" not in plan(df)
