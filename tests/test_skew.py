"""A third of all rows on one key: results stay whole and the hot partition is split."""

import pytest
from pyspark.sql import functions as F

from marquee.operators import relational as rel
from marquee.plans import scenarios as S

N = 300_000
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "40",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in CONF}
    for key, value in CONF.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def hot(name):
    """``name``0 for a third of the rows, else one of N distinct values."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.xxhash64("id") % N)
    return F.concat(F.lit(name), F.abs(key).cast("string"))


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def credits(spark):
    rows = spark.range(N, numPartitions=40)
    return rows.select(
        hot("tt").alias("tconst"),
        (F.col("id") % 7).cast("int").alias("ordering"),
        F.concat(F.lit("nm"), F.col("id") % 500).alias("nconst"),
        F.lit("actor").alias("category"),
        F.sha2(F.col("id").cast("string"), 256).alias("job"),
    )


def titles(spark):
    return spark.range(N).select(
        F.concat(F.lit("tt"), "id").alias("tconst"),
        F.lit("movie").alias("title_type"),
        F.array(F.concat(F.lit("g"), F.col("id") % 9)).alias("genres"),
    )


def test_reference_check_splits_the_hot_parent(spark, credits, small_partitions):
    good, bad = rel.split_orphans(credits, [("tconst", titles(spark).filter("tconst <> 'tt1'"), "tconst")])
    rows, plan = final_plan(good.groupBy("category").agg(F.count("*"), F.max("job")))
    assert "skew=true" in plan
    assert rows[0][1] + bad.count() == N


def test_genre_breadth_splits_the_hot_title(spark, credits, small_partitions):
    names = spark.range(500).select(F.concat(F.lit("nm"), "id").alias("nconst"), F.lit("x").alias("primary_name"))
    wide = credits.select("tconst", F.concat("nconst", F.lit("")).alias("nconst"), "category")
    rows, plan = final_plan(S.s5a(wide, names, titles(spark)))
    assert "skew=true" in plan
    assert len(rows) == 500 and all(r.distinct_genre_count == 9 for r in rows)


def test_first_per_key_folds_before_the_shuffle(spark, credits):
    out = rel.first_per_key(credits, ["tconst", "ordering"], ["job"])
    rows, plan = final_plan(out.agg(F.count("*"), F.max("job")))
    assert "partial_min(" in plan and "Window" not in plan
    assert rows[0][0] == credits.select("tconst", "ordering").distinct().count()


def test_small_batch_does_not_shuffle_the_target(spark, credits, small_partitions):
    batch = credits.limit(1000)
    out = rel.without_existing(batch, titles(spark), ["tconst"], rows=1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [tconst" in plan and "LeftSemi, BuildRight" in plan


def test_reference_check_splits_the_null_references(spark, credits, small_partitions):
    fk = F.when(F.col("tconst") != "tt0", F.col("tconst")).alias("tconst")
    child = credits.select(fk, "ordering", "job", "category")
    good, bad = rel.split_orphans(child, [("tconst", titles(spark).filter("tconst <> 'tt1'"), "tconst")])
    rows, plan = final_plan(good.groupBy("category").agg(F.count("*"), F.max("job")))
    assert "skew=true" in plan
    assert rows[0][1] + bad.count() == N


def test_membership_join_splits_the_hot_member(spark, credits, small_partitions):
    crew = credits.select(
        F.concat(F.lit("x"), F.col("job")).alias("title"),
        F.array(F.regexp_replace("tconst", "tt", "nm"), F.lit(None).cast("string")).alias("people"),
    )
    names = spark.range(N).select(F.concat(F.lit("nm"), "id").alias("nconst"), F.lit("n").alias("name"))
    joined = rel.array_any_join(names, crew, "nconst", "people")
    rows, plan = final_plan(joined.groupBy("name").agg(F.count("*"), F.max("title")))
    assert "skew=true" in plan and rows[0][1] == N
