"""Answers do not hang on the session's settings."""

import json

import pytest
from pyspark.sql import functions as F

from marquee.operators import normalize
from marquee.operators import relational as rel
from marquee.plans import ingest

KEY = "spark.sql.variant.allowDuplicateKeys"


@pytest.fixture(params=["unset", "false"])
def session(spark, request):
    spark.conf.unset(KEY)
    if request.param == "false":
        spark.conf.set(KEY, "false")
    yield spark
    spark.conf.unset(KEY)


def test_the_last_of_equal_keys_counts(session):
    twice = '{"table":"nope","table":"title_ratings","data":{"tconst":"tt1","tconst":"tt2"}}'
    rows = session.createDataFrame([(1, twice)], "id BIGINT, payload STRING")
    row = normalize.normalize_messages(rows).head()
    assert (row.table_name, row.reason, row.record.tconst) == ("title_ratings", None, "tt2")
    kept = rel.json_contains(rows, "payload", {"table": "title_ratings"})
    assert kept.count() == 1


def test_batch_counters_add_up(spark):
    outcomes = ["ack"] * 4 + ["retry"] * 3 + ["permanent"] * 2 + ["failed"]
    done = spark.createDataFrame([(o,) for o in outcomes], "outcome STRING")
    event = ingest.batch_event(done, F.lit("2024-01-01").cast("timestamp")).head()
    counts = json.loads(event.payload)
    assert counts == {"claimed": 10, "processed": 4, "nacked": 3, "failed": 1, "invalid": 2}
