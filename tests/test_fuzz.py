"""Converters against Python's own idea of integers and JSON, on random text."""

import json
import random

from pyspark.sql import functions as F

from marquee.functions.converters import CONVERTERS, Raw

BAD = "refused"


def convert(spark, name, texts):
    converter = CONVERTERS[name]
    rows = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING").repartition(4)
    rows = rows.withColumn("v", F.expr(converter.value(Raw("t"))))
    rows = rows.withColumn("e", F.expr(converter.error("t", "v")))
    out = {r.i: BAD if r.e is not None else r.v for r in rows.collect()}
    return [out[i] for i in range(len(texts))]


def test_integers(spark):
    rng = random.Random(1)
    alphabet = "0123456789" * 2 + "+-_ .e\t\n"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 7))) for _ in range(10_000)]

    def expected(text):
        try:
            return int(text)
        except ValueError:
            return BAD

    assert convert(spark, "integer", texts) == [expected(t) for t in texts]


def random_json(rng, depth=0):
    if depth > 2 or rng.random() < 0.5:
        return rng.choice(["1", "2.50", '"a b"', '"x\\"y"', "null", "true", "-3", '""', '"\\u0041"'])
    blank = rng.choice(["", " ", "\n"])
    parts = [random_json(rng, depth + 1) for _ in range(rng.randrange(3))]
    if rng.random() < 0.5:
        return f"[{blank}{(',' + blank).join(parts)}{blank}]"
    return "{" + (blank + ",").join(f'"k{i}"{blank}:{p}' for i, p in enumerate(parts)) + blank + "}"


def test_json(spark):
    rng = random.Random(2)
    texts = []
    for _ in range(4000):
        text = random_json(rng)
        if rng.random() < 0.3:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice([",", "]", "}", '"', "x", " ", "1"]) + text[at:]
        texts.append(text)
    for text, value in zip(texts, convert(spark, "json_text", texts)):
        try:
            expected = json.loads(text)
        except ValueError:
            assert value == BAD, text
        else:
            assert json.loads(value) == expected and "\n" not in value, text
