"""Converters on text and on JSON values, and the JSON helpers."""

import json

import pytest
from pyspark.sql import functions as F

from marquee.functions.converters import CONVERTERS, Raw
from marquee.functions.json import COMPACT
from marquee.operators.normalize import LARGE_BYTES, accepted_messages, classify, normalize_messages
from marquee.operators.relational import json_contains
from marquee.schemas import DATASETS

BAD = object()


def convert(spark, name, texts):
    converter = CONVERTERS[name]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    values = rows.withColumn("v", F.expr(converter.value(Raw("t"))))
    out = values.withColumn("e", F.expr(converter.error("t", "v"))).orderBy("i").collect()
    return [BAD if r.e is not None else r.v for r in out], [r.e for r in out]


CASES = {
    "text": [("\\N", None), (None, None), ("", ""), ("a\\Nb", "a\\Nb"), ('say "x"', 'say "x"')],
    "integer": [
        ("\\N", None), ("", None), (None, None), ("12", 12), (" +5 ", 5), ("-3", -3),
        ("1_000", 1000), ("1__0", BAD), ("_1", BAD), ("1.5", BAD), ("19x5", BAD), (" ", BAD),
        ("99999999999", BAD), ("true", BAD),
    ],
    "rating": [
        ("\\N", None), ("", None), ("8.25", "8.3"), ("9.96", "10.0"), ("0", "0.0"),
        ("10.0", "10.0"), ("10.01", BAD), ("11.0", BAD), ("-0.1", BAD), ("NaN", BAD),
        ("Infinity", BAD), ("1e1", "10.0"), ("abc", BAD), ("99999999999999", BAD),
    ],
    "boolean": [
        ("1", True), ("0", False), (" TRUE ", True), ("f", False), ("No", False), ("\tyes\n", True),
        ("y", BAD), ("n", BAD), ("maybe", BAD), ("", None), ("\\N", None), (" ", BAD),
    ],
    "array": [
        ("\\N", None), (None, None), ("", []), ("A,,B,", ["A", "B"]), (" A, B", [" A", " B"]),
        (",", []),
    ],
    "json_text": [
        ("\\N", None), ("", None), ('[ "a" , "b c" ]', '["a","b c"]'),
        ('{"b": 1, "a": "x\\" y"}', '{"b":1,"a":"x\\" y"}'), ("[1", BAD), ("x", BAD),
        ("[1] x", BAD), ("[1]]", BAD), ("1,2", BAD), ("{}}", BAD), ("null", "null"), (" 5 ", "5"),
    ],
    "tconst": [("tt1", "tt1"), ("tt", BAD), ("nm1", BAD), ("tt1\n", BAD), ("\\N", BAD), (None, BAD)],
    "nconst": [("nm01", "nm01"), ("tt1", BAD), ("", BAD)],
    "optional_nconst": [("\\N", None), ("", None), (None, None), ("nm7", "nm7"), ("x", BAD)],
    "metadata": [(None, "{}"), ('{"a": 1}', '{"a":1}'), ("[1]", BAD), ("x", BAD), ('"{}"', BAD), ("{} x", BAD)],
}


@pytest.mark.parametrize("name", CASES)
def test_converter(spark, name):
    texts = [t for t, _ in CASES[name]]
    values, errors = convert(spark, name, texts)
    shown = [str(v) if name == "rating" and v is not None and v is not BAD else v for v in values]
    assert shown == [v for _, v in CASES[name]]
    assert all((e is not None) == (v is BAD) for e, v in zip(errors, values))


def test_null_input_has_a_reason(spark):
    assert convert(spark, "tconst", [None])[1] == ["invalid tconst: null"]


def test_compact_json_takes_long_strings(spark):
    text = json.dumps({"k": "a\\\"b " * 50_000, "l": [1, 2]}, indent=2)
    row = spark.createDataFrame([(text,)], "t STRING").select(F.expr(COMPACT.format("t"))).head()
    assert row[0] == json.dumps(json.loads(text), separators=(",", ":"))


def test_reason_is_the_first_failing_field(spark):
    dataset = DATASETS["title_basics"]
    names = [f.source for f in dataset.fields]
    row = ["xx1", "movie", "T", "T", "maybe", "19x5", "\\N", "1.5", ""]
    raw = spark.createDataFrame([row], ", ".join(f"{n} STRING" for n in names))
    assert classify(raw, dataset).head().reason == "invalid tconst: 'xx1'"
    row[0] = "tt1"
    raw = spark.createDataFrame([row], raw.schema)
    assert classify(raw, dataset).head().reason == "invalid boolean: 'maybe'"


def test_required_integer(spark):
    dataset = DATASETS["title_akas"]
    names = [f.source for f in dataset.fields]
    raw = spark.createDataFrame(
        [["tt1", "", *["\\N"] * 6]], ", ".join(f"{n} STRING" for n in names)
    )
    assert classify(raw, dataset).head().reason == "required field 'ordering' is null"


def messages(spark, *payloads):
    rows = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return normalize_messages(spark.createDataFrame(rows, "id BIGINT, payload STRING"))


def basics(**data):
    return {"table": "title_basics", "data": {"tconst": "tt1", **data}}


def test_json_values_convert_by_type(spark):
    out = messages(
        spark,
        basics(start_year=1999, is_adult=True, genres=["A", "", None, "B"], runtime_minutes=5.7),
        basics(start_year="1_999", is_adult="0", genres="A,,B", metadata={"a": {"b": 1}}),
        basics(start_year=True),
        basics(start_year="5.7"),
        basics(genres=None, start_year=None, unknown=[1]),
        basics(metadata=[1]),
        json.dumps(json.dumps(basics())),
    )
    good = accepted_messages(out, DATASETS["title_basics"], "id").orderBy("id").collect()
    assert [r.id for r in good] == [0, 1, 4, 6]
    first, second = good[0], good[1]
    assert (first.start_year, first.is_adult, first.runtime_minutes) == (1999, True, 5)
    assert first.genres == ["A", "B"] and first.metadata == "{}"
    assert (second.start_year, second.is_adult, second.genres) == (1999, False, ["A", "B"])
    assert json.loads(second.metadata) == {"a": {"b": 1}}
    assert good[2].genres is None and good[2].start_year is None
    reasons = {r.id: r.reason for r in out.collect()}
    assert reasons[2] == "invalid integer: 'true'"
    assert reasons[3] == "invalid integer: '5.7'"
    assert reasons[5] == "metadata must be a JSON object"


def test_message_routing_reasons(spark):
    out = messages(
        spark,
        "[1]", "{", '{"table":"title_crew","data":{"tconst":"tt1"}} x', '{"unexpected":true}', '{"table":"nope","data":{}}',
        '{"table":"title_crew","data":"{}"}', '{"table":"title_principals","data":{"ordering":1}}',
        '{"table":"title_principals","data":{}}', '{"table":5,"data":{}}',
        '{"table":"title_principals","data":{"tconst":"tt1","ordering":1,"characters":["A b"]}}',
    ).orderBy("id").collect()
    assert [r.reason for r in out] == [
        "payload must be a JSON object", "payload must be a JSON object",
        "payload must be a JSON object", "unsupported table: null", "unsupported table: 'nope'",
        "payload.data must be a JSON object", "missing required fields: tconst",
        "missing required fields: tconst, ordering", "unsupported table: '5'", None,
    ]
    assert out[-1].record.characters == '["A b"]' and out[-1].record.nconst is None


def test_json_containment(spark):
    docs = ['{"a":{"b":1},"t":["x","y"],"s":"v"}', '{"a":{"b":"1"}}', '{"t":["x"]}', "[", None, "{}", "{}]"]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i INT, d STRING")

    def hits(pattern):
        return sorted(r.i for r in json_contains(rows, "d", pattern).collect())

    assert hits({"a": {"b": 1}}) == [0]
    assert hits({"a": {"b": "1"}}) == [1]
    assert hits({"t": ["x"]}) == [0, 2]
    assert hits({"t": ["y", "x"], "s": "v"}) == [0]
    assert hits({}) == [0, 1, 2, 5]
    assert hits({"s": None}) == []


def test_large_payloads_have_a_reason_of_their_own(spark):
    broken = "{" + " " * LARGE_BYTES
    good = '{"table":"title_crew","data":{"tconst":"tt1"' + " " * LARGE_BYTES + "}}"
    out = messages(spark, broken, good).orderBy("id").select("reason").collect()
    assert [r.reason for r in out] == ["payload is too large for the parser, or not JSON", None]
