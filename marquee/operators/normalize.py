"""Raw rows and queued messages to typed records, or to dead letters with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.converters import CONVERTERS, Raw
from marquee.functions.json import bracketed, document, keep_last_key
from marquee.operators.relational import computed
from marquee.schemas import DATASETS, Dataset, Field

PERMANENT = "[permanent]"
MAX_ERROR_CHARS = 4000
# The parser's limit is on its own form of a document, a few times its text at most.
LARGE_BYTES = 16 << 20


def _error(field: Field, text: str) -> str:
    """Why the raw value in column ``text`` does not make a value for ``field``, or NULL."""
    converter = CONVERTERS[field.converter]
    value = f"record.{field.target}"
    error = converter.error(text, value)
    if field.required and converter.blank:
        missing = f'"required field \'{text.rsplit(".", 1)[-1]}\' is null"'
        error = f"coalesce({error}, CASE WHEN {value} IS NULL THEN {missing} END)"
    return error


def _struct(fields: dict[str, str]) -> str:
    return f"struct({', '.join(f'{value} AS {name}' for name, value in fields.items())})"


def classify(raw: DataFrame, dataset: Dataset, provenance: bool = False) -> DataFrame:
    """``raw`` plus ``record`` (the typed row) and ``reason`` (why it is refused, or NULL).

    The reason is the first failing field's in declared order. ``provenance`` records file
    and line in the metadata column.
    """
    keep_last_key(raw.sparkSession)
    values = {f.target: CONVERTERS[f.converter].value(Raw(f.source)) for f in dataset.fields}
    values["metadata"] = "to_json(struct(source_file, source_line))" if provenance else "'{}'"
    rows = raw.withColumn("record", F.expr(_struct(values)))
    errors = ", ".join(_error(f, f.source) for f in dataset.fields)
    return computed(rows, {"reason": F.expr(f"coalesce({errors})")})


def accepted(classified: DataFrame, *keep: str) -> DataFrame:
    """The typed rows, with the columns of ``keep`` in front."""
    return classified.filter(F.col("reason").isNull()).select(*keep, "record.*")


def dead_letters(classified: DataFrame, dataset: Dataset, *keep: str) -> DataFrame:
    """The refused rows: ``keep`` columns, reason and the raw fields as JSON."""
    return classified.filter(F.col("reason").isNotNull()).select(
        *keep, "reason", raw_json(dataset).alias("raw")
    )


def raw_json(dataset: Dataset) -> Column:
    fields = F.struct(*(f.source for f in dataset.fields))
    return F.to_json(fields, {"ignoreNullFields": "false"})


def envelope(table: str, columns: dict[str, Column]) -> Column:
    """A message payload ``{"table": ..., "data": {...}}``; nulls are written out.

    ``metadata``, JSON text in the tables, travels as an object.
    """
    opened = {
        name: F.parse_json(column) if name == "metadata" else column
        for name, column in columns.items()
    }
    data = F.struct(*(column.alias(name) for name, column in opened.items()))
    message = F.struct(F.lit(table).alias("table"), data.alias("data"))
    return F.to_json(message, {"ignoreNullFields": "false"})


def to_envelope(records: DataFrame, table: str, *keep: str) -> DataFrame:
    """The ``keep`` columns and a message payload made of the table's columns."""
    keep_last_key(records.sparkSession)
    known = (*DATASETS[table].columns, "metadata")
    columns = {c: F.col(c) for c in records.columns if c in known}
    return records.select(*keep, envelope(table, columns).alias("payload"))


def route(messages: DataFrame) -> DataFrame:
    """``messages`` plus ``table_name``, ``data`` (variant) and ``reason`` when unroutable.

    A payload that is a JSON string is read as the document that string holds.
    """
    keep_last_key(messages.sparkSession)
    blanks = F.lit(" \t\r\n")
    quoted = F.try_variant_get(F.try_parse_json("payload"), "$", "string")
    text = F.when(F.ltrim("payload", blanks).startswith('"'), quoted).otherwise(F.col("payload"))
    texts = computed(messages, {"_text": F.ltrim(text, blanks)})
    docs = computed(texts, {"_parsed": F.expr(bracketed("_text"))})
    docs = computed(docs, {"_doc": F.expr(document("_text", "_parsed"))})
    parts = computed(
        docs,
        {
            "_is_object": F.col("_doc").isNotNull() & F.col("_text").startswith("{"),
            "table_name": F.try_variant_get("_doc", "$.table", "string"),
            "data": F.try_variant_get("_doc", "$.data", "variant"),
        },
    )
    known = F.coalesce(F.col("table_name").isin(*DATASETS), F.lit(False))
    shown = F.coalesce(F.concat(F.lit("'"), F.col("table_name"), F.lit("'")), F.lit("null"))
    holds_object = F.coalesce(F.schema_of_variant("data").startswith("OBJECT"), F.lit(False))
    reason = (
        F.when(
            F.col("_doc").isNull() & (F.octet_length("payload") >= LARGE_BYTES),
            F.lit("payload is too large for the parser, or not JSON"),
        )
        .when(~F.col("_is_object"), F.lit("payload must be a JSON object"))
        .when(~known, F.concat(F.lit("unsupported table: "), shown))
        .when(~holds_object, F.lit("payload.data must be a JSON object"))
    )
    return computed(parts, {"reason": reason}).drop("_text", "_parsed", "_doc", "_is_object")


def normalize_messages(messages: DataFrame) -> DataFrame:
    """``messages`` plus ``table_name``, ``record`` and ``reason``, for all tables at once.

    ``record`` holds every field any table declares (equal names convert alike); the reason
    looks only at the fields of the message's own table. So one pass serves all tables.
    """
    fields = {f.target: f for d in DATASETS.values() for f in d.fields}
    needs = {n: CONVERTERS[f.converter].needs for n, f in fields.items()}

    def found(name: str, kind: str) -> str:
        """The field of a routed message whose table declares it."""
        tables = ", ".join(f"'{d.table}'" for d in DATASETS.values() if name in d.columns)
        get = f"try_variant_get(data, '$.{name}', '{kind}')"
        return f"CASE WHEN table_name IN ({tables}) THEN {get} END"

    texts = {n: found(n, "string") for n in fields}
    texts["metadata"] = "try_variant_get(data, '$.metadata', 'string')"
    kinds = {
        n: f"schema_of_variant({found(n, 'variant')})" for n in fields if needs[n] == "kind"
    }
    items = {
        n: f"array_compact({found(n, 'array<string>')})" for n in fields if needs[n] == "items"
    }
    raws = route(messages).withColumns(
        {"_text": F.expr(_struct(texts)), "_kind": F.expr(_struct(kinds)), "_items": F.expr(_struct(items))}
    )

    def raw(name: str) -> Raw:
        return Raw(
            f"_text.{name}",
            f"_kind.{name}" if needs[name] == "kind" else None,
            f"_items.{name}" if needs[name] == "items" else None,
        )

    values = {n: CONVERTERS[f.converter].value(raw(n)) for n, f in fields.items()}
    values["metadata"] = CONVERTERS["metadata"].value(Raw("_text.metadata"))
    rows = raws.withColumn("record", F.expr(_struct(values)))
    refused = " ".join(
        f"WHEN '{d.table}' THEN coalesce({_absent(d)}, {', '.join(_error(f, f'_text.{f.target}') for f in d.fields)})"
        for d in DATASETS.values()
    )
    note_error = "CASE WHEN record.metadata IS NULL THEN 'metadata must be a JSON object' END"
    reason = f"coalesce(_unroutable, CASE table_name {refused} END, {note_error})"
    return computed(
        rows.withColumnRenamed("reason", "_unroutable"), {"reason": F.expr(reason)}
    ).drop("_unroutable", "_text", "_kind", "_items", "data")


def _absent(dataset: Dataset) -> str:
    required = [f.target for f in dataset.fields if f.required]
    names = ", ".join(f"CASE WHEN _text.{n} IS NULL THEN '{n}' END" for n in required)
    listed = f"concat_ws(', ', {names})"
    return f"CASE WHEN {listed} <> '' THEN concat('missing required fields: ', {listed}) END"


def accepted_messages(normalized: DataFrame, dataset: Dataset, *keep: str) -> DataFrame:
    """The typed rows of one table, with the columns of ``keep`` in front."""
    mine = (F.col("table_name") == dataset.table) & F.col("reason").isNull()
    columns = [f"record.{c}" for c in (*dataset.columns, "metadata")]
    return normalized.filter(mine).select(*keep, *columns)


def permanent_reason() -> Column:
    """The reason a permanent nack carries, NULL for an accepted message."""
    text = F.concat(F.lit(f"{PERMANENT} validation error: "), F.col("reason"))
    return F.left(text, F.lit(MAX_ERROR_CHARS))
