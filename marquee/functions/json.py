"""JSON expressions over text or variant columns."""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def keep_last_key(spark: SparkSession) -> None:
    """Of equal keys in a JSON object the last counts, whatever the session says otherwise.

    Spark reads the setting when a query runs, so operators that parse JSON set it for their
    session: no answer hangs on the caller's settings.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _step(path: str, name: str) -> str:
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"{path}['{escaped}']"


def _scalar(doc: Column, path: str, value: Any) -> Column:
    if value is None:
        return F.schema_of_variant(F.try_variant_get(doc, path, "variant")) == "VOID"
    if isinstance(value, bool):
        kind, wanted = "boolean", F.lit(value)
        types = ["BOOLEAN"]
    elif isinstance(value, (int, float)):
        kind, wanted = "double", F.lit(float(value))
        types = ["BIGINT", "DECIMAL", "DOUBLE"]
    else:
        kind, wanted = "string", F.lit(value)
        types = ["STRING"]
    found = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))
    of_type = reduce(lambda a, b: a | b, [found.startswith(t) for t in types])
    return of_type & (F.try_variant_get(doc, path, kind) == wanted)


def variant_contains(doc: Column, pattern: dict[str, Any], path: str = "$") -> Column:
    """JSON containment: ``doc`` (a variant) holds every key of ``pattern`` with that value.

    Nested objects recurse; a list in the pattern asks that each of its scalars be an
    element of the document's list, in any order.
    """
    parts = []
    for name, value in pattern.items():
        here = _step(path, name)
        if isinstance(value, dict):
            kind = F.schema_of_variant(F.try_variant_get(doc, here, "variant"))
            parts.append(kind.startswith("OBJECT"))
            parts.append(variant_contains(doc, value, here))
        elif isinstance(value, list):
            elements = F.transform(
                F.try_variant_get(doc, here, "array<variant>"), lambda v: F.to_json(v)
            )
            parts.append(elements.isNotNull())
            parts.extend(F.array_contains(elements, json.dumps(v)) for v in value)
        else:
            parts.append(_scalar(doc, here, value))
    return F.coalesce(reduce(lambda a, b: a & b, parts, doc.isNotNull()), F.lit(False))



def bracketed(text: str) -> str:
    """SQL for ``text`` parsed as the first of two list elements, the second being its hash.

    The JSON parser stops after one value and would take ``{} x`` for ``{}``. With the text
    inside a list, anything after its value either fails or displaces the hash.
    """
    return f"try_parse_json(concat('[', {text}, '\n,', xxhash64({text}), ']'))"


def is_document(text: str, parsed: str | None = None) -> str:
    """SQL for whether ``text`` is one JSON value; ``parsed`` is its ``bracketed`` form."""
    return f"try_variant_get({parsed or bracketed(text)}, '$[1]', 'bigint') = xxhash64({text})"


def document(text: str, parsed: str) -> str:
    """SQL for the value in ``parsed``, NULL if ``text`` is not one JSON value."""
    return f"CASE WHEN {is_document(text, parsed)} THEN try_variant_get({parsed}, '$[0]', 'variant') END"


# Drops blanks between the tokens of JSON text; key order and numbers stay as written. The
# pattern (a fixed value) matches a whole string literal, which is kept, or blanks outside one.
COMPACT = r'''regexp_replace({}, r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|\s+', '$1')'''
