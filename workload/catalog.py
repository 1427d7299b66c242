"""The messages of all seven tables as DuckDB SQL: which are refused, insertable, landed."""

from __future__ import annotations

import re

from workload.views import duck_ctes

#: Key, references and shown columns of each table's accepted messages; {x} is a text field.
_TABLES = {
    "title_basics": (
        "{tconst}", (),
        "{primary_title}, {start_year}, array_to_string(list_filter("
        "cast(json_extract(data, '$.genres') AS varchar[]), lambda x: x <> ''), ',')",
    ),
    "name_basics": ("{nconst}", (), "{primary_name}, {birth_year}"),
    "title_ratings": (
        "{tconst}", ("title_basics {tconst}",),
        "cast(cast({average_rating} AS decimal(3,1)) AS varchar), {num_votes}",
    ),
    "title_crew": (
        "{tconst}", ("title_basics {tconst}",),
        "array_to_string(list_filter(cast(json_extract(data, '$.directors') AS varchar[]),"
        " lambda x: x <> ''), ',')",
    ),
    "title_episode": (
        "{tconst}", ("title_basics {tconst}", "title_basics {parent_tconst}"),
        "{parent_tconst}, {season_number}, {episode_number}",
    ),
    "title_akas": (
        "{title_id} || '|' || {ordering}", ("title_basics {title_id}",), "{title}, 'true'",
    ),
    "title_principals": (
        "{tconst} || '|' || {ordering}", ("title_basics {tconst}", "name_basics {nconst}"),
        "{nconst}, {category}, cast(json_extract(data, '$.characters') AS varchar)",
    ),
}

_REFUSED = """CASE
  WHEN json_type(doc) <> 'OBJECT' THEN 'payload must be a JSON object'
  WHEN doc->>'$.table' = 'nope' THEN concat('unsupported table: ', chr(39), 'nope', chr(39))
  WHEN doc->>'$.table' = 'title_basics' AND doc->>'$.data.tconst' NOT LIKE 'tt%'
    THEN concat('invalid tconst: ', chr(39), doc->>'$.data.tconst', chr(39))
  WHEN doc->>'$.table' = 'name_basics' AND doc->>'$.data.nconst' NOT LIKE 'nm%'
    THEN concat('invalid nconst: ', chr(39), doc->>'$.data.nconst', chr(39))
  WHEN doc->>'$.data.average_rating' = '11.0' THEN concat('invalid rating: ', chr(39), '11.0', chr(39))
END"""


def _sql(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"json_extract_string(data, '$.\1')", text)


def catalog_ctes() -> str:
    """CTEs routed, accepted, insertable and landed over the view of messages."""
    accepted, waves = [], []
    for name, (key, references, shown) in _TABLES.items():
        refs = ", ".join(_sql(r.split()[1]) for r in references)
        accepted.append(
            f"SELECT id, '{name}' AS table_name, {_sql(key)} AS key,"
            f" concat_ws('|', {_sql(shown)}) AS shown, [{refs}]::varchar[] AS refs"
            f" FROM routed WHERE reason IS NULL AND table_name = '{name}'"
        )
        held = [
            f"(refs[{i}] IS NULL OR refs[{i}] IN (SELECT key FROM {r.split()[0]}_landed))"
            for i, r in enumerate(references, 1)
        ]
        waves.append(
            f"{name}_in AS (SELECT * FROM accepted WHERE "
            f"{' AND '.join([f'table_name = {name!r}', *held])}),\n"
            f"{name}_landed AS (SELECT table_name, key, shown FROM (SELECT *, row_number() OVER"
            f" (PARTITION BY key ORDER BY id) AS k FROM {name}_in) WHERE k = 1)"
        )
    union = " UNION ALL ".join
    return f"""{duck_ctes("catalog_messages")},
routed AS (SELECT id, doc->>'$.table' AS table_name, doc->'$.data' AS data, {_REFUSED} AS reason
           FROM (SELECT id, cast(payload AS json) AS doc FROM catalog_messages)),
accepted AS ({union(accepted)}),
{(","+chr(10)).join(waves)},
landed AS ({union(f"SELECT * FROM {name}_landed" for name in _TABLES)}),
insertable AS ({union(f"SELECT id FROM {name}_in" for name in _TABLES)})"""


def oracles() -> dict[str, str]:
    ctes = catalog_ctes()
    return {
        "fanout_counts": f"""{ctes}
SELECT table_name, count(*) AS accepted FROM accepted GROUP BY table_name""",
        "stream_ingest": f"{ctes} SELECT table_name, key, shown FROM landed",
        "consume_outcomes": f"""{ctes}
SELECT id, table_name,
       CASE WHEN reason IS NOT NULL THEN 'permanent'
            WHEN id IN (SELECT id FROM insertable) THEN 'ack' ELSE 'retry' END AS outcome,
       CASE WHEN reason IS NOT NULL THEN concat('[permanent] validation error: ', reason)
            WHEN id NOT IN (SELECT id FROM insertable) THEN 'a referenced row is missing' END AS reason,
       1 AS attempts
FROM routed""",
    }
