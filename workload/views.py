"""The supplied tables in the shape of the catalogue and queue tables.

Each view is one projection of one supplied table (names: a union of two), so it adds no
shuffle and no grouping to the query under test at any scale, and whatever skew the supplied
tables hold reaches the query. Compared with the draft in FIXTURES.md the arrays also hold
NULL elements, repeated elements and empty arrays, ratings hold NULLs, and ids are not cut
to seven digits, so the a/b variants of the scenarios give different answers here. Orders in
progress have no rating, those of 1996 no crew, customers in debt and the smallest parts no
name: joins meet missing partners on every side.

Every expression is written once; ``Dialect`` covers the few spellings in which Spark and
DuckDB differ.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

AS_OF = "2024-01-15 00:00:00"

GENRES = (
    "Action", "Adventure", "Animation", "Biography", "Comedy", "Crime", "Documentary", "Drama",
    "Family", "Fantasy", "Film-Noir", "History", "Horror", "Music", "Musical", "Mystery",
    "News", "Romance", "Sci-Fi", "Short", "Sport", "Thriller", "War", "Western",
)


@dataclass(frozen=True)
class Dialect:
    spark: bool

    def array(self, *items: str) -> str:
        inner = ", ".join(items)
        return f"array({inner})" if self.spark else f"[{inner}]"

    def no_strings(self) -> str:
        return "cast(array() AS array<string>)" if self.spark else "cast([] AS varchar[])"

    def null_strings(self) -> str:
        return f"cast(NULL AS {'array<string>' if self.spark else 'varchar[]'})"

    def pick(self, items: tuple[str, ...], index: str) -> str:
        literal = self.array(*(f"'{item}'" for item in items))
        at = f"cast({index} AS int)"
        return f"{literal}[{at}]" if self.spark else f"({literal})[{at} + 1]"

    def div(self, a: str, b: int) -> str:
        return f"({a} div {b})" if self.spark else f"({a} // {b})"

    def timestamp(self, text: str) -> str:
        return f"timestamp_ntz'{text}'" if self.spark else f"timestamp'{text}'"


SPARK = Dialect(True)
DUCK = Dialect(False)


def _title_basics(d: Dialect) -> str:
    first = d.pick(GENRES, "o_orderkey % 24")
    second = d.pick(GENRES, "o_custkey % 24")
    third = f"CASE WHEN o_orderkey % 37 <> 0 THEN {d.pick(GENRES, 'floor(o_totalprice) % 24')} END"
    return f"""
SELECT concat('tt', cast(o_orderkey AS string)) AS tconst,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'movie' WHEN '2-HIGH' THEN 'movie'
            WHEN '3-MEDIUM' THEN 'tvSeries' WHEN '4-NOT SPECIFIED' THEN 'tvMiniSeries'
            ELSE 'tvEpisode' END AS title_type,
       concat('Title ', cast(o_orderkey AS string)) AS primary_title,
       concat('Title ', cast(o_orderkey AS string)) AS original_title,
       o_orderkey % 29 = 0 AS is_adult,
       CASE WHEN o_orderkey % 31 <> 0
            THEN cast(year(o_orderdate) + o_orderkey % 20 AS int) END AS start_year,
       cast(NULL AS int) AS end_year,
       CASE WHEN o_orderkey % 10 <> 0 THEN cast(floor(o_totalprice / 2500) AS int) END AS runtime_minutes,
       CASE WHEN o_orderkey % 59 = 0 THEN {d.null_strings()}
            WHEN o_orderkey % 47 = 0 THEN {d.no_strings()}
            WHEN o_orderkey % 3 = 0 THEN {d.array(first)}
            WHEN o_orderkey % 3 = 1 THEN {d.array(first, second)}
            ELSE {d.array(first, second, third)} END AS genres
FROM orders"""


def _title_ratings(d: Dialect) -> str:
    """Ratings of partly filled orders are of titles that no other view has (tt0...)."""
    return """
SELECT concat(CASE WHEN o_orderstatus = 'P' THEN 'tt0' ELSE 'tt' END, cast(o_orderkey AS string)) AS tconst,
       CASE WHEN o_orderkey % 101 <> 0
            THEN cast(cast(10 + (o_orderkey * 37) % 91 AS decimal(6,1)) * cast(0.1 AS decimal(2,1))
                      AS decimal(3,1)) END AS average_rating,
       cast(floor(o_totalprice / 100) AS int) AS num_votes
FROM orders"""


def _name_basics(d: Dialect) -> str:
    """Some people are known by an id that no other view refers to (nm0...)."""
    return """
SELECT concat(CASE WHEN c_acctbal < 0 THEN 'nm01' ELSE 'nm1' END, cast(c_custkey AS string)) AS nconst,
       c_name AS primary_name
FROM customer
UNION ALL
SELECT concat(CASE WHEN p_size = 1 THEN 'nm02' ELSE 'nm2' END, cast(p_partkey AS string)) AS nconst,
       p_name AS primary_name
FROM part"""


def _title_crew(d: Dialect) -> str:
    own = "concat('nm1', cast(o_custkey AS string))"
    busy = "concat('nm1', cast(o_custkey % 100 AS string))"
    return f"""
SELECT concat(CASE WHEN year(o_orderdate) = 1996 THEN 'tt0' ELSE 'tt' END,
              cast(o_orderkey AS string)) AS tconst,
       CASE WHEN o_orderkey % 41 = 0 THEN {d.null_strings()}
            WHEN o_orderkey % 43 = 0 THEN {d.no_strings()}
            WHEN o_orderkey % 11 = 0 THEN {d.array(own, "NULL", own)}
            WHEN o_orderkey % 3 = 0 THEN {d.array(own, busy)}
            ELSE {d.array(own)} END AS directors
FROM orders"""


def _title_principals(d: Dialect) -> str:
    return """
SELECT concat('tt', cast(l_orderkey AS string)) AS tconst,
       l_linenumber AS ordering,
       CASE WHEN l_partkey % 71 <> 0 THEN concat('nm2', cast(l_partkey AS string)) END AS nconst,
       CASE WHEN l_quantity <= 5 THEN 'actor' WHEN l_quantity <= 10 THEN 'actress'
            WHEN l_quantity <= 15 THEN 'self' WHEN l_quantity <= 30 THEN 'producer'
            ELSE 'writer' END AS category
FROM lineitem"""


def _title_episode(d: Dialect) -> str:
    return """
SELECT concat('tt9', cast(l_orderkey * 10 + l_linenumber AS string)) AS tconst,
       concat('tt', cast(l_orderkey AS string)) AS parent_tconst,
       CASE WHEN l_quantity <> 50 THEN l_linenumber - 1 END AS season_number,
       l_linenumber AS episode_number
FROM lineitem"""


def _title_akas(d: Dialect) -> str:
    return """
SELECT concat('tt', cast(doc_id % 400 AS string)) AS title_id,
       cast(floor(doc_id / 400) AS int) + 1 AS ordering,
       text AS title, upper(lang) AS region, lang AS language,
       doc_id < 400 AS is_original_title
FROM documents"""


def _message_queue(d: Dialect) -> str:
    return """
SELECT event_id AS id, concat('q', cast(user_id % 5 AS string)) AS queue_name, props AS payload,
       CASE event_type WHEN 'click' THEN 'processing' WHEN 'purchase' THEN 'done'
            WHEN 'error' THEN 'failed' ELSE 'pending' END AS status,
       ts AS created_at, ts AS updated_at,
       cast(event_id % 6 AS int) AS attempt_count, 5 AS max_attempts, ts AS available_at,
       CASE WHEN event_type = 'click' THEN ts END AS processing_started_at,
       CASE WHEN event_type = 'purchase' THEN ts END AS completed_at,
       CASE WHEN event_type = 'error' AND event_id % 7 <> 0 THEN ts END AS failed_at,
       CASE WHEN event_id % 9 = 0 THEN '' WHEN event_id % 9 = 1 THEN 'boom' END AS last_error
FROM events"""


def _raw_title_basics(d: Dialect) -> str:
    return """
SELECT event_id + 2 AS source_line,
       CASE WHEN event_id % 97 = 0 THEN concat('xx', cast(event_id AS string))
            WHEN event_id % 61 = 0 THEN concat(chr(92), 'N')
            ELSE concat('tt', cast(event_id AS string)) END AS tconst,
       event_type AS titleType, concat('T', cast(event_id AS string)) AS primaryTitle,
       CASE WHEN event_id % 19 = 0 THEN '' ELSE concat('T', cast(event_id AS string)) END AS originalTitle,
       CASE WHEN event_id % 53 = 0 THEN 'maybe' WHEN event_id % 7 = 0 THEN concat(chr(92), 'N')
            WHEN event_id % 3 = 0 THEN ' TRUE ' ELSE '0' END AS isAdult,
       CASE WHEN event_id % 89 = 0 THEN '19x5' WHEN event_id % 11 = 0 THEN concat(chr(92), 'N')
            WHEN event_id % 12 = 0 THEN '' WHEN event_id % 23 = 0 THEN ' 1_984 '
            ELSE cast(1950 + event_id % 70 AS string) END AS startYear,
       concat(chr(92), 'N') AS endYear,
       CASE WHEN event_id % 71 = 0 THEN '1.5' WHEN event_id % 73 = 0 THEN '99999999999'
            ELSE cast(event_id % 200 AS string) END AS runtimeMinutes,
       CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 13 = 0 THEN 'Drama,,Comedy,'
            WHEN event_id % 5 = 0 THEN concat(chr(92), 'N') ELSE 'Action,Drama' END AS genres
FROM events"""


_MARK = "concat(chr(92), 'N')"


def _raw_name_basics(d: Dialect) -> str:
    return f"""
SELECT c_custkey + 2 AS source_line,
       CASE WHEN c_custkey % 50 = 3 THEN concat('tt', cast(c_custkey AS string))
            WHEN c_custkey % 70 = 5 THEN {_MARK}
            ELSE concat('nm', cast(c_custkey AS string)) END AS nconst,
       c_name AS primaryName,
       CASE WHEN c_custkey % 9 = 0 THEN {_MARK} WHEN c_custkey % 31 = 0 THEN 'unknown'
            ELSE cast(1900 + c_custkey % 100 AS string) END AS birthYear,
       CASE WHEN c_custkey % 4 = 0 THEN '' ELSE {_MARK} END AS deathYear,
       concat(lower(c_mktsegment), ',,actor') AS primaryProfession,
       CASE WHEN c_custkey % 5 = 0 THEN {_MARK}
            ELSE concat('tt', cast(c_custkey AS string), ',tt7') END AS knownForTitles
FROM customer"""


def _raw_title_ratings(d: Dialect) -> str:
    tenths = "((o_orderkey * 37) % 101)"
    return f"""
SELECT o_orderkey + 2 AS source_line, concat('tt', cast(o_orderkey AS string)) AS tconst,
       CASE WHEN o_orderkey % 83 = 0 THEN 'NaN' WHEN o_orderkey % 79 = 0 THEN '10.01'
            WHEN o_orderkey % 77 = 0 THEN '8.25' WHEN o_orderkey % 73 = 0 THEN '1e1'
            WHEN o_orderkey % 71 = 0 THEN '' WHEN o_orderkey % 67 = 0 THEN '-0.1'
            ELSE concat(cast({d.div(tenths, 10)} AS string), '.', cast({tenths} % 10 AS string)) END AS averageRating,
       cast(cast(floor(o_totalprice) AS bigint) AS string) AS numVotes
FROM orders"""


def _raw_title_crew(d: Dialect) -> str:
    return f"""
SELECT o_orderkey + 2 AS source_line, concat('tt', cast(o_orderkey AS string)) AS tconst,
       concat('nm', cast(o_custkey AS string), ',nm', cast(o_custkey % 100 AS string)) AS directors,
       CASE WHEN o_orderkey % 3 = 0 THEN {_MARK} WHEN o_orderkey % 3 = 1 THEN '' ELSE 'nm1,' END AS writers
FROM orders"""


def _raw_title_episode(d: Dialect) -> str:
    return f"""
SELECT l_orderkey * 10 + l_linenumber AS source_line,
       concat('tt9', cast(l_orderkey * 10 + l_linenumber AS string)) AS tconst,
       CASE WHEN l_partkey % 97 = 0 THEN {_MARK}
            ELSE concat('tt', cast(l_orderkey AS string)) END AS parentTconst,
       CASE WHEN l_quantity = 50 THEN {_MARK} WHEN l_partkey % 89 = 0 THEN 'S1'
            ELSE cast(l_linenumber - 1 AS string) END AS seasonNumber,
       cast(l_linenumber AS string) AS episodeNumber
FROM lineitem"""


def _raw_title_akas(d: Dialect) -> str:
    return f"""
SELECT doc_id + 2 AS source_line, concat('tt', cast(doc_id % 400 AS string)) AS titleId,
       CASE WHEN doc_id % 29 = 0 THEN '' ELSE cast(doc_id AS string) END AS ordering, text AS title,
       upper(lang) AS region, CASE WHEN doc_id % 3 = 0 THEN {_MARK} ELSE lang END AS language,
       CASE WHEN doc_id % 2 = 0 THEN 'display' ELSE {_MARK} END AS types, source AS attributes,
       CASE WHEN doc_id % 37 = 0 THEN 'y' WHEN doc_id % 5 = 0 THEN {_MARK}
            WHEN doc_id % 5 = 1 THEN 'True' ELSE '0' END AS isOriginalTitle
FROM documents"""


def _raw_title_principals(d: Dialect) -> str:
    return f"""
SELECT l_orderkey * 10 + l_linenumber AS source_line,
       concat('tt', cast(l_orderkey AS string)) AS tconst, cast(l_linenumber AS string) AS ordering,
       CASE WHEN l_partkey % 71 = 0 THEN '' WHEN l_partkey % 73 = 0 THEN {_MARK}
            WHEN l_partkey % 79 = 0 THEN 'x1' ELSE concat('nm', cast(l_partkey AS string)) END AS nconst,
       CASE WHEN l_quantity <= 10 THEN 'actor' ELSE 'writer' END AS category, {_MARK} AS job,
       CASE WHEN l_partkey % 11 = 0 THEN {_MARK} WHEN l_partkey % 83 = 0 THEN '["cut'
            WHEN l_partkey % 2 = 0 THEN concat('[ "Role ', cast(l_suppkey AS string), '" , "A  B" ]')
            ELSE '["Self"]' END AS characters
FROM lineitem"""


def _ingest_messages(d: Dialect) -> str:
    key = d.div("event_id", 3)
    return f"""
SELECT event_id AS id, ts AS created_at,
       CASE event_id % 20
         WHEN 0 THEN '{{"unexpected":true}}'
         WHEN 1 THEN '{{"table":"nope","data":{{}}}}'
         WHEN 2 THEN '{{"table":"title_ratings","data":[]}}'
         WHEN 3 THEN '{{"table":"title_ratings","data":{{"average_rating":"5.0"}}}}'
         WHEN 4 THEN '[1]'
         WHEN 5 THEN concat('{{"table":"title_ratings","data":{{"tconst":"tt', cast(event_id AS string), '","average_rating":"11.0","num_votes":1}}}}')
         WHEN 6 THEN concat('{{"table":"title_crew","data":{{"tconst":"tt', cast({key} AS string), '","directors":["nm1","","nm2"]}}}}')
         WHEN 7 THEN concat('{{"table":"title_ratings","data":{{"tconst":"tt7","average_rating":8.25,"num_votes":', cast(event_id AS string), '}}}}')
         WHEN 8 THEN '{{"table":'
         ELSE concat('{{"table":"title_ratings","data":{{"tconst":"tt', cast({key} AS string),
                     '","average_rating":"', cast(event_id % 10 AS string), '.5","num_votes":', cast(event_id AS string), '}}}}')
       END AS payload
FROM events"""


def _catalog_messages(d: Dialect) -> str:
    """Messages of all seven tables: of twenty consecutive events, those of one title and one name.

    Every ninth title and name is missing (its message repeats the one before), keys come more
    than once, and some messages are of no table, hold no valid key or a rating beyond its range.
    """
    k = d.div("event_id", 20)
    title = f"cast({k} - CASE WHEN {k} % 9 = 4 THEN 1 ELSE 0 END AS string)"
    name = f"cast({k} - CASE WHEN {k} % 9 = 5 THEN 1 ELSE 0 END AS string)"
    own, after = f"cast({k} AS string)", f"cast({k} + 1 AS string)"
    event = "cast(event_id AS string)"

    def message(table: str, *parts: str) -> str:
        data = ", ".join(p if p.startswith("cast(") else f"'{p}'" for p in parts)
        return f"""concat('{{"table":"{table}","data":{{', {data}, '}}}}')"""

    cases = [
        message("title_basics", '"tconst":"tt', title, '","title_type":"movie","primary_title":"T', event,
                '","start_year":"', "cast(1950 + event_id % 70 AS string)", '","genres":["Drama","","G', own, '"]'),
        message("title_basics", '"tconst":"xx', event, '","title_type":"movie"'),
        message("name_basics", '"nconst":"nm', name, '","primary_name":"N', event, '","birth_year":1970'),
        message("name_basics", '"nconst":"nm', name, '","primary_name":"late ', event, '"'),
        message("title_ratings", '"tconst":"tt', own, '","average_rating":"', "cast(event_id % 10 AS string)", '.5","num_votes":', event),
        message("title_ratings", '"tconst":"tt', own, '","average_rating":"1.0","num_votes":', event),
        message("title_ratings", '"tconst":"tt', own, '","average_rating":"11.0","num_votes":1'),
        message("title_crew", '"tconst":"tt', own, '","directors":["nm', own, '","","nm', after, '"]'),
        message("title_crew", '"tconst":"tt99', own, '","directors":["nm1"]'),
        message("title_episode", '"tconst":"tt', own, '","parent_tconst":"tt', after, '","season_number":"2","episode_number":', event),
        message("title_episode", '"tconst":"tt', own, '","parent_tconst":"tt', own, '","season_number":null'),
        *(message("title_akas", '"title_id":"tt', own, f'","ordering":{n},"title":"A', event, '","is_original_title":"1"') for n in (1, 2, 2)),
        message("title_principals", '"tconst":"tt', own, '","ordering":"1","nconst":"nm', own, '","category":"actor","characters":["Self"]'),
        message("title_principals", '"tconst":"tt', own, '","ordering":2,"nconst":null,"category":"writer"'),
        message("title_principals", '"tconst":"tt', own, '","ordering":3,"nconst":"nm', after, '","category":"self"'),
        """'{"table":"nope","data":{}}'""",
        "'[1]'",
        message("name_basics", '"nconst":"tt', event, '"'),
    ]
    whens = " ".join(f"WHEN {i} THEN {case}" for i, case in enumerate(cases))
    return f"SELECT event_id AS id, CASE event_id % 20 {whens} END AS payload FROM events"


def _source_manifest(d: Dialect) -> str:
    return """
SELECT concat(lower(n_name), '.tsv.gz') AS source_file, 'title_basics' AS table_name,
       cast(1000 + n_nationkey AS bigint) AS source_size_bytes,
       cast(n_nationkey * 10 AS bigint) AS source_mtime_ns
FROM nation"""


def _producer_progress(d: Dialect) -> str:
    return f"""
SELECT concat(CASE WHEN n_nationkey < 15 THEN '' ELSE 'old-' END, lower(n_name), '.tsv.gz') AS source_file,
       'title_basics' AS table_name,
       cast(1000 + n_nationkey + CASE WHEN n_nationkey % 5 = 0 THEN 1 ELSE 0 END AS bigint) AS source_size_bytes,
       cast(n_nationkey * 10 AS bigint) AS source_mtime_ns,
       cast(1 + n_nationkey * 100 AS bigint) AS last_line, cast(n_nationkey * 99 AS bigint) AS rows_enqueued,
       cast(n_nationkey AS bigint) AS malformed_rows, n_nationkey % 3 = 0 AS completed,
       {d.timestamp("2024-01-01 00:00:00")} AS updated_at
FROM nation"""


def _queue_ops(d: Dialect) -> str:
    """Eight consecutive events act on one message: claims, acks, nacks and plain ticks."""
    return f"""
SELECT {d.div("event_id", 8)} AS id, event_id AS seq, ts AS op_at,
       CASE event_type WHEN 'view' THEN 'claim' WHEN 'click' THEN 'claim'
            WHEN 'error' THEN 'nack' WHEN 'purchase' THEN 'ack' ELSE 'tick' END AS op,
       CASE WHEN event_type = 'error' AND event_id % 31 = 0 THEN '[permanent] bad'
            WHEN event_type = 'error' THEN concat('boom ', cast(event_id % 10 AS string)) END AS reason
FROM events"""


@dataclass(frozen=True)
class View:
    sources: tuple[str, ...]
    text: Callable[[Dialect], str]


VIEWS: dict[str, View] = {
    "title_basics": View(("orders",), _title_basics),
    "title_ratings": View(("orders",), _title_ratings),
    "name_basics": View(("customer", "part"), _name_basics),
    "title_crew": View(("orders",), _title_crew),
    "title_principals": View(("lineitem",), _title_principals),
    "title_episode": View(("lineitem",), _title_episode),
    "title_akas": View(("documents",), _title_akas),
    "message_queue": View(("events",), _message_queue),
    "raw_title_basics": View(("events",), _raw_title_basics),
    "raw_name_basics": View(("customer",), _raw_name_basics),
    "raw_title_ratings": View(("orders",), _raw_title_ratings),
    "raw_title_crew": View(("orders",), _raw_title_crew),
    "raw_title_episode": View(("lineitem",), _raw_title_episode),
    "raw_title_akas": View(("documents",), _raw_title_akas),
    "raw_title_principals": View(("lineitem",), _raw_title_principals),
    "ingest_messages": View(("events",), _ingest_messages),
    "catalog_messages": View(("events",), _catalog_messages),
    "source_manifest": View(("nation",), _source_manifest),
    "producer_progress": View(("nation",), _producer_progress),
    "queue_ops": View(("events",), _queue_ops),
}


_schemas: dict[str, StructType] = {}


def _schema(spark: SparkSession, path: str) -> StructType:
    """Schema of a supplied table, read from a file footer once per process."""
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return _schemas[path]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def _project(spark: SparkSession, spec: View, sources: dict[str, DataFrame]) -> DataFrame:
    text = spec.text(SPARK).replace("{", "{{").replace("}", "}}")
    for source in sources:
        text = text.replace(f"FROM {source}", f"FROM {{{source}}}")
    return spark.sql(text, **sources)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view as a DataFrame."""
    spec = VIEWS[name]
    return _project(spark, spec, {s: table(spark, sf_dir, s) for s in spec.sources})


def stream_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view of one supplied table as a stream over that table's files.

    The files of a finished table are in no order of time or id, so they come as one batch.
    """
    spec = VIEWS[name]
    (source,) = spec.sources
    schema = _schema(spark, f"{sf_dir}/{source}.parquet")
    # A pattern, because the file source takes a single file only as one.
    files = f"{sf_dir}/{source[:-1]}[{source[-1]}].parquet"
    return _project(spark, spec, {source: spark.readStream.schema(schema).parquet(files)})


def duck_ctes(*names: str) -> str:
    """``WITH`` clause defining the named views over the raw tables for DuckDB."""
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name].text(DUCK)})" for name in names)
