"""The registered queries as DuckDB SQL over the supplied tables."""

from __future__ import annotations

from workload import catalog
from workload.views import AS_OF, duck_ctes

NOW = f"timestamp'{AS_OF}'"

# Rounded average of a decimal(3,1) column in integer arithmetic: half-up on two places.
_S = "cast(sum(cast(average_rating * 10 AS bigint)) AS bigint)"
_N = "count(average_rating)"
_AVG = f"CASE WHEN {_N} > 0 THEN ((20 * {_S} + {_N}) // (2 * {_N})) / 100.0 END"

_SERIES = "('tvSeries', 'tvMiniSeries', 'tvseries', 'tvminiseries')"


def _scenarios() -> dict[str, str]:
    basics_ratings = duck_ctes("title_basics", "title_ratings")
    people = duck_ctes("title_basics", "title_ratings", "title_crew", "name_basics")
    actors = duck_ctes("title_basics", "title_principals", "name_basics")
    episodes = duck_ctes("title_basics", "title_ratings", "title_episode")
    s2 = f"""{basics_ratings}
SELECT b.tconst, b.primary_title, b.start_year, cast(r.average_rating AS double) AS average_rating,
       r.num_votes, b.genres
FROM title_ratings r JOIN title_basics b ON b.tconst = r.tconst
WHERE r.num_votes >= 1000 AND b.title_type = 'movie'
ORDER BY r.num_votes DESC, b.tconst LIMIT 10"""
    longest = """
, entries AS (
  SELECT unnest(genres) AS genre, tconst, primary_title, runtime_minutes, start_year
  FROM title_basics WHERE title_type = 'movie' AND runtime_minutes IS NOT NULL),
ranked AS (
  SELECT e.*, row_number() OVER (PARTITION BY genre ORDER BY runtime_minutes DESC, tconst) AS genre_rank
  FROM entries e {where})"""
    return {
        "s1a_rating_by_genre": f"""{basics_ratings}
, g AS (SELECT tconst, unnest(genres) AS genre FROM title_basics WHERE title_type = 'movie')
SELECT genre, count(*) AS rated_movie_count, {_AVG} AS average_rating
FROM g JOIN title_ratings r ON r.tconst = g.tconst
WHERE genre IS NOT NULL AND average_rating IS NOT NULL GROUP BY genre""",
        "s1b_rating_stddev": f"""{basics_ratings}
, g AS (SELECT tconst, unnest(genres) AS genre FROM title_basics WHERE title_type = 'movie')
SELECT genre, count(*) AS title_count, {_AVG} AS avg_rating,
       round(stddev_samp(cast(average_rating AS double)), 2) AS stddev_rating
FROM g JOIN title_ratings r ON r.tconst = g.tconst GROUP BY genre""",
        "s2a_top_votes": s2,
        "s2b_top_votes": s2,
        "s3a_directors": f"""{people}
, d AS (SELECT DISTINCT c.tconst, c.nconst
        FROM (SELECT tconst, unnest(directors) AS nconst FROM title_crew) c
        JOIN title_basics b ON b.tconst = c.tconst
        WHERE b.title_type = 'movie' AND c.nconst IS NOT NULL)
SELECT n.nconst, n.primary_name, count(*) AS movie_count, {_AVG} AS average_movie_rating
FROM d JOIN name_basics n ON n.nconst = d.nconst LEFT JOIN title_ratings r ON r.tconst = d.tconst
GROUP BY n.nconst, n.primary_name ORDER BY movie_count DESC, n.nconst LIMIT 20""",
        "s3b_directors_min5": f"""{people}
SELECT n.nconst, n.primary_name, count(DISTINCT d.tconst) AS movie_count, {_AVG} AS avg_movie_rating
FROM (SELECT DISTINCT tconst, unnest(directors) AS nconst FROM title_crew) d
JOIN name_basics n ON n.nconst = d.nconst
JOIN title_ratings r ON r.tconst = d.tconst
JOIN title_basics b ON b.tconst = d.tconst
WHERE b.title_type = 'movie' GROUP BY n.nconst, n.primary_name
HAVING count(DISTINCT d.tconst) >= 5 ORDER BY movie_count DESC, n.nconst LIMIT 20""",
        "s4a_yearly": f"""{basics_ratings}
SELECT start_year, count(*) AS rated_movie_count, {_AVG} AS average_rating
FROM title_basics b JOIN title_ratings r ON r.tconst = b.tconst
WHERE title_type = 'movie' AND start_year >= 2000 AND average_rating IS NOT NULL GROUP BY start_year""",
        "s4b_yearly_median": f"""{basics_ratings}
SELECT start_year, count(*) AS movie_count, {_AVG} AS avg_rating,
       round(quantile_cont(cast(average_rating AS double), 0.5), 2) AS median_rating
FROM title_basics b JOIN title_ratings r ON r.tconst = b.tconst
WHERE title_type = 'movie' AND start_year >= 2000 AND num_votes >= 100 GROUP BY start_year""",
        "s5a_genre_breadth": f"""{actors}
, g AS (SELECT tconst, unnest(genres) AS genre FROM title_basics WHERE title_type = 'movie')
SELECT n.nconst, n.primary_name, count(DISTINCT genre) AS distinct_genre_count,
       list_sort(list(DISTINCT genre)) AS genres
FROM title_principals p JOIN name_basics n ON n.nconst = p.nconst JOIN g ON g.tconst = p.tconst
WHERE p.category IN ('actor', 'actress') AND genre IS NOT NULL
GROUP BY n.nconst, n.primary_name HAVING count(DISTINCT genre) > 5""",
        "s5b_genre_breadth_top20": f"""{actors}
, g AS (SELECT tconst, unnest(genres) AS genre FROM title_basics WHERE title_type = 'movie')
SELECT n.nconst, n.primary_name, count(DISTINCT genre) AS genre_count,
       list_concat(coalesce(list_sort(list(DISTINCT genre) FILTER (WHERE genre IS NOT NULL)), []),
                   CASE WHEN bool_or(genre IS NULL) THEN [NULL] ELSE [] END) AS genres_list
FROM title_principals p JOIN name_basics n ON n.nconst = p.nconst JOIN g ON g.tconst = p.tconst
WHERE p.category IN ('actor', 'actress', 'self')
GROUP BY n.nconst, n.primary_name ORDER BY genre_count DESC, n.nconst LIMIT 20""",
        "s6a_seasons": f"""{episodes}
SELECT b.tconst, b.primary_title,
       count(DISTINCT season_number) FILTER (WHERE season_number > 0) AS season_count,
       count(*) AS episode_count, cast(average_rating AS double) AS average_rating
FROM title_episode e JOIN title_basics b ON b.tconst = e.parent_tconst
LEFT JOIN title_ratings r ON r.tconst = b.tconst
WHERE title_type IN {_SERIES} GROUP BY b.tconst, b.primary_title, r.average_rating
ORDER BY season_count DESC, episode_count DESC, b.tconst LIMIT 20""",
        "s6b_max_season": f"""{episodes}
SELECT b.tconst, b.primary_title, max(season_number) AS total_seasons,
       count(DISTINCT e.tconst) AS total_episodes, {_AVG} AS avg_rating
FROM title_episode e JOIN title_basics b ON b.tconst = e.parent_tconst
LEFT JOIN title_ratings r ON r.tconst = b.tconst
WHERE title_type IN {_SERIES} GROUP BY b.tconst, b.primary_title
ORDER BY total_seasons DESC NULLS FIRST, b.tconst LIMIT 20""",
        "s7a_genre_pairs": f"""{duck_ctes("title_basics")}
, g AS (SELECT DISTINCT tconst, genre FROM
          (SELECT tconst, unnest(genres) AS genre FROM title_basics
           WHERE title_type = 'movie' AND len(genres) >= 2) WHERE genre IS NOT NULL)
SELECT a.genre AS genre_1, b.genre AS genre_2, count(*) AS movie_count
FROM g a JOIN g b ON a.tconst = b.tconst AND a.genre < b.genre
GROUP BY a.genre, b.genre ORDER BY movie_count DESC, genre_1, genre_2 LIMIT 20""",
        "s7b_genre_pairs_rated": f"""{basics_ratings}
, g AS (SELECT tconst, unnest(genres) AS genre FROM title_basics WHERE title_type = 'movie')
SELECT a.genre AS genre1, b.genre AS genre2, count(*) AS pair_count, {_AVG} AS avg_rating
FROM g a JOIN g b ON a.tconst = b.tconst AND a.genre < b.genre
JOIN title_ratings r ON r.tconst = a.tconst
GROUP BY a.genre, b.genre ORDER BY pair_count DESC, genre1, genre2 LIMIT 20""",
        "s8a_longest_by_genre": f"""{basics_ratings}{longest.format(where="WHERE genre IS NOT NULL")}
SELECT genre, cast(genre_rank AS int) AS genre_rank, k.tconst, primary_title, runtime_minutes,
       start_year, cast(average_rating AS double) AS average_rating
FROM ranked k LEFT JOIN title_ratings r ON r.tconst = k.tconst WHERE genre_rank <= 5""",
        "s8b_longest_by_genre": f"""{basics_ratings}{longest.format(where="")}
SELECT genre, k.tconst, primary_title, runtime_minutes, cast(average_rating AS double) AS average_rating
FROM ranked k LEFT JOIN title_ratings r ON r.tconst = k.tconst WHERE genre_rank <= 5""",
    }


# The converters over raw text. A backslash-N marks NULL; '' is no value for numbers.
_MARK = "chr(92) || 'N'"
_DIGITS = "regexp_replace({c}, '([0-9])_([0-9])', '\\1\\2', 'g')"
_INTEGER = (
    "CASE WHEN regexp_full_match({c}, '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*')"
    f" THEN try_cast(trim({_DIGITS}) AS int) END"
)
_BOOLEAN = (
    "CASE WHEN lower(trim({c})) IN ('1', 'true', 't', 'yes') THEN true"
    " WHEN lower(trim({c})) IN ('0', 'false', 'f', 'no') THEN false END"
)


def _text(c: str) -> str:
    return f"CASE WHEN {c} <> {_MARK} THEN {c} END"


def _error(c: str, what: str, value: str) -> str:
    return (
        f"WHEN {c} IS NOT NULL AND {c} NOT IN ({_MARK}, '') AND ({value.format(c=c)}) IS NULL"
        f" THEN concat('invalid {what}: ', chr(39), {c}, chr(39))"
    )


def _dumps() -> dict[str, str]:
    classified = f"""{duck_ctes("raw_title_basics")}
, classified AS (
  SELECT *, CASE WHEN NOT regexp_full_match(tconst, 'tt[0-9]+')
                THEN concat('invalid tconst: ', chr(39), tconst, chr(39))
              {_error("isAdult", "boolean", _BOOLEAN)}
              {_error("startYear", "integer", _INTEGER)}
              {_error("endYear", "integer", _INTEGER)}
              {_error("runtimeMinutes", "integer", _INTEGER)} END AS reason
  FROM raw_title_basics)"""
    record = f"""tconst, {_text("titleType")} AS title_type, {_text("primaryTitle")} AS primary_title,
       {_text("originalTitle")} AS original_title, {_BOOLEAN.format(c="isAdult")} AS is_adult,
       {_INTEGER.format(c="startYear")} AS start_year, {_INTEGER.format(c="endYear")} AS end_year,
       {_INTEGER.format(c="runtimeMinutes")} AS runtime_minutes,
       CASE WHEN genres <> {_MARK} THEN
         list_filter(string_split(genres, ','), lambda x: x <> '') END AS genres"""
    progress = duck_ctes("source_manifest", "producer_progress")
    same = """p.source_size_bytes = m.source_size_bytes AND p.source_mtime_ns = m.source_mtime_ns"""
    return {
        "normalize_titles": f"{classified} SELECT {record} FROM classified WHERE reason IS NULL",
        "dead_letter_titles": f"""{classified}
SELECT source_line, reason,
       to_json({{'tconst': tconst, 'titleType': titleType, 'primaryTitle': primaryTitle,
         'originalTitle': originalTitle, 'isAdult': isAdult, 'startYear': startYear,
         'endYear': endYear, 'runtimeMinutes': runtimeMinutes, 'genres': genres}}) AS raw
FROM classified WHERE reason IS NOT NULL""",
        "provenance": f"""{classified}
SELECT tconst, to_json({{'source_file': 'title.basics.tsv.gz', 'source_line': source_line}}) AS metadata
FROM classified WHERE reason IS NULL""",
        "ingest_max_rows": f"""{classified}
SELECT source_line, {record} FROM classified WHERE reason IS NULL ORDER BY source_line LIMIT 500""",
        "envelope_titles": f"""{duck_ctes("title_basics")}
SELECT tconst, 'title_basics' AS table_name, primary_title AS title,
       cast(start_year AS varchar) AS year, coalesce(len(genres), -1) AS genre_count
FROM title_basics""",
        "manifest_status": f"""{progress}
SELECT m.*, CASE WHEN p.source_file IS NULL THEN 'new' WHEN NOT ({same}) THEN 'changed'
              WHEN p.completed THEN 'complete' ELSE 'resume' END AS status,
       CASE WHEN p.source_file IS NULL THEN 1
            WHEN {same} AND NOT p.completed THEN p.last_line END AS resume_after
FROM source_manifest m LEFT JOIN producer_progress p ON p.source_file = m.source_file""",
        "progress_upsert": f"""{progress}
SELECT source_file, table_name, source_size_bytes, source_mtime_ns,
       cast(5000 AS bigint) AS last_line, cast(4999 AS bigint) AS rows_enqueued,
       cast(0 AS bigint) AS malformed_rows, true AS completed, {NOW} AS updated_at
FROM source_manifest WHERE source_size_bytes > 1010
UNION ALL
SELECT * FROM producer_progress
WHERE source_file NOT IN (SELECT source_file FROM source_manifest WHERE source_size_bytes > 1010)""",
        "progress_reset": f"""{progress}
SELECT p.* FROM producer_progress p LEFT JOIN source_manifest m ON m.source_file = p.source_file
WHERE m.source_file IS NULL OR ({same})""",
    }


_RATING = "try_cast(nullif({c}, 'NaN') AS decimal(38,20))"
_RATING = f"CASE WHEN {_RATING} BETWEEN 0 AND 10 THEN cast(cast({_RATING} AS decimal(3,1)) AS double) END"
_JSON = "CASE WHEN json_valid({c}) THEN cast(json_extract({c}, '$') AS varchar) END"
_LIST = f"CASE WHEN {{c}} <> {_MARK} THEN list_filter(string_split({{c}}, ','), lambda x: x <> '') END"


def _field(source: str, kind: str) -> tuple[str, str]:
    """(value, error) of one dump field by the name of its converter."""
    if kind in ("tconst", "nconst"):
        ok = f"regexp_full_match({source}, '{'tt' if kind == 'tconst' else 'nm'}[0-9]+')"
        value = f"CASE WHEN {ok} THEN {source} END"
        refused = f"WHEN NOT ({ok}) THEN concat('invalid {kind}: ', chr(39), {source}, chr(39))"
        return value, refused
    if kind == "text":
        return _text(source), ""
    if kind == "array":
        return _LIST.format(c=source), ""
    value, noun = {
        "integer": (_INTEGER, "integer"),
        "required": (_INTEGER, "integer"),
        "rating": (_RATING, "rating"),
        "boolean": (_BOOLEAN, "boolean"),
        "json": (_JSON, "JSON"),
        "optional": ("CASE WHEN regexp_full_match({c}, 'nm[0-9]+') THEN {c} END", "nconst"),
    }[kind]
    value = f"CASE WHEN {source} NOT IN ({_MARK}, '') THEN {value.format(c=source)} END"
    refused = (
        f"WHEN {source} NOT IN ({_MARK}, '') AND ({value}) IS NULL"
        f" THEN concat('invalid {noun}: ', chr(39), {source}, chr(39))"
    )
    if kind == "required":
        refused += f" WHEN ({value}) IS NULL THEN concat('required field ', chr(39), '{source}', chr(39), ' is null')"
    return value, refused


def _dump(view: str, fields: str) -> str:
    """Typed columns and reason of every row; ``fields`` lists source, target and converter."""
    specs = [line.split() for line in fields.strip().splitlines()]
    parts = [(target, *_field(source, kind)) for source, target, kind in specs]
    values = ", ".join(f"CASE WHEN reason IS NULL THEN {value} END AS {target}" for target, value, _ in parts)
    reason = " ".join(error for _, _, error in parts)
    return f"""{duck_ctes(view)}
, classified AS (SELECT *, CASE {reason} END AS reason FROM {view})
SELECT source_line, {values}, reason FROM classified"""


def _other_dumps() -> dict[str, str]:
    return {
        "normalize_name_basics": _dump("raw_name_basics", """
            nconst nconst nconst
            primaryName primary_name text
            birthYear birth_year integer
            deathYear death_year integer
            primaryProfession primary_profession array
            knownForTitles known_for_titles array"""),
        "normalize_title_ratings": _dump("raw_title_ratings", """
            tconst tconst tconst
            averageRating average_rating rating
            numVotes num_votes integer"""),
        "normalize_title_crew": _dump("raw_title_crew", """
            tconst tconst tconst
            directors directors array
            writers writers array"""),
        "normalize_title_episode": _dump("raw_title_episode", """
            tconst tconst tconst
            parentTconst parent_tconst tconst
            seasonNumber season_number integer
            episodeNumber episode_number integer"""),
        "normalize_title_akas": _dump("raw_title_akas", """
            titleId title_id tconst
            ordering ordering required
            title title text
            region region text
            language language text
            types types array
            attributes attributes array
            isOriginalTitle is_original_title boolean"""),
        "normalize_title_principals": _dump("raw_title_principals", """
            tconst tconst tconst
            ordering ordering required
            nconst nconst optional
            category category text
            job job text
            characters characters json"""),
    }


def _messages() -> dict[str, str]:
    routed = f"""{duck_ctes("ingest_messages", "title_ratings")}
, opened AS (SELECT id, try_cast(payload AS json) AS doc FROM ingest_messages),
named AS (
  SELECT id, coalesce(json_type(doc) = 'OBJECT', false) AS is_object,
         json_extract_string(doc, '$.table') AS table_name, json_extract(doc, '$.data') AS data
  FROM opened),
routed AS (
  SELECT id, table_name, data,
         CASE WHEN NOT is_object THEN 'payload must be a JSON object'
              WHEN table_name IS NULL THEN 'unsupported table: null'
              WHEN table_name NOT IN ('title_basics', 'name_basics', 'title_ratings', 'title_crew',
                                      'title_episode', 'title_akas', 'title_principals')
                THEN concat('unsupported table: ', chr(39), table_name, chr(39))
              WHEN json_type(data) IS DISTINCT FROM 'OBJECT' THEN 'payload.data must be a JSON object'
         END AS reason
  FROM named),
rated AS (
  SELECT id, json_extract_string(data, '$.tconst') AS tconst,
         json_extract_string(data, '$.average_rating') AS given,
         try_cast(json_extract_string(data, '$.average_rating') AS decimal(38,20)) AS number,
         cast(json_extract_string(data, '$.num_votes') AS int) AS num_votes
  FROM routed WHERE reason IS NULL AND table_name = 'title_ratings'),
ratings AS (
  SELECT id, tconst, cast(cast(number AS decimal(3,1)) AS double) AS average_rating, num_votes,
         CASE WHEN tconst IS NULL THEN 'missing required fields: tconst'
              WHEN NOT regexp_full_match(tconst, 'tt[0-9]+')
                THEN concat('invalid tconst: ', chr(39), tconst, chr(39))
              WHEN given IS NOT NULL AND NOT (number BETWEEN 0 AND 10)
                THEN concat('invalid rating: ', chr(39), given, chr(39)) END AS reason
  FROM rated),
crew AS (
  SELECT id, json_extract_string(data, '$.tconst') AS tconst,
         list_filter(cast(json_extract(data, '$.directors') AS varchar[]), lambda x: x <> '') AS directors
  FROM routed WHERE reason IS NULL AND table_name = 'title_crew')"""
    first = """SELECT tconst, average_rating, num_votes FROM (
  SELECT *, row_number() OVER (PARTITION BY tconst ORDER BY id) AS k FROM ratings WHERE reason IS NULL)
WHERE k = 1 AND tconst NOT IN (SELECT tconst FROM title_ratings)"""
    return {
        "route_messages": f"{routed} SELECT id, table_name, reason FROM routed",
        "route_duplicate_keys": f"{routed} SELECT id, table_name, reason FROM routed",
        "normalize_messages": f"""{routed}
SELECT id, CASE WHEN reason IS NULL THEN tconst END AS tconst,
       CASE WHEN reason IS NULL THEN average_rating END AS average_rating,
       CASE WHEN reason IS NULL THEN num_votes END AS num_votes, reason FROM ratings""",
        "normalize_crew_messages": f"{routed} SELECT id, tconst, directors FROM crew",
        "rejected_messages": f"""{routed}
SELECT id, concat('[permanent] validation error: ', reason) AS reason
FROM routed WHERE reason IS NOT NULL
UNION ALL
SELECT id, concat('[permanent] validation error: ', reason) FROM ratings WHERE reason IS NOT NULL""",
        "upsert_first_wins": f"{routed} {first}",
        "land_pruned": f"{routed} {first}",
        "batch_event": f"""{routed}
SELECT 'consumer_batch_complete' AS event_type,
       to_json({{'claimed': (SELECT count(*) FROM routed),
                'processed': (SELECT count(*) FROM ratings WHERE reason IS NULL)
                             + (SELECT count(*) FROM crew),
                'nacked': 0, 'failed': 0,
                'invalid': (SELECT count(*) FROM routed WHERE reason IS NOT NULL)
                           + (SELECT count(*) FROM ratings WHERE reason IS NOT NULL)}}) AS payload,
       cast(NULL AS varchar) AS source_file, {NOW} AS created_at""",
    }


def _integrity() -> dict[str, str]:
    parents = duck_ctes("title_principals", "title_basics", "name_basics")
    referenced = """(tconst IS NULL OR tconst IN (SELECT tconst FROM title_basics))
  AND (nconst IS NULL OR nconst IN (SELECT nconst FROM name_basics))"""
    return {
        "dedupe_principals": f"""{duck_ctes("title_principals")}
SELECT tconst, ordering, nconst, category FROM (
  SELECT *, row_number() OVER (PARTITION BY tconst, ordering
                               ORDER BY nconst NULLS FIRST, category) AS k FROM title_principals)
WHERE k = 1""",
        "orphans_principals": f"{parents} SELECT * FROM title_principals WHERE NOT ({referenced})",
        "insertable_principals": f"{parents} SELECT * FROM title_principals WHERE {referenced}",
        "constraint_audit": f"""{duck_ctes("message_queue", "title_principals")}
, broken AS (
  SELECT id, unnest([
    CASE WHEN status NOT IN ('pending', 'processing', 'done', 'failed') THEN 'message_queue_status' END,
    CASE WHEN attempt_count < 0 THEN 'message_queue_attempt_count' END,
    CASE WHEN max_attempts <= 0 THEN 'message_queue_max_attempts' END,
    CASE WHEN attempt_count > max_attempts THEN 'message_queue_attempt_limit' END,
    CASE WHEN status = 'failed' AND failed_at IS NULL THEN 'failed_has_time' END]) AS c
  FROM message_queue)
SELECT c AS constraint, cast(id AS varchar) AS key, cast(1 AS bigint) AS violations
FROM broken WHERE c IS NOT NULL
UNION ALL
SELECT 'message_queue_pk', cast(id AS varchar), count(*) FROM message_queue
GROUP BY id HAVING count(*) > 1
UNION ALL
SELECT 'title_principals_natural', concat(tconst, '|', ordering), count(*)
FROM title_principals GROUP BY tconst, ordering HAVING count(*) > 1""",
        "events_latest": """
SELECT event_type, event_id, ts FROM events WHERE event_type = 'error'
ORDER BY ts DESC, event_id DESC LIMIT 20""",
    }


_QUEUE_COLUMNS = (
    "id queue_name payload status created_at updated_at attempt_count max_attempts available_at "
    "processing_started_at completed_at failed_at last_error"
).split()


def _changed(changes: dict[str, str], prefix: str = "") -> str:
    return ", ".join(
        f"{changes[c]} AS {c}" if c in changes else f"{prefix}{c}" for c in _QUEUE_COLUMNS
    )


def _case(when: str, value: str, column: str) -> str:
    return f"CASE WHEN {when} THEN {value} ELSE {column} END"


def _queue() -> dict[str, str]:
    queue = duck_ctes("message_queue")
    expired = f"status = 'processing' AND processing_started_at <= {NOW} - INTERVAL 30 SECOND"
    claimable = (
        "attempt_count < max_attempts AND"
        f" ((status = 'pending' AND available_at <= {NOW}) OR ({expired}))"
    )
    exhausted = f"queue_name = 'q1' AND {expired} AND attempt_count >= max_attempts"
    expire = {
        "status": _case(exhausted, "'failed'", "status"),
        "failed_at": _case(exhausted, NOW, "failed_at"),
        "processing_started_at": _case(exhausted, "NULL", "processing_started_at"),
        "last_error": _case(
            exhausted,
            "coalesce(nullif(last_error, ''), 'visibility timeout expired after maximum attempts')",
            "last_error",
        ),
        "updated_at": _case(exhausted, NOW, "updated_at"),
    }
    claim = f"""claim AS (SELECT id AS cid FROM message_queue
  WHERE queue_name = 'q1' AND {claimable} ORDER BY id LIMIT 10)"""
    hit = "cid IS NOT NULL"
    claimed = {
        "status": _case(hit, "'processing'", "status"),
        "attempt_count": _case(hit, "attempt_count + 1", "attempt_count"),
        "processing_started_at": _case(hit, NOW, "processing_started_at"),
        "completed_at": _case(hit, "NULL", "completed_at"),
        "failed_at": _case(hit, "NULL", "failed_at"),
        "last_error": _case(
            f"{hit} AND status = 'processing'",
            "coalesce(nullif(last_error, ''), 'visibility timeout expired; message reclaimed')",
            "last_error",
        ),
        "updated_at": _case(hit, NOW, "updated_at"),
    }
    acked = "o_orderkey IS NOT NULL AND status IN ('processing', 'done')"
    ack = {
        "status": _case(acked, "'done'", "status"),
        "completed_at": _case(acked, f"coalesce(completed_at, {NOW})", "completed_at"),
        "processing_started_at": _case(acked, "NULL", "processing_started_at"),
        "failed_at": _case(acked, "NULL", "failed_at"),
        "updated_at": _case(acked, NOW, "updated_at"),
    }
    closed = "status IN ('done', 'failed')"
    final = "(starts_with(coalesce(reason, ''), '[permanent]') OR attempt_count >= max_attempts)"
    delay = "to_seconds(least(300, cast(pow(2, greatest(attempt_count - 1, 0)) AS int)))"
    nack = {
        "status": f"CASE WHEN {closed} THEN status WHEN {final} THEN 'failed' ELSE 'pending' END",
        "available_at": _case(f"{closed} OR {final}", "available_at", f"{NOW} + {delay}"),
        "processing_started_at": _case(closed, "processing_started_at", "NULL"),
        "failed_at": f"""CASE WHEN status = 'failed' THEN coalesce(failed_at, {NOW})
            WHEN status = 'done' THEN failed_at WHEN {final} THEN {NOW} END""",
        "last_error": _case(closed, "last_error", "left(coalesce(reason, ''), 4000)"),
        "updated_at": _case(closed, "updated_at", NOW),
    }
    victims = f"""victims AS (
  SELECT id FROM message_queue WHERE queue_name = 'q1' AND status = 'done'
    AND completed_at <= {NOW} - INTERVAL 2 MINUTE ORDER BY id LIMIT 5000)"""
    counts = """count(*) FILTER (WHERE status = 'pending') AS pending,
       count(*) FILTER (WHERE status = 'processing') AS processing,
       count(*) FILTER (WHERE status = 'done') AS done,
       count(*) FILTER (WHERE status = 'failed') AS failed, count(*) AS total,
       min(created_at) FILTER (WHERE status = 'pending') AS oldest_pending_at"""
    def step(name: str, changes: dict[str, str], before: str) -> str:
        return f"{name} AS (SELECT {_changed(changes)} FROM {before})"

    even = {c: v.replace("o_orderkey IS NOT NULL", "cid % 2 = 0") for c, v in ack.items()}
    given = {c: _case("seq IS NOT NULL", v, c) for c, v in nack.items()}
    stored = ",\n".join([
        f"""q0 AS (SELECT {', '.join(_QUEUE_COLUMNS)} FROM message_queue UNION ALL
  SELECT -1 - (conv_id * 1000 + turn), role, to_json({{'text': text}}), 'pending', {NOW}, {NOW}, 0, 5,
         {NOW}, NULL, NULL, NULL, NULL FROM conversations
  WHERE text IS NOT NULL AND trim(role) <> '')""",
        f"""claim AS (SELECT id AS cid FROM q0
  WHERE queue_name = 'q1' AND {claimable} ORDER BY id LIMIT 100)""",
        step("q1", expire, "q0"),
        step("q2", claimed, "q1 LEFT JOIN claim ON cid = id"),
        step("q3", even, "q2 LEFT JOIN claim ON cid = id"),
        """why AS (SELECT cid AS seq, CASE WHEN cid % 3 = 0 THEN '[permanent] bad' ELSE 'boom' END
  AS reason FROM claim WHERE cid % 2 <> 0)""",
        step("q4", given, "q3 LEFT JOIN why ON seq = id"),
        victims.replace("message_queue", "q4"),
        "kept AS (SELECT * FROM q4 WHERE id NOT IN (SELECT id FROM victims))",
    ])
    return {
        "queue_store_roundtrip": f"{queue}, {stored} SELECT * FROM kept",
        "queue_metrics_incremental": f"""{queue}, {stored}
SELECT queue_name, {counts} FROM kept GROUP BY queue_name""",
        "queue_enqueue": f"""
SELECT conv_id * 1000 + turn AS id, role AS queue_name, to_json({{'text': text}}) AS payload,
       'pending' AS status, {NOW} AS created_at, {NOW} AS updated_at, 0 AS attempt_count,
       5 AS max_attempts, {NOW} AS available_at, cast(NULL AS timestamp) AS processing_started_at,
       cast(NULL AS timestamp) AS completed_at, cast(NULL AS timestamp) AS failed_at,
       cast(NULL AS varchar) AS last_error
FROM conversations WHERE text IS NOT NULL AND trim(role) <> ''""",
        "queue_expire": f"{queue} SELECT {_changed(expire)} FROM message_queue",
        "queue_claim": f"""{queue}, {claim}
SELECT id AS msg_id, payload FROM message_queue JOIN claim ON cid = id""",
        "queue_claim_all": f"""{queue}
SELECT queue_name, id, cast(k AS int) AS position FROM (
  SELECT queue_name, id, row_number() OVER (PARTITION BY queue_name ORDER BY id) AS k
  FROM message_queue WHERE {claimable}) WHERE k <= 100""",
        "queue_after_dequeue": f"""{queue}, {claim},
expired AS (SELECT {_changed(expire)} FROM message_queue)
SELECT {_changed(claimed)} FROM expired LEFT JOIN claim ON cid = id""",
        "queue_ack": f"""{queue}
SELECT {_changed(ack)} FROM message_queue
LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) ON o_orderkey = id""",
        "queue_nack": f"""{duck_ctes("message_queue", "queue_ops")}
SELECT {_changed(nack)} FROM message_queue JOIN (SELECT seq, reason FROM queue_ops) ON seq = id""",
        "queue_metrics": f"{queue} SELECT queue_name, {counts} FROM message_queue GROUP BY queue_name",
        "queue_metrics_one": f"""{queue}
SELECT queue_name, {counts} FROM message_queue WHERE queue_name = 'q3' GROUP BY queue_name""",
        "queue_inflight": f"""{queue}
SELECT count(*) AS inflight FROM message_queue
WHERE queue_name = 'q1' AND status IN ('pending', 'processing')""",
        "queue_backpressure": f"""{queue}
, moves AS (
  SELECT queue_name, created_at AS moved, 1 AS delta FROM message_queue
  UNION ALL
  SELECT queue_name, coalesce(completed_at, failed_at, updated_at), -1 FROM message_queue
  WHERE status IN ('done', 'failed')),
steps AS (
  SELECT queue_name, date_trunc('hour', moved) + INTERVAL 1 HOUR AS step_end, sum(delta) AS delta
  FROM moves WHERE moved IS NOT NULL GROUP BY ALL),
depths AS (
  SELECT queue_name, step_end, cast(sum(delta) OVER (PARTITION BY queue_name ORDER BY step_end) AS bigint) AS depth
  FROM steps)
SELECT queue_name, step_end, depth,
       coalesce(last_value(CASE WHEN depth >= 500 THEN true WHEN depth <= 250 THEN false END IGNORE NULLS)
                OVER (PARTITION BY queue_name ORDER BY step_end), false) AS paused
FROM depths""",
        "queue_purge_victims": f"{queue}, {victims} SELECT id FROM victims",
        "queue_after_purge": f"""{queue}, {victims}
SELECT * FROM message_queue WHERE id NOT IN (SELECT id FROM victims)""",
    }


def _tables() -> dict[str, str]:
    basics = duck_ctes("title_basics")
    opened = "(SELECT unnest(genres) AS value, tconst FROM title_basics)"
    stats = " UNION ALL ".join(
        f"""SELECT '{c}' AS column, count(*) AS rows, count(*) - count({c}) AS nulls,
       count(DISTINCT {c}) AS distinct_values, cast(min({c}) AS varchar) AS smallest,
       cast(max({c}) AS varchar) AS largest FROM title_ratings"""
        for c in ("tconst", "average_rating", "num_votes")
    )
    return {
        "array_any_join": f"""{duck_ctes("title_crew", "name_basics")}
SELECT c.tconst, n.nconst, n.primary_name
FROM (SELECT DISTINCT tconst, unnest(directors) AS nconst FROM title_crew) c
JOIN name_basics n ON n.nconst = c.nconst""",
        "genres_contains_all": f"""{basics}
SELECT tconst, genres FROM title_basics WHERE list_has_all(genres, ['Drama', 'Comedy'])""",
        "genres_by_postings": f"""{basics}
SELECT tconst, genres FROM title_basics WHERE list_has_all(genres, ['Drama', 'Comedy'])""",
        "genres_overlap": f"""{basics}
SELECT tconst, genres FROM title_basics WHERE list_has_any(genres, ['Film-Noir', 'Western'])""",
        "json_path_filter": """
SELECT event_id, props FROM events
WHERE json_extract_string(try_cast(props AS json), '$.k') = '42'""",
        "genre_postings": f"""{basics}
SELECT DISTINCT value, tconst FROM {opened} WHERE value IS NOT NULL""",
        "genre_posting_counts": f"""{basics}
SELECT value, count(DISTINCT tconst) AS n FROM {opened} WHERE value IS NOT NULL GROUP BY value""",
        "column_stats": f"{duck_ctes('title_ratings')} {stats}",
        "column_stats_merged": f"""{duck_ctes('title_ratings')}
SELECT "column", "rows", nulls, smallest, largest, true AS near FROM ({stats})""",
        "curate_movies": f"""{basics}
SELECT start_year, tconst, primary_title, genres, runtime_minutes FROM title_basics
WHERE title_type = 'movie'""",
        "curate_by_runtime": f"""{basics}
SELECT runtime_minutes, tconst, primary_title, genres FROM title_basics
WHERE title_type = 'movie' AND runtime_minutes IS NOT NULL""",
        "curate_top_votes": f"""{duck_ctes("title_ratings")}
SELECT num_votes, tconst, cast(average_rating AS double) AS average_rating FROM title_ratings
WHERE num_votes >= 1000""",
        "curate_actors": f"""{duck_ctes("title_principals")}
SELECT nconst, tconst FROM title_principals WHERE category IN ('actor', 'actress')""",
    }


def _streams() -> dict[str, str]:
    ops = duck_ctes("queue_ops").replace("WITH ", "WITH RECURSIVE ", 1)
    half_minute = "INTERVAL 30 SECOND"
    delay = "to_seconds(least(300, cast(pow(2, greatest(attempts - 1, 0)) AS int)))"
    expired = "coalesce(nullif(last_error, ''), 'visibility timeout expired after maximum attempts')"
    reclaimed = "coalesce(nullif(last_error, ''), 'visibility timeout expired; message reclaimed')"

    def settled(at: str) -> str:
        over = f"(status = 'processing' AND attempts >= 5 AND started_at + {half_minute} <= {at})"
        return f"""id, CASE WHEN {over} THEN 'failed' ELSE status END AS status, attempts, available_at,
    CASE WHEN NOT coalesce({over}, false) THEN started_at END AS started_at, completed_at,
    CASE WHEN {over} THEN started_at + {half_minute} ELSE failed_at END AS failed_at,
    CASE WHEN {over} THEN {expired} ELSE last_error END AS last_error"""

    def lives(arrived: str) -> str:
        """The fold over operations in the order of (batch, op_at, seq)."""
        return f"""{ops},
arrived AS ({arrived}),
steps AS (
  SELECT id, op, op_at, reason, row_number() OVER (PARTITION BY id ORDER BY batch, op_at, seq) AS k
  FROM arrived),
life AS (
  SELECT id, cast(0 AS bigint) AS k, 'pending' AS status, 0 AS attempts, op_at AS available_at,
         cast(NULL AS timestamp) AS started_at, cast(NULL AS timestamp) AS completed_at,
         cast(NULL AS timestamp) AS failed_at, cast(NULL AS varchar) AS last_error
  FROM steps WHERE k = 1
  UNION ALL
  SELECT id, k,
         CASE WHEN does = 'claim' THEN 'processing' WHEN does = 'ack' THEN 'done'
              WHEN does = 'fail' THEN 'failed' WHEN does = 'retry' THEN 'pending' ELSE status END,
         CASE WHEN does = 'claim' THEN attempts + 1 ELSE attempts END,
         CASE WHEN does = 'retry' THEN op_at + {delay} ELSE available_at END,
         CASE WHEN does = 'claim' THEN op_at WHEN does = 'none' THEN started_at END,
         CASE WHEN does = 'claim' THEN NULL WHEN does = 'ack' THEN coalesce(completed_at, op_at)
              ELSE completed_at END,
         CASE WHEN does = 'fail' THEN op_at WHEN does = 'none' THEN failed_at END,
         CASE WHEN does = 'claim' AND status = 'processing' THEN {reclaimed}
              WHEN does IN ('fail', 'retry') THEN left(coalesce(reason, ''), 4000) ELSE last_error END
  FROM (
    SELECT *, CASE
        WHEN op = 'claim' AND attempts < 5
             AND ((status = 'pending' AND available_at <= op_at)
                  OR (status = 'processing' AND started_at + {half_minute} <= op_at)) THEN 'claim'
        WHEN op = 'ack' AND status IN ('processing', 'done') THEN 'ack'
        WHEN op = 'nack' AND status IN ('pending', 'processing')
          THEN CASE WHEN starts_with(coalesce(reason, ''), '[permanent]') OR attempts >= 5
                    THEN 'fail' ELSE 'retry' END
        ELSE 'none' END AS does
    FROM (SELECT steps.k, op, op_at, reason, {settled("op_at").replace("id,", "life.id,", 1)}
          FROM life JOIN steps ON steps.id = life.id AND steps.k = life.k + 1)))
SELECT {settled("timestamp'2024-03-01 00:00:00'")}
FROM life WHERE (id, k) IN (SELECT id, max(k) FROM steps GROUP BY id)"""

    # Between the two runs timers fire up to the first run's watermark, as a tick would.
    late = """SELECT id, seq, op_at, op, reason, CASE WHEN op = 'ack' THEN 3 ELSE 1 END AS batch
FROM queue_ops
UNION ALL
SELECT DISTINCT id, cast(NULL AS bigint),
       (SELECT date_trunc('milliseconds', max(op_at)) - INTERVAL 10 MINUTE FROM queue_ops WHERE op <> 'ack'),
       'tick', cast(NULL AS varchar), 2
FROM queue_ops WHERE op <> 'ack'"""
    return {
        "queue_lifecycle": lives("SELECT *, 1 AS batch FROM queue_ops"),
        "queue_lifecycle_late": lives(late),
    }


def oracles() -> dict[str, str]:
    found = {
        **_scenarios(),
        **_dumps(),
        **_other_dumps(),
        **_messages(),
        **_integrity(),
        **_queue(),
        **_tables(),
        **_streams(),
        **catalog.oracles(),
    }
    return {**found, "constraint_audit_delta": found["constraint_audit"]}
