"""The operators of this package as registered queries over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    chat,
    decontaminate,
    hilbert,
    line_dedup,
    packing,
    periodic,
    personal,
    phrases,
    quality,
    radix,
    secrets,
    simhash,
    token_records,
)
from marquee.llm.common import table
from marquee.llm.spans import count_of, listed
from marquee.llm.tokens import at_blanks, at_spaces
from marquee.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
END_ID = 2


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "records")
    docs = _documents(spark, sf_dir)
    path = vocabulary("byte_bpe_50k.json")
    token_records.write_records(docs, folder, path, at_spaces, END_ID)
    return token_records.read_records(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


SHARDS = 24


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.coalesce(F.octet_length("row.text"), F.lit(0)) + 8
    digest = [
        F.col("row.doc_id").alias("doc_id"),
        size.cast("long").alias("size"),
        F.crc32(F.coalesce("row.text", F.lit("")).cast("binary")).alias("text_crc32"),
    ]
    dimensions = ["n_chars", "lang", "source"]
    rows = table(spark, sf_dir, "documents").select(F.struct("*").alias("row"))
    docs = rows.select("row", *digest, *(F.col(f"row.{d}").alias(d) for d in dimensions))
    folder = shared_dir(spark, "shards")
    keys = ["doc_id", "size", "text_crc32"]
    return hilbert.cut_shards(docs, dimensions, SHARDS, folder, keys=keys, size=size).select(
        *digest,
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve_position",
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = secrets.scan(_documents(spark, sf_dir))
    by = ["start", "ord"]
    return seen.select(
        "doc_id",
        *(count_of("base", i).alias(f"n_{k.name}") for i, k in enumerate(secrets.BASE)),
        F.sha2(listed("base", secrets.KINDS, by), 256).alias("base_sha256"),
        listed("concat(base, linked)", secrets.KINDS, by).alias("spans"),
    )


OK = "</s>[INST] ok [/INST]"


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-1, 0, "user", OK), (-1, 1, "assistant", OK)],
        "conv_id long, turn long, role string, text string",
    )
    return chat.digests(chat.format_conversations(turns.unionByName(extra)))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(_documents(spark, sf_dir), shingle=3, max_bits=3)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = _documents(spark, sf_dir), shared_dir(spark, "sequences")
    path = vocabulary("word_bpe_49k.json")
    sequences = packing.write_sequences(docs, path, at_blanks, END_ID, folder)
    return packing.boundaries(sequences).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_documents(spark, sf_dir), min_docs=10, min_chars=1)
    return kept.select(
        "row.doc_id",
        "kept.n_lines",
        "kept.n_dropped",
        F.sha2(F.coalesce("kept.text", F.lit("")), 256).alias("kept_sha256"),
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    found = decontaminate.find(_documents(spark, sf_dir), benchmark, size=10)
    hits = F.expr(decontaminate.n_hit())
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def op9_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = personal.scan(_documents(spark, sf_dir))
    by = ["ord", "start"]
    return seen.select(
        "doc_id",
        *(count_of("base", i).alias(f"n_{k.name}") for i, k in enumerate(personal.BASE)),
        F.sha2(listed("base", personal.KINDS, by), 256).alias("base_sha256"),
        listed("concat(base, discovered)", personal.KINDS, by).alias("spans"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_radix_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = {"text_sha256": F.sha2(radix.normalised(), 256)}
    found = radix.exact_copies(_documents(spark, sf_dir), digest)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: The contract's change of texts: of every tenth document, what follows word ``a`` repeats.
#: ``array(x)`` binds x once; a column named in a lambda would be worked out for each word.
PLANTED = r"""
IF(crc32(cast(cast(doc_id AS string) AS binary)) % 10 = 0,
   transform(
     array(struct(
       filter(split(text, r'[\x20\x09-\x0D]+'), w -> w <> '') AS words,
       crc32(cast(cast(doc_id AS string) AS binary)) div 10 AS g)),
     x -> IF(size(x.words) = 0, '', array_join(transform(
       array(struct(
         x.words AS words,
         cast(x.g % size(x.words) AS int) AS a,
         1 + cast((size(x.words) - x.g % size(x.words)) div (3 + x.g % 8) AS int) AS p)),
       y -> array_join(transform(y.words, (w, i) ->
         IF(i < y.a, w, y.words[y.a + (i - y.a) % y.p])), ' ')), '')))[0],
   text)"""

#: The run of the greatest exact length / period; runs are in the order that settles ties.
BEST = """
IF(size(runs) = 0, NULL, aggregate(runs, runs[0], (best, x) ->
  IF(x.length * best.period > best.length * x.period, x, best)))"""


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).withColumn("text", F.expr(PLANTED))
    found = periodic.periodic_runs(docs, min_length=24).withColumn("best", F.expr(BEST))
    lines = "transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\n'))"
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.expr(f"array_join({lines}, '')"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    return phrases.collocations(docs, max_words=3, min_count=10, cover=50, top=2000)


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_token_records,
            op2_hilbert_shards,
            op3_secrets,
            op4_chat,
            op5_simhash,
            op6_packing,
            op7_line_dedup,
            op8_decontaminate,
            op9_personal,
            op10_quality,
            op11_radix_copies,
            op12_periodic_runs,
            op13_phrases,
        )
    }


OP7_SQL = r"""
WITH parts AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM parts),
often AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key
  HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (SELECT key FROM often)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
              FILTER (key NOT IN (SELECT key FROM often)), '')) AS kept_sha256
FROM keyed GROUP BY doc_id
"""


OP11_SQL = """
WITH plain AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(body) AS text_sha256
FROM plain
"""

OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, row_number() OVER () AS row,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS piece_no, piece FROM pieces),
words AS (
  SELECT lang, piece_no,
         unnest(list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '')) AS w1,
         generate_subscripts(list_filter(string_split_regex(piece, '[\x20\x09]+'),
                             lambda w: w <> ''), 1) AS pos
  FROM numbered),
windows AS (
  SELECT lang, w1, lead(w1, 1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3
  FROM words WINDOW piece AS (PARTITION BY piece_no ORDER BY pos)),
total AS (SELECT lang, count(*) AS n FROM windows GROUP BY lang),
one AS (SELECT lang, w1, count(*) AS f FROM windows GROUP BY ALL),
two AS (SELECT lang, w1, w2, count(*) AS f FROM windows WHERE w2 IS NOT NULL GROUP BY ALL),
three AS (
  SELECT lang, w1, w2, w3, count(*) AS f FROM windows
  WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
pair AS (
  SELECT two.lang, two.w1 || ' ' || two.w2 AS phrase, two.f AS a, x.f AS l, y.f AS r
  FROM two JOIN one x ON x.lang = two.lang AND x.w1 = two.w1
           JOIN one y ON y.lang = two.lang AND y.w1 = two.w2
  WHERE two.f >= 10
    AND NOT EXISTS (SELECT 1 FROM three t WHERE t.lang = two.lang AND t.w1 = two.w1
                    AND t.w2 = two.w2 AND 100 * t.f >= 50 * two.f)
    AND NOT EXISTS (SELECT 1 FROM three t WHERE t.lang = two.lang AND t.w2 = two.w1
                    AND t.w3 = two.w2 AND 100 * t.f >= 50 * two.f)),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a,
         x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2
  FROM three t
  JOIN one x ON x.lang = t.lang AND x.w1 = t.w1
  JOIN two yz ON yz.lang = t.lang AND yz.w1 = t.w2 AND yz.w2 = t.w3
  JOIN two xy ON xy.lang = t.lang AND xy.w1 = t.w1 AND xy.w2 = t.w2
  JOIN one z ON z.lang = t.lang AND z.w1 = t.w3),
scored AS (
  SELECT lang, phrase, a, l, r, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM pair
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END,
         CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
  FROM (SELECT *, (1000000::HUGEINT * a * a) // (l1::HUGEINT * r1) AS s1,
               (1000000::HUGEINT * a * a) // (l2::HUGEINT * r2) AS s2 FROM cuts)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored)
SELECT ranked.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_line_dedup": OP7_SQL, "op11_radix_copies": OP11_SQL, "op13_phrases": OP13_SQL}
