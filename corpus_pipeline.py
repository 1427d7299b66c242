"""A training corpus from ``documents``: rules, lines, near copies, benchmark, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but
the last return the columns of ``documents``. Rows of ``docs`` that agree in doc_id and text are
one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm import decontaminate, line_dedup, packing, quality, simhash
from marquee.llm.common import table, with_row_key, written
from marquee.llm.queries import END_ID, vocabulary
from marquee.llm.tokens import at_blanks
from marquee.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the isolation forest keep."""
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    gone = judged.filter("NOT kept").select("d", "t").distinct()
    keyed = with_row_key(docs.select("doc_id", "text", F.struct("*").alias("row")), "d", "t")
    return keyed.join(gone, ["d", "t"], "left_anti").select("row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that ten documents or more share; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    row = F.col("row").withField("text", F.col("kept.text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.char_length("kept.text").cast("long"))
    return kept.select(row.alias("row")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: that of its smallest doc_id; repeated rows stay once."""
    found = simhash.near_copies(docs, shingle=3, max_bits=3)
    stay = (
        found.filter("doc_id <=> component_id")
        .groupBy("label", "d")
        .agg(F.min("t").alias("t"))
        .select("d", "t")
    )
    keyed = with_row_key(docs.select("doc_id", "text", F.struct("*").alias("row")), "d", "t")
    copies = Window.partitionBy("d", "t").orderBy(F.xxhash64("row"))
    kept = keyed.join(stay, ["d", "t"], "left_semi").withColumn("copy", F.row_number().over(copies))
    return kept.filter("copy = 1").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), size=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of sequences of 4096 tokens; ids as in the operator, with their digest."""
    path, folder = vocabulary("word_bpe_49k.json"), shared_dir(spark, "sequences")
    sequences = packing.write_sequences(docs, path, at_blanks, END_ID, folder)
    return packing.boundaries(sequences).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

#: Hashed shingles, random trees and vocabularies are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
