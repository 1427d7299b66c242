"""Quality rules: fixed limits, then an isolation forest over the rules' statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import rows_mapped, with_row_key, written

_BLANKS = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
WINDOW = 5
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MORE = "n_distinct long"
#: Scores are counted in so many steps for the threshold.
STEPS = 2000


def _repeated(own: list[bytes], size: int) -> int:
    """Words in windows of ``size`` words that occur twice or more, the first included."""
    n = len(own) - size + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.int64, len(own))
    if len(numbers) == len(own):
        return 0
    # A window of k + 1 words is a window of k and the word after it; numbers stay below the
    # text's length, so their pairs are exact.
    grams = ids
    for k in range(1, size):
        pair = grams[:-1] * len(own) + ids[k:]
        _, grams, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if counts.max() == 1:
            return 0
    again = np.flatnonzero(counts[grams] > 1)
    ends = np.zeros(len(own) + 1, dtype=np.int64)
    np.add.at(ends, again, 1)
    np.add.at(ends, again + size, -1)
    return int(np.count_nonzero(np.cumsum(ends[:-1])))


def statistics(text: str | None) -> tuple[int, ...]:
    """The columns of STATS and MORE. Words are runs of non-blanks; null is empty."""
    text = text or ""
    raw = text.encode()
    own = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip(_BLANKS)]
    blanks = len(raw) - len(raw.translate(None, _BLANKS))
    return (
        len(own),
        len(text) - blanks,
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(own, WINDOW),
        len(set(own)),
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, row key (d, t), STATS and MORE for every row."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        return ((doc_id, d, t, *statistics(text)) for doc_id, d, t, text in rows)

    keyed = with_row_key(docs.select("doc_id", "text"), "d", "t")
    return rows_mapped(
        keyed.select("doc_id", "d", "t", "text"),
        run,
        f"doc_id long, d long, t long, {STATS}, {MORE}",
    )


BASE_FAILED = f"n_words < 10 OR 100 * n_repeat_words > 20 * n_words"

#: What the forest sees: sizes do not matter, shares do. Repeats are the base rules' matter.
#: Repeated lines, digits and capitals are left out, as the documents oddest in them are clean
#: ones with license lines or a number, and a threshold that spares those lets junk pass.
FEATURES = {
    "mean_word": "word_chars, n_words",
    "symbols": "n_symbols, n_words",
    "variety": "n_distinct, pow(n_words, 0.75)",
}


def features() -> list:
    return [
        F.expr(f"float(coalesce(try_divide({pair}), 0))").alias(name)
        for name, pair in FEATURES.items()
    ]


def _average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n keys."""
    if n <= 1:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0


class Forest:
    """Trees of random splits; rows that few splits set apart are anomalies."""

    def __init__(self, rows: np.ndarray, trees: int, sample: int, seed: int):
        random = np.random.default_rng(seed)
        self.sample = max(2, min(sample, len(rows)))
        depth = math.ceil(math.log2(self.sample))
        self.trees = [
            self._grow(rows[random.permutation(len(rows))[:sample]], depth, random)
            for _ in range(trees if len(rows) else 0)
        ]

    def _grow(self, rows: np.ndarray, depth: int, random: np.random.Generator) -> list[tuple]:
        """Nodes as (feature, split, left, right), leaves as (-1, path length, 0, 0)."""
        nodes: list[tuple] = []

        def node(own: np.ndarray, level: int) -> int:
            at = len(nodes)
            nodes.append((-1, level + _average_path(len(own)), 0, 0))
            low, high = own.min(axis=0), own.max(axis=0)
            varied = np.flatnonzero(high > low)
            if level < depth and len(own) > 1 and len(varied):
                feature = int(random.choice(varied))
                split = random.uniform(low[feature], high[feature])
                left = own[:, feature] <= split
                nodes[at] = (
                    feature, split, node(own[left], level + 1), node(own[~left], level + 1)
                )
            return at

        node(rows, 0)
        return nodes


def anomaly_scores(trees: list[list[tuple]], sample: int, rows: np.ndarray) -> np.ndarray:
    """2^(-mean path / expected path) a row: near 1 odd, below 0.5 ordinary."""
    total = np.zeros(len(rows))
    for nodes in trees:
        feature, split, left, right = (np.array(c) for c in zip(*nodes))
        at = np.zeros(len(rows), dtype=np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                break
            here = at[inner]
            less = rows[inner, feature[here]] <= split[here]
            at[inner] = np.where(less, left[here], right[here])
        total += split[at]
    return np.exp2(-total / (_average_path(sample) * max(1, len(trees))))


def _scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """``stats`` with a column score."""
    # Two nodes at most for each tree and row of its sample.
    shared = stats.sparkSession.sparkContext.broadcast((forest.trees, forest.sample))
    names = stats.columns
    schema = T.StructType.fromDDL(
        ", ".join(f"{name} {kind}" for name, kind in stats.dtypes) + ", score double"
    )
    n = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack(
                [np.nan_to_num(c.to_numpy(zero_copy_only=False)) for c in batch.columns[n:]]
            ).astype(np.float64)
            score = pa.array(anomaly_scores(*shared.value, rows))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], score], names=[*names, "score"]
            )

    return stats.select("*", *features()).mapInArrow(run, schema)


def _fit(stats: DataFrame, labels: DataFrame, rows: int, trees: int, sample: int, seed: int):
    """A forest from at most ``rows`` labelled rows, those of the lowest hashes."""
    labelled = stats.filter(f"NOT ({BASE_FAILED})").join(
        labels.select("doc_id").distinct(), "doc_id", "left_semi"
    )
    picked = (
        labelled.select(F.xxhash64("d", "t").alias("hash"), *features())
        .orderBy("hash", *FEATURES)
        .limit(rows)
        .drop("hash")
    )
    matrix = np.array([tuple(r) for r in picked.toLocalIterator()], dtype=np.float64)
    return Forest(matrix.reshape(-1, len(FEATURES)), trees, sample, seed)


def _threshold(scored: DataFrame, labels: DataFrame, spared: float) -> float:
    """The score above which documents are rejected, from all labelled rows.

    Good documents (quality 1, not toxic) score above it in at most a share ``spared`` of cases;
    among such thresholds it has the largest gap between the shares of bad (quality 0) and good
    documents above it, and of equals the highest. Without good or bad labels nothing is
    rejected.
    """
    step = F.floor(F.col("score") * STEPS).cast("int").alias("step")
    kinds = (
        labels.groupBy("doc_id")
        .agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .select(
            "doc_id",
            F.expr("quality = 1 AND coalesce(toxic, 0) = 0").cast("int").alias("good"),
            F.expr("quality = 0").cast("int").alias("bad"),
        )
    )
    counts = (
        scored.filter(f"NOT ({BASE_FAILED})")
        .join(kinds, "doc_id")
        .groupBy(step)
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        .collect()  # at most STEPS + 1 rows
    )
    good, bad = np.zeros(STEPS + 2), np.zeros(STEPS + 2)
    for row in counts:
        good[row["step"]], bad[row["step"]] = row["good"] or 0, row["bad"] or 0
    if not good.sum() or not bad.sum():
        return math.inf
    above_good = np.cumsum(good[::-1])[::-1] / good.sum()
    above_bad = np.cumsum(bad[::-1])[::-1] / bad.sum()
    gap = np.where(above_good <= spared, above_bad - above_good, -np.inf)
    best = len(gap) - 1 - int(np.argmax(gap[::-1]))
    return best / STEPS


def judge(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows: int = 20_000,
    trees: int = 100,
    sample: int = 256,
    spared: float = 0.005,
    seed: int = 7,
) -> DataFrame:
    """doc_id, row key (d, t), STATS, base_failed, score and kept for every row.

    base_failed: fewer than 10 words, or over a fifth of the words in repeated windows of five.
    Other documents are kept unless the forest's score reaches the threshold that all labelled
    rows set. The forest is fitted on at most ``fit_rows`` labelled rows (lowest hashes), each
    tree on ``sample`` of them.

    Null and empty texts have no words and fail. Repeated rows get equal answers; several labels
    of one document count as their highest; labels without a document are ignored; without
    labels only the base rules decide. An empty table gives no rows; further columns are
    ignored.
    """
    stats = written(document_statistics(docs), "statistics")
    forest = _fit(stats, labels, fit_rows, trees, sample, seed)
    scored = written(_scored(stats, forest), "scores") if forest.trees else stats.withColumn(
        "score", F.lit(0.0)
    )
    limit = _threshold(scored, labels, spared)
    failed = F.expr(BASE_FAILED)
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("score") < F.lit(limit))
    )
