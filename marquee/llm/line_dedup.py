"""Lines that many documents share, found by streaming over sorted line hashes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import BLANKS, arrow_schema, lower_ascii, with_row_key, written

LINE = ["h1", "h2", "d", "t", "pos"]
#: kind 0: a line to drop; 1: a line whose hash goes on in another partition; 2: the number of
#: documents (n) that such a hash has in one partition.
PASS = "kind int, h1 long, h2 long, d long, t long, pos int, n long"
DROP, PENDING, EDGE = 0, 1, 2
#: Lines of a run that are held until it is decided; those of a longer one are all pending.
HELD_LINES = 100_000


def lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Hashes (h1, h2: 128 bits) of each line's key with the row key (d, t) and position."""
    keyed = with_row_key(docs.select("doc_id", "text"), "d", "t")
    split = keyed.select(
        "d", "t", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line")
    )
    key = F.btrim(lower_ascii(F.col("line")), F.lit(BLANKS))
    split = split.select("d", "t", "pos", key.alias("key")).filter(F.length("key") >= min_chars)
    return split.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "d", "t", "pos"
    )


class _Runs:
    """Streams sorted lines of one partition; holds a run's lines only until it is decided."""

    def __init__(self, min_docs: int, keep_first: bool):
        self.min_docs, self.keep_first = min_docs, keep_first
        self.held = None  # lines of the open run, while it has too few documents
        self.over = None  # (h1, h2, whether the run began the partition) once it has enough
        self.edge = True  # the open run began the partition
        self.long = None  # (h1, h2, documents, last document) of a run too long to hold

    def add(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """rows: a column per line, in the order of LINE."""
        if self.long is not None:
            run, docs, last = self.long
            other = np.flatnonzero((rows[0] != run[0]) | (rows[1] != run[1]))
            until = other[0] if len(other) else rows.shape[1]
            if until:
                own = rows[2:4, :until]
                moved = (np.diff(own, axis=1, prepend=last) != 0).any(axis=0)
                self.long = (run, docs + int(moved.sum()), own[:, -1:])
                yield self._out(PENDING, rows[:, :until])
            if not len(other):
                return
            yield self._summary(run, self.long[1])
            self.long, self.edge, rows = None, False, rows[:, until:]
        if self.over is not None:
            other = np.flatnonzero((rows[0] != self.over[0]) | (rows[1] != self.over[1]))
            until = other[0] if len(other) else rows.shape[1]
            if until:
                yield self._out(DROP, rows[:, :until])
            if not len(other):
                return
            if self.edge:
                yield self._summary(self.over)
            self.over, self.edge, rows = None, False, rows[:, until:]
        if self.held is not None:
            rows = np.concatenate([self.held, rows], axis=1)
        if not rows.shape[1]:
            return
        starts, docs = self._starts(rows)
        last = starts[-1]
        if len(starts) > 1:
            done, first = rows[:, :last], 0
            if self.edge:  # the partition's first run may have begun in the one before
                first = starts[1]
                yield from self._edge(done[:, :first], docs[0])
                self.edge = False
            often = np.repeat(docs[:-1] >= self.min_docs, np.diff(starts))
            often[:first] = False
            if self.keep_first:
                often[starts[:-1]] = False
            if often.any():
                yield self._out(DROP, done[:, often])
        self.held = rows[:, last:]
        if docs[-1] >= self.min_docs:
            # Enough already. The first line may not be the first of all, or the first of all
            # while the run goes on elsewhere: that is settled where the partitions meet.
            lead = 1 if self.keep_first else 0
            yield self._out(PENDING, self.held[:, :lead])
            yield self._out(DROP, self.held[:, lead:])
            self.over, self.held = (self.held[0, 0], self.held[1, 0]), None
        elif self.held.shape[1] > HELD_LINES:
            # Few documents that say one line very often: the join decides, not this stream.
            yield self._out(PENDING, self.held)
            self.long = ((self.held[0, 0], self.held[1, 0]), int(docs[-1]), self.held[2:4, -1:])
            self.held = None

    def end(self) -> Iterator[np.ndarray]:
        if self.long is not None:
            yield self._summary(*self.long[:2])
        elif self.over is not None:
            yield self._summary(self.over)
        elif self.held is not None and self.held.shape[1]:
            yield from self._edge(self.held, self._starts(self.held)[1][0])

    def _starts(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of one hash start, and how many documents each has."""
        changed = rows[:, 1:] != rows[:, :-1]
        run = np.concatenate([[True], changed[0] | changed[1]])
        doc = run.copy()
        doc[1:] |= changed[2] | changed[3]
        starts = np.flatnonzero(run)
        return starts, np.add.reduceat(doc.astype(np.int64), starts)

    def _edge(self, rows: np.ndarray, docs: int) -> Iterator[np.ndarray]:
        if docs >= self.min_docs:
            lead = 1 if self.keep_first else 0
            yield self._out(PENDING, rows[:, :lead])
            yield self._out(DROP, rows[:, lead:])
        else:
            yield self._out(PENDING, rows)
        yield self._summary(rows[:2, 0], docs)

    def _summary(self, run, docs: int | None = None) -> np.ndarray:
        n = self.min_docs if docs is None else docs
        return np.array([[EDGE], [run[0]], [run[1]], [0], [0], [0], [n]], dtype=np.int64)

    def _out(self, kind: int, rows: np.ndarray) -> np.ndarray:
        n = rows.shape[1]
        return np.concatenate(
            [np.full((1, n), kind, np.int64), rows, np.zeros((1, n), np.int64)]
        )


def dropped_lines(docs: DataFrame, min_docs: int, min_chars: int, keep_first: bool) -> DataFrame:
    """(d, t, pos) of the lines to drop.

    Ranges of (hash, row key) split a hash that many documents share among partitions; a run of
    one hash is decided within its partition, except for the first and last run of each, of
    which fewer than ``min_docs`` documents' lines and a count go on to a small join.
    """
    schema = arrow_schema(T.StructType.fromDDL(PASS))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(min_docs, keep_first)

        def results() -> Iterator[np.ndarray]:
            for batch in batches:
                columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                yield from runs.add(np.array(columns, dtype=np.int64))
            yield from runs.end()

        for rows in results():
            if rows.shape[1]:
                arrays = [pa.array(v).cast(f.type) for v, f in zip(rows, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    ordered = (
        lines(docs, min_chars)
        .repartitionByRange("h1", "h2", "d", "t")
        .sortWithinPartitions(*LINE)
        .select(*LINE)
    )
    passed = written(ordered.mapInArrow(stream, T.StructType.fromDDL(PASS)), "lines")
    often = (
        passed.filter(F.col("kind") == EDGE)
        .groupBy("h1", "h2")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= min_docs)
        .select("h1", "h2")
    )
    pending = passed.filter(F.col("kind") == PENDING).join(often, ["h1", "h2"], "left_semi")
    if keep_first:
        line = F.struct("d", "t", "pos")
        firsts = pending.groupBy("h1", "h2").agg(F.min(line).alias("first"))
        pending = pending.join(firsts, ["h1", "h2"]).filter(line != F.col("first"))
    drop = passed.filter(F.col("kind") == DROP)
    return drop.select("d", "t", "pos").unionByName(pending.select("d", "t", "pos"))


@F.pandas_udf(T.BinaryType())
def _bitmap(positions: pd.Series) -> pd.Series:
    def pack(dropped) -> bytes:
        keep = np.ones((int(max(dropped)) // 8 + 1) * 8, dtype=bool)  # whole bytes
        keep[np.asarray(dropped, dtype=np.int64)] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return positions.map(pack)


def keep_bitmaps(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False
) -> DataFrame:
    """(d, t, keep): a compressed bitmap a document that loses lines.

    Bit i says whether line i stays; lines beyond the last bit stay. Documents without a row
    keep every line.
    """
    dropped = dropped_lines(docs, min_docs, min_chars, keep_first)
    grouped = dropped.groupBy("d", "t").agg(F.collect_set("pos").alias("positions"))
    return grouped.select("d", "t", _bitmap("positions").alias("keep"))


@F.pandas_udf(
    T.StructType()
    .add("text", T.StringType())
    .add("n_lines", T.LongType())
    .add("n_dropped", T.LongType())
)
def _kept(texts: pd.Series, bitmaps: pd.Series) -> pd.DataFrame:
    rows = []
    for text, bitmap in zip(texts, bitmaps):
        if bitmap is None:
            rows.append((text, (text or "").count("\n") + 1, 0))
            continue
        own = (text or "").split("\n")
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8))
        keep = np.ones(len(own), dtype=bool)
        n = min(len(bits), len(own))
        keep[:n] = bits[:n]
        left = [line for line, stays in zip(own, keep) if stays]
        rows.append(("\n".join(left), len(own), len(own) - len(left)))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])


def dedup_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False
) -> DataFrame:
    """(row, kept): each input row as a struct, and its text without lines that repeat.

    A line's key is the line without blanks at its ends, A-Z in lower case. Keys of at least
    ``min_chars`` code points in at least ``min_docs`` documents lose all their lines, or, with
    ``keep_first``, all but the first in the order of (doc_id, hash, position). ``kept`` holds
    text, n_lines (before) and n_dropped.

    A null or empty text is one empty line, and stays null or empty. Rows with equal doc_id and
    text count as one document and get one answer. An empty table gives no rows. Further columns
    travel inside ``row``, whatever their names.
    """
    bitmaps = keep_bitmaps(docs, min_docs, min_chars, keep_first)
    own = with_row_key(docs.select("doc_id", "text", F.struct("*").alias("row")), "d", "t")
    joined = own.join(bitmaps, ["d", "t"], "left")
    return joined.select("row", _kept("row.text", "keep").alias("kept"))
