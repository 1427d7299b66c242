"""Packing by concatenation: all documents end to end, cut into windows of fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import arrow_schema, rows_mapped, running_base, written
from marquee.llm.tokens import Cut, at_blanks, encoder, text_slices

TOKENS = "doc_id long, part int, part_start long, doc_tokens long, ids binary"
PIECES = "array<struct<offset:bigint,doc_id:bigint,start:bigint,length:bigint,doc_tokens:bigint>>"
#: A window or a part of it, as its ids from ``first`` on, and the pieces in them.
WINDOWS = f"sequence_id long, first long, ids binary, pieces {PIECES}"


def _positions(
    docs: DataFrame, vocabulary: str, cut: Cut, end_id: int
) -> DataFrame:
    """doc_id, doc_tokens, ids and ``at``, the number of ids of all documents before.

    The first pass writes each partition's ids with running counts; prefix sums over the
    partitions' totals turn them into global positions.
    """

    by_chunk = cut is at_blanks
    target = T.StructType.fromDDL(TOKENS)
    schema = arrow_schema(target)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        worker = encoder(vocabulary, cut)
        for batch in batches:
            for some in text_slices(batch, 1):
                texts = some.column(1).to_pylist()
                if by_chunk:
                    ids, counts = worker.ids_by_chunk(texts, end_id)
                else:
                    each = list(worker.ids(texts, end_id))
                    ids = np.frombuffer(b"".join(each), dtype=worker.dtype)
                    counts = np.array([len(own) // worker.width for own in each], "i8")
                ends = np.cumsum(counts)
                offsets = pa.py_buffer(np.concatenate([[0], 4 * ends]).astype("<i4"))
                wide = pa.py_buffer(ids.astype("<u4"))
                columns = [
                    some.column(0),
                    pa.array(np.full(len(texts), part, "i4")),
                    pa.array(start + ends - counts),
                    pa.array(counts),
                    pa.Array.from_buffers(pa.binary(), len(texts), [None, offsets, wide]),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                start += int(ends[-1])

    tokens = docs.select("doc_id", "text").mapInArrow(encode, target)
    tokens = written(tokens, "tokens", compression="zstd")
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    bases = running_base(totals, "part", "total", "base")  # as many rows as partitions
    return tokens.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("at"), "doc_tokens", "ids"
    )


def _cut(window: int):
    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        """Windows from documents in order; whole where they can be, else parts of them."""
        first, held, pieces, position = 0, bytearray(), [], None
        for doc_id, at, tokens, ids in rows:
            if at != position and held:  # the documents between are another task's
                yield first // window, first % window, bytes(held), pieces
                held, pieces = bytearray(), []
            start = 0
            while start < tokens:
                if not held:
                    first = at + start
                length = min(tokens - start, window - (at + start) % window)
                place = (at + start) % window
                pieces.append(
                    {"offset": place, "doc_id": doc_id, "start": start, "length": length, "doc_tokens": tokens}
                )
                held += ids[4 * start : 4 * (start + length)]
                start += length
                if (at + start) % window == 0:
                    yield first // window, first % window, bytes(held), pieces
                    held, pieces = bytearray(), []
            position = at + tokens
        if held:
            yield first // window, first % window, bytes(held), pieces

    return cut


def write_sequences(
    docs: DataFrame,
    vocabulary: str,
    cut: Cut,
    end_id: int,
    folder: str,
    window: int = 4096,
    pad_id: int = 0,
) -> DataFrame:
    """Write all documents end to end as sequences of ``window`` ids; the sequences, to be read.

    sequence_id, length, ids (padded with ``pad_id``; unsigned 32-bit, little-endian) and pieces:
    offset, doc_id, start, length and doc_tokens of each part of a document, in order.

    The second pass streams each partition's documents and cuts at multiples of ``window``.
    Windows that lie in one partition are written as they are; only the parts at the partitions'
    edges, two a partition, meet by sequence_id. Only the last sequence can be short; it is
    padded, unless its length is a power of two. Every document has its end id at least, so null
    and empty texts make one piece of one id. Repeated rows are packed as often as they come; an
    empty table makes no sequence; other columns are ignored. Order among partitions is that of
    the written table.
    """
    placed = _positions(docs, vocabulary, cut, end_id)
    parts = written(rows_mapped(placed, _cut(window), WINDOWS), "windows", compression="zstd")
    length = F.octet_length("ids") / 4
    whole = parts.filter(length == window).select("sequence_id", "ids", "pieces")
    edges = (
        parts.filter(length < window)
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("first", "ids", "pieces"))).alias("parts"))
        .select(
            "sequence_id",
            F.expr("aggregate(parts, X'', (done, p) -> concat(done, p.ids))").alias("ids"),
            F.flatten("parts.pieces").alias("pieces"),
        )
    )
    length = (F.octet_length("ids") / 4).cast("int")
    filler = F.when(F.bit_count(length) == 1, 0).otherwise(window - length)
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), filler))
    out = whole.unionByName(edges).select(
        "sequence_id", length.alias("length"), F.concat("ids", pad).alias("ids"), "pieces"
    )
    out.write.parquet(folder, compression="zstd")
    return docs.sparkSession.read.schema(out.schema).parquet(folder)


def boundaries(sequences: DataFrame) -> DataFrame:
    """Boundary records: doc_id, start, length, doc_tokens, sequence_id, offset, ids per piece."""
    pieces = sequences.select("sequence_id", "ids", F.explode("pieces").alias("p"))
    own = F.expr("substring(ids, cast(4 * p.offset + 1 AS int), cast(4 * p.length AS int))")
    return pieces.select(
        "p.doc_id", "p.start", "p.length", "p.doc_tokens", "sequence_id", "p.offset", own.alias("ids")
    )
