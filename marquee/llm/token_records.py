"""Binary token records: length-framed, checksummed files and an offset index beside them.

A file starts with ``MAGIC`` and one byte, the width of an id. A record is the payload's length
(8 bytes), that field's masked CRC-32 (4), the payload (ids, little-endian) and its masked
CRC-32 (4). The index is a Parquet table with a row per record, so any order of reading needs
one seek a record.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import rows_mapped, running_base
from marquee.llm.tokens import Cut, encoder, slices

MAGIC = b"MQTOKEN"
INDEX = (
    "doc_id long, file string, part int, position long, bytes long, part_start long, n_tokens long"
)
READ = "doc_id long, start long, n_tokens long, ids binary"


def masked(crc: int) -> int:
    """A rotated, shifted CRC: checksums of data that holds checksums stay meaningful."""
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (
            length,
            struct.pack("<I", masked(zlib.crc32(length))),
            payload,
            struct.pack("<I", masked(zlib.crc32(payload))),
        )
    )


def unframed(record: bytes) -> bytes:
    """The payload; ValueError if lengths or checksums disagree."""
    if len(record) < 16:
        raise ValueError("record cut short")
    length, check = struct.unpack_from("<QI", record)
    if masked(zlib.crc32(record[:8])) != check or length != len(record) - 16:
        raise ValueError("record length is damaged")
    payload = record[12:-4]
    if masked(zlib.crc32(payload)) != struct.unpack_from("<I", record, len(record) - 4)[0]:
        raise ValueError("record payload is damaged")
    return payload


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_records(
    docs: DataFrame, folder: str, vocabulary: str, cut: Cut, end_id: int
) -> DataFrame:
    """Write the ids of all texts below ``folder`` (shared by all executors); the index.

    Records stand in ascending doc_id (null first; equal ids by text), one file a range of
    doc_id and the text's beginning, so that many rows of one id are several files.
    A null text is empty: its record holds ``end_id`` alone. Repeated rows are repeated records;
    an empty table makes an empty index. Other columns are ignored. A task that runs again
    writes a file of its own; only files of the attempt that the index took are ever read.
    """

    def write(rows: Iterator[tuple]) -> Iterator[tuple]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.rec"
        filesystem, base = _filesystem(folder)
        sink, position, start = None, 0, 0
        encode = encoder(vocabulary, cut)
        for some in slices(rows, 1):
            if sink is None:
                filesystem.create_dir(f"{base}/records", recursive=True)
                sink = filesystem.open_output_stream(f"{base}/records/{name}")
                position = sink.write(MAGIC + bytes([encode.width]))
            for (doc_id, _), ids in zip(some, encode.ids([text for _, text in some], end_id)):
                record = framed(ids)
                sink.write(record)
                n = len(ids) // encode.width
                yield doc_id, name, context.partitionId(), position, len(record), start, n
                position += len(record)
                start += n
        if sink is not None:
            sink.close()

    ordered = docs.select("doc_id", "text").repartitionByRange(
        "doc_id", F.substring("text", 1, 64)
    )
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    rows_mapped(ordered, write, INDEX).write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all records before), n_tokens and ids (unsigned 32-bit) per record."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # As many rows as files.
    index = index.join(F.broadcast(running_base(totals, "part", "total", "base")), "part")

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        filesystem, base = _filesystem(folder)
        open_name, source, width = None, None, 0
        for doc_id, start, name, position, size in rows:
            if name != open_name:
                if source is not None:
                    source.close()
                source = filesystem.open_input_file(f"{base}/records/{name}")
                open_name, head = name, source.read(len(MAGIC) + 1)
                if head[:-1] != MAGIC:
                    raise ValueError(f"{name} holds no token records")
                width = head[-1]
            source.seek(position)
            ids = np.frombuffer(unframed(source.read(size)), dtype=f"<u{width}")
            yield doc_id, start, len(ids), ids.astype("<u4").tobytes()

    columns = index.select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), "file", "position", "bytes"
    )
    return rows_mapped(columns, read, READ)
