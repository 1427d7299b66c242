"""Near copies by SimHash: candidates from a grid over per-segment bit counts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import rows_mapped, with_row_key, written
from marquee.llm.components import connected

SEED = 42
SEGMENTS = 32  # of two bits each
_LOW = 0x5555555555555555  # the lower bit of every segment


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits, signed: bit i is set if it is in over half the shingles' XXH64 hashes.

    Words are runs of non-blanks after A-Z are lowered; fewer words than ``shingle`` make one
    shingle, and a text without words has fingerprint 0.
    """
    import xxhash

    words = (text or "").encode().lower().split()  # bytes know ASCII letters and blanks only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(
        map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), dtype="<u8", count=n
    )
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 14):
        octets = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, row key (d, t) and fp for every row."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        return ((doc_id, d, t, fingerprint(text, shingle)) for doc_id, d, t, text in rows)

    keyed = with_row_key(docs.select("doc_id", "text"), "d", "t")
    return rows_mapped(
        keyed.select("doc_id", "d", "t", "text"), run, "doc_id long, d long, t long, fp long"
    )


def segment_counts(fp: Column) -> Column:
    """The bit count (0 to 2) of every segment, in unary: the segment's bits, sorted.

    So the Manhattan distance of two count vectors is the number of bits in which they differ,
    and never more than that of the fingerprints.
    """
    low, shifted = F.lit(_LOW), F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(shifted).bitwiseAND(low)
    both = fp.bitwiseAND(shifted).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(both, 1))


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(u, v), once a pair: distinct fingerprints ``fp`` at most ``max_bits`` apart.

    The count vectors are cut into two halves; vectors at most 3 apart agree on one half or
    differ there by one in a single segment. So each fingerprint stands in the grid cell of
    either half, and looks into its own cell and those one count higher in one segment: the
    range join is an equi-join on cells. Pairs must be within ``max_bits`` by the lower bound,
    then exactly. A pair that both halves find is taken from the lower one.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves find pairs up to 3 bits apart")
    points = fps.select("fp", segment_counts(F.col("fp")).alias("counts"))
    half = F.posexplode(
        F.array(
            F.col("counts").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("counts", 32)
        )
    ).alias("half", "cell")
    home = points.select("fp", "counts", half)
    # A segment's next count sets its lower bit if that is 0, else its upper bit if that is 0.
    step = "shiftleft(1L, 2 * s + int(getbit(cell, 2 * s)))"
    higher = (
        f"transform(filter(sequence(0, {SEGMENTS // 2 - 1}), s -> getbit(cell, 2 * s + 1) = 0),"
        f" s -> cell | {step})"
    )
    look = home.select(
        F.col("fp").alias("u"),
        F.col("counts").alias("u_counts"),
        "half",
        F.posexplode(F.expr(f"concat(array(cell), {higher})")).alias("move", "cell"),
    )
    there = home.select(
        F.col("fp").alias("v"),
        F.col("counts").alias("v_counts"),
        F.col("half").alias("v_half"),
        F.col("cell").alias("v_cell"),
    )
    apart = F.col("u_counts").bitwiseXOR(F.col("v_counts"))
    lower = F.bit_count(apart.bitwiseAND(0xFFFFFFFF))
    near = (
        ((F.col("move") > 0) | (F.col("u") < F.col("v")))
        & (F.bit_count(apart) <= max_bits)
        & ((F.col("half") == 0) | (lower > 1))
        & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
    )
    same_cell = (F.col("half") == F.col("v_half")) & (F.col("cell") == F.col("v_cell"))
    return look.join(there, same_cell & near).select("u", "v")


def near_copies(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, row key (d, t), fp, label and component_id for every row.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked; component_id is the
    smallest doc_id that links reach, the row's own included, and ``label`` names the component
    by one of its fingerprints. Equal fingerprints are one node,
    so copies are never paired. Null and empty texts and texts of blanks have fingerprint 0 and
    are linked like any other. Null ids never name a component, unless it has no other. Repeated
    rows give repeated results, an empty table none; other columns are ignored.
    """
    fps = written(fingerprints(docs, shingle), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("smallest"))
    labels = connected(written(links(nodes, max_bits), "links"))
    named = nodes.join(labels, nodes["fp"] == labels["node"], "left").select(
        "fp", "smallest", F.coalesce("label", "fp").alias("label")
    )
    named = written(named, "nodes")
    least = named.groupBy("label").agg(F.min("smallest").alias("component_id"))
    return fps.join(
        named.select("fp", "label").join(least, "label"), "fp"
    ).select("doc_id", "d", "t", "fp", "label", "component_id")
