"""Passages of a benchmark inside documents."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import memo, rows_mapped, with_row_key, written

#: ASCII: letters are lowered, digits kept, all else parts words. Bytes beyond are word bytes.
_TABLE = bytes(
    b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower()
)
ITEM_BYTES = 8 << 20


def words(text: str | None) -> list[bytes]:
    """Runs of a-z (A-Z lowered), 0-9 and characters beyond ASCII."""
    return (text or "").encode().translate(_TABLE).split()


def windows_of(text: str | None, size: int) -> list[tuple[bytes, ...]]:
    """Each ``size`` consecutive words; all words if there are fewer."""
    own = words(text)
    if len(own) <= size:
        return [tuple(own)] if own else []
    return [tuple(own[i : i + size]) for i in range(len(own) - size + 1)]


class Ngrams:
    """The windows of a block of benchmark items, by the word that anchors each: its longest."""

    def __init__(self, items: list[tuple[object, str | None]], size: int):
        self.windows: dict[tuple[bytes, ...], list] = defaultdict(list)
        self.anchors: dict[bytes, set[tuple[int, int]]] = defaultdict(set)
        for item_id, text in items:
            for window in set(windows_of(text, size)):
                self.windows[window].append(item_id)
        for window in self.windows:
            anchor = max(window, key=lambda w: (len(w), w))
            self.anchors[anchor].add((window.index(anchor), len(window)))

    def scan(self, own: list[bytes]) -> tuple[np.ndarray, set]:
        """Which of a document's words lie in an occurrence of a window, and its items."""
        hit = np.zeros(len(own), dtype=bool)
        items: set = set()
        if self.anchors.keys().isdisjoint(own):
            return hit, items
        for at, word in enumerate(own):
            for offset, length in self.anchors.get(word, ()):
                first = at - offset
                if first < 0 or first + length > len(own):
                    continue
                ids = self.windows.get(tuple(own[first : first + length]))
                if ids is not None:
                    hit[first : first + length] = True
                    items.update(ids)
        return hit, items


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, str | None]]]:
    """The benchmark in blocks of about ``block_bytes`` of text, split by a hash of the item.

    Repeated items count once, so that copies of one can't fill a block.
    """
    texts = benchmark.select("item_id", "text").distinct()
    total = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n = -(-total // block_bytes)
    for block in range(n):
        own = texts.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        yield [tuple(row) for row in own.toLocalIterator()]


def _hits(docs: DataFrame, items: list[tuple], size: int, kind: str) -> tuple[DataFrame, Broadcast]:
    """doc_id, n_words, hit (runs of hit words as first, end) and items for every row.

    Also the broadcast that these rows read; ``kind`` is the type of item ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(items)
    block = uuid.uuid4().hex

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held = memo()  # a worker builds a block's windows once, and holds those of one block
        if held.get("ngrams", (None,))[0] != block:
            held["ngrams"] = (block, Ngrams(shared.value, size))
        ngrams = held["ngrams"][1]
        for *rest, text in rows:
            own = words(text)
            hit, ids = ngrams.scan(own)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
            yield *rest, len(own), [int(e) for e in edges], sorted(ids, key=repr)

    rest = [f"{name} {type_}" for name, type_ in docs.dtypes if name != "text"]
    schema = ", ".join([*rest, f"n_words long, hit array<int>, items array<{kind}>"])
    return rows_mapped(docs, run, schema), shared


def find(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, block_bytes: int = ITEM_BYTES
) -> DataFrame:
    """doc_id, d, t, n_words, hit and items for every row of ``docs``.

    (d, t) is the row key; ``hit`` holds first and end word numbers of hit runs, one after the
    other; ``items`` the distinct item_ids whose windows occur, in ascending order. A window is
    ``size`` consecutive words of an item, or all of a shorter item.

    The benchmark's texts are broadcast in blocks of ``block_bytes``, one at a time; one block
    needs one pass without a shuffle, more blocks a pass each and a merge by row key. Item ids
    are of any type that Arrow knows. Null texts have no words;
    a benchmark without words hits nothing. Repeated rows give repeated results, an empty table
    none; null item_ids count as no item, though their windows hit. Other columns are ignored.
    """
    keyed = with_row_key(docs.select("doc_id", "text"), "d", "t").select("doc_id", "d", "t", "text")
    kind = benchmark.schema["item_id"].dataType.simpleString()
    blocks = _blocks(benchmark, block_bytes)
    found, shared = _hits(keyed, next(blocks, []), size, kind)
    known = "filter(items, i -> i IS NOT NULL)"
    if (items := next(blocks, None)) is None:
        return found.withColumn("items", F.array_sort(F.expr(known)))
    first = written(found, "hits")
    more = first.drop("doc_id", "n_words")
    while items is not None:
        shared.destroy()
        found, shared = _hits(keyed, items, size, kind)
        # Later blocks give rows for documents with hits only.
        found = found.filter("size(hit) > 0").drop("doc_id", "n_words")
        more = more.unionByName(written(found, "hits"))
        items = next(blocks, None)
    shared.destroy()
    merged = (
        more.filter("size(hit) > 0")
        .groupBy("d", "t")
        .agg(F.collect_set("hit").alias("hits"), F.collect_set("items").alias("all"))
        .select(
            "d", "t", _union("hits").alias("hit"), F.array_distinct(F.flatten("all")).alias("items")
        )
    )
    none = F.expr("array_repeat(0, 0)")
    return (
        first.drop("hit", "items")
        .join(merged, ["d", "t"], "left")
        .select(
            "doc_id",
            "d",
            "t",
            "n_words",
            F.coalesce("hit", none).alias("hit"),
            F.array_sort(F.expr(f"coalesce({known}, filter(array(NULL), i -> false))")).alias("items"),
        )
    )


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _union(column: pd.Series) -> pd.Series:
    """Runs (first, end, first, end, ...) that cover the runs of several lists."""

    def merge(lists):
        runs = sorted((int(x[i]), int(x[i + 1])) for x in lists for i in range(0, len(x), 2))
        out: list[int] = []
        for first, end in runs:
            if out and first <= out[-1]:
                out[-1] = max(out[-1], end)
            else:
                out += [first, end]
        return out

    return column.map(merge)


def n_hit(hit: str = "hit") -> str:
    """SQL for the number of hit words."""
    step = "struct(a.n + a.sign * x AS n, -a.sign AS sign)"
    return f"aggregate({hit}, struct(0L AS n, -1L AS sign), (a, x) -> {step}).n"


def remove(docs: DataFrame, benchmark: DataFrame, size: int = 10, spans: bool = False) -> DataFrame:
    """``docs`` without contaminated documents, or with hit passages cut out of their texts.

    Columns, names and order of ``docs`` stay; a cut takes the text from the first to the last
    word of a hit run, and the rest is left as it is.
    """
    keyed = with_row_key(docs.select("doc_id", "text", F.struct("*").alias("row")), "d", "t")
    marks = find(docs, benchmark, size).filter("size(hit) > 0").select("d", "t", "hit").distinct()
    if not spans:
        return keyed.join(marks, ["d", "t"], "left_anti").select("row.*")
    joined = keyed.join(marks, ["d", "t"], "left")
    cut = F.when(F.col("hit").isNull(), F.col("text")).otherwise(_cut("text", "hit"))
    return joined.select(F.col("row").withField("text", cut).alias("row")).select("row.*")


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, hits: pd.Series) -> pd.Series:
    def one(text: str, hit) -> str:
        if hit is None or text is None:
            return text
        raw = text.encode()
        plain = raw.translate(_TABLE)
        bounds, at = [], 0
        for word in plain.split():
            at = plain.index(word, at)
            bounds.append((at, at + len(word)))
            at += len(word)
        out, start = [], 0
        for i in range(0, len(hit), 2):
            out.append(raw[start : bounds[hit[i]][0]])
            start = bounds[hit[i + 1] - 1][1]
        return b"".join([*out, raw[start:]]).decode()

    return pd.Series([one(t, h) for t, h in zip(texts, hits)], dtype=object)
