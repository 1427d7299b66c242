"""Phrases that words form, counted over a prefix-free parse of the texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import arrow_schema, table_of_bits, written
from marquee.operators.relational import top_n_per_group

#: Bytes that end a piece become line feeds, tabs blanks, and A-Z lower case.
_PLAIN = bytes.maketrans(
    b".,;:!?\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"\n" * 9 + b" abcdefghijklmnopqrstuvwxyz",
)
#: One in so many windows of words ends a chunk.
TRIGGER = 16
#: Texts are worked on in batches of about so many bytes, of one language each.
BATCH_BYTES = 8 << 20
#: Bits of the table that says which phrases may be frequent: 16 MB, whatever the input.
BITS = 27
OUT_CHUNKS = 50_000
CHUNKS = "lang string, chunk string, owned int, n bigint"
HASHES = "hash bigint, n bigint"
PHRASES = "lang string, phrase string, n bigint"


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def _joined_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each position on, of word hashes."""
    last = len(words) - n + 1
    if last <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = words[:last].copy()
    for k in range(1, n):
        total = _mixed(total) + words[k : k + last]
    return _mixed(total)


class _Words:
    """Pieces of words as one row of numbers; nothing is done word by word outside Arrow and numpy."""

    def __init__(self, pieces: pa.StringArray, seed: int = 0):
        """``pieces``: words parted by blanks. Those without a word are left out."""
        lists = pc.split_pattern(pieces, " ")
        tokens = lists.flatten()
        filled = pc.binary_length(tokens).to_numpy(zero_copy_only=False) > 0
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[filled]
        encoded = tokens.filter(pa.array(filled)).dictionary_encode()
        self.vocabulary, self.flat = encoded.dictionary, encoded.indices.to_numpy()
        digest = xxhash.xxh64_intdigest
        words = self.vocabulary.cast(pa.binary()).to_pylist()
        hashes = np.fromiter((digest(w, seed) for w in words), dtype=np.uint64, count=len(words))
        self.hashes = hashes[self.flat]
        sizes = np.bincount(owner, minlength=len(lists))
        self.sizes = sizes[sizes > 0]
        #: Where the pieces end, and for each place the end of its piece.
        self.stops = np.cumsum(self.sizes)
        self.ends = np.repeat(self.stops, self.sizes)

    def starts(self) -> np.ndarray:
        """Where pieces begin."""
        return self.stops - self.sizes

    def room(self) -> np.ndarray:
        """How many words a piece has from each place on."""
        return self.ends - np.arange(len(self.flat))


def _chunks(pieces: pa.StringArray, overlap: int) -> tuple[pa.StringArray, np.ndarray]:
    """The pieces' chunks as words, and how many of these start a phrase of the chunk's own.

    A chunk ends with a window of ``overlap`` words that its hash picks, and the next one begins
    with it. Phrases of up to ``overlap`` + 1 words lie whole in the chunk that owns their start.
    """
    words = _Words(pieces)
    first = np.zeros(len(words.flat), dtype=bool)
    first[words.starts()] = True
    if overlap:
        window = _joined_hashes(words.hashes, overlap) >> np.uint64(40)
        chosen = np.zeros(len(first), dtype=bool)
        chosen[: len(window)] = window % np.uint64(TRIGGER) == 0
        first |= chosen & (words.room() >= overlap)
    starts = np.flatnonzero(first)
    # A chunk's own words go up to the next chunk of its piece, or to the piece's end.
    ends = words.ends[starts]
    until = np.minimum(np.append(starts[1:], len(first)), ends) if len(starts) else starts
    sizes = np.where(until < ends, until + overlap, ends) - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    own = words.vocabulary.take(pa.array(words.flat[places]))
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), own)
    return pc.binary_join(lists, " "), until - starts


def parse(docs: DataFrame, max_words: int) -> DataFrame:
    """(lang, chunk, owned, n): the distinct chunks of all texts and how often each stands.

    Passages that documents share are parsed alike wherever they stand, so they are one row.
    """
    schema = arrow_schema(T.StructType.fromDDL(CHUNKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        room: Counter = Counter()

        def counted(lang: str) -> Iterator[pa.RecordBatch]:
            lines = pa.array([b"\n".join(held.pop(lang))], pa.binary()).cast(pa.string())
            del room[lang]
            pieces = pc.split_pattern(lines, "\n").flatten()
            chunks, owned = _chunks(pieces, max_words - 1)
            for s in range(0, len(chunks), OUT_CHUNKS):
                some = chunks.slice(s, OUT_CHUNKS)
                columns = [
                    pa.repeat(lang, len(some)),
                    some,
                    pa.array(owned[s : s + OUT_CHUNKS], pa.int32()),
                    pa.repeat(pa.scalar(1, pa.int64()), len(some)),
                ]
                yield pa.record_batch(columns, schema=schema)

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = text.encode().translate(_PLAIN)
                held.setdefault(lang, []).append(own)
                room[lang] += len(own)
                if room[lang] >= BATCH_BYTES:
                    yield from counted(lang)
        for lang in list(held):
            yield from counted(lang)

    texts = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    chunks = texts.mapInArrow(run, T.StructType.fromDDL(CHUNKS))
    return chunks.groupBy("lang", "chunk", "owned").agg(F.sum("n").alias("n"))


def _counted(hashes: np.ndarray, at: np.ndarray, weights: np.ndarray):
    """Distinct ``hashes``, where each first stands, and the sums of their ``weights``."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[heads], at[order[heads]], np.add.reduceat(weights[order], heads)


class _Batch:
    """Chunks of one language, ready for counting the phrases they own."""

    def __init__(self, lang: str, chunks: pa.StringArray, owned: np.ndarray, n: np.ndarray):
        words = _Words(chunks, seed=xxhash.xxh32_intdigest(lang.encode()))
        self.vocabulary, self.flat = words.vocabulary, words.flat
        self.hashes, self.room = words.hashes, words.room()
        until = np.repeat(words.starts() + owned, words.sizes)
        self.owned = np.arange(len(words.flat)) < until
        self.weights = np.repeat(n, words.sizes)

    def starts(self, size: int) -> np.ndarray:
        return np.flatnonzero(self.owned & (self.room >= size))

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        columns = [self.vocabulary.take(pa.array(self.flat[at + k])) for k in range(size)]
        return pc.binary_join_element_wise(*columns, " ") if size > 1 else columns[0]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Batch]]:
    """Chunks in groups of one language and bounded size."""
    held: dict[str, list[pa.RecordBatch]] = {}
    room: Counter = Counter()

    def batch_of(lang: str) -> tuple[str, _Batch]:
        own = pa.Table.from_batches(held.pop(lang)).combine_chunks()
        chunks, owned, n = (own.column(c).chunk(0) for c in ("chunk", "owned", "n"))
        return lang, _Batch(lang, chunks, owned.to_numpy(), n.to_numpy())

    for batch in batches:
        langs = batch.column("lang")
        for lang in langs.unique().to_pylist():
            own = batch.filter(pc.equal(langs, lang))
            held.setdefault(lang, []).append(own)
            room[lang] += own.nbytes
            if room[lang] >= BATCH_BYTES:
                del room[lang]
                yield batch_of(lang)
    for lang in list(held):
        yield batch_of(lang)


def _pair_hashes(chunks: DataFrame) -> DataFrame:
    """(hash, n): how often each hash of two neighbouring words stands."""
    schema = arrow_schema(T.StructType.fromDDL(HASHES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in _batches(batches):
            at = own.starts(2)
            if len(at):
                hashes = _joined_hashes(own.hashes, 2)[at]
                hashes, _, n = _counted(hashes, at, own.weights[at])
                yield pa.record_batch([pa.array(hashes.view(np.int64)), pa.array(n)], schema=schema)

    pairs = chunks.mapInArrow(run, T.StructType.fromDDL(HASHES))
    return pairs.groupBy("hash").agg(F.sum("n").alias("n"))


def phrase_counts(chunks: DataFrame, max_words: int, min_count: int) -> DataFrame:
    """(lang, phrase, n) of all phrases up to ``max_words`` that stand ``min_count`` times.

    Counts are of the phrases' text. A longer phrase is as rare as its rarest pair, so pairs are
    counted by hash first, and a table of ``BITS`` marks those that reach ``min_count``; phrases
    with an unmarked pair are not written out. The table has one size whatever the input; a pair
    marked for another costs time, never a count.
    """
    frequent = _pair_hashes(chunks).filter(F.col("n") >= min_count)
    marks = table_of_bits(frequent, "hash", BITS)
    schema = arrow_schema(T.StructType.fromDDL(PHRASES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(marks.value, dtype=np.uint8)
        for lang, own in _batches(batches):
            place = _joined_hashes(own.hashes, 2) >> np.uint64(64 - BITS)
            bit = marked[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
            often = np.append(bit.astype(bool), False)
            for size in range(1, max_words + 1):
                at = own.starts(size)
                for k in range(size - 1):
                    at = at[often[at + k]]
                if not len(at):
                    break
                hashes = _joined_hashes(own.hashes, size)[at]
                _, first, n = _counted(hashes, at, own.weights[at])
                for s in range(0, len(first), OUT_CHUNKS):
                    phrases = own.phrases(first[s : s + OUT_CHUNKS], size)
                    columns = [pa.repeat(lang, len(phrases)), phrases, pa.array(n[s : s + OUT_CHUNKS])]
                    yield pa.record_batch(columns, schema=schema)

    counted = chunks.mapInArrow(run, T.StructType.fromDDL(PHRASES))
    total = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return total.filter(F.col("n") >= min_count)


def _words_of(phrase: str = "phrase") -> Column:
    return F.split(phrase, " ")


def _scored(counts: DataFrame, max_words: int) -> DataFrame:
    """Phrases of two words or more with a, the counts l and r of their weakest cut, and score."""
    long = counts.filter(F.instr("phrase", " ") > 0)
    cut = F.explode(F.sequence(F.lit(1), F.size(_words_of()) - 1))
    cuts = long.select("lang", "phrase", F.col("n").alias("a"), cut.alias("k"))
    for part, at in (("first", F.lit(1)), ("rest", F.col("k") + 1)):
        size = F.col("k") if part == "first" else F.size(_words_of())
        words = F.array_join(F.slice(_words_of(), at, size), " ")
        own = counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(f"n_{part}"))
        cuts = cuts.withColumn(part, words).join(own, ["lang", part]).drop(part)
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n_first", "n_rest")}
    over = F.lit(1_000_000).cast("decimal(7,0)") * (wide["a"] * wide["a"]).cast("decimal(30,0)")
    under = (wide["n_first"] * wide["n_rest"]).cast("decimal(38,0)")
    cuts = cuts.withColumns({"over": over.cast("decimal(38,0)"), "under": under})
    best = F.struct(F.expr("over div under").alias("score"), "k", "n_first", "n_rest")
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.array_min(F.collect_list(best)).alias("cut"))
    return worst.select(
        "lang",
        "phrase",
        "a",
        F.col("cut.n_first").alias("l"),
        F.col("cut.n_rest").alias("r"),
        F.col("cut.score").alias("score"),
    )


def _covered(counts: DataFrame, max_words: int) -> DataFrame:
    """(lang, phrase, longest): the count of the most frequent longer phrase around each."""
    words, parts = _words_of(), []
    long = counts.filter(F.instr("phrase", " ") > 0)
    for size in range(2, max_words):
        longer = long.filter(F.size(words) > size)
        start = F.explode(F.sequence(F.lit(1), F.size(words) - size + 1))
        inner = longer.select("lang", words.alias("words"), "n", start.alias("at"))
        part = F.array_join(F.slice("words", F.col("at"), size), " ")
        parts.append(inner.select("lang", part.alias("phrase"), "n"))
    if not parts:
        return counts.limit(0).withColumnRenamed("n", "longest")
    inside = reduce(DataFrame.unionByName, parts)
    return inside.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))


def collocations(
    docs: DataFrame, max_words: int = 3, min_count: int = 10, cover: int = 50, top: int = 2000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and pieces into
    words at blanks and tabs. A phrase of 2 to ``max_words`` words counts if it stands
    ``min_count`` times (a), overlaps included. Cut in two, its parts stand l and r times; score
    is the floor of 1000000 a a / (l r) at the cut that makes it least, the first of such.
    A phrase whose words lie in a longer one that stands at least ``cover`` percent as often is
    left out. n counts the language's words. Order: score, then a, descending; then the phrase.

    Texts are parsed into chunks that end where their words' hash says so and overlap by
    ``max_words`` - 1 words; phrases are counted once in each distinct chunk, times its
    frequency, by the chunk that owns their first word.

    A null text is empty, a null lang is ``und``. Repeated rows count each; an empty table gives
    no rows; other columns are ignored.
    """
    chunks = written(parse(docs.select("lang", "text"), max_words), "chunks", compression="zstd")
    counts = written(phrase_counts(chunks, max_words, min_count), "phrases")
    totals = chunks.groupBy("lang").agg(F.sum(F.col("owned") * F.col("n")).alias("n"))
    kept = (
        _scored(counts, max_words)
        .join(_covered(counts, max_words), ["lang", "phrase"], "left")
        .filter(F.coalesce(100 * F.col("longest") < cover * F.col("a"), F.lit(True)))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Of each slice of a language at most ``top`` rows reach the task that ranks it.
    ranked = top_n_per_group(kept, ["lang"], order, top, salt_by=["phrase"], salts=64)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
