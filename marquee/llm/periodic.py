"""Runs of periodically repeated words, found through string synchronising sets."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from marquee.llm.common import memo, rows_mapped

#: Two primes below 2^31: products of remainders fit in 64 bits, a pair of remainders in 62.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525017)
#: Periods up to this are looked for one by one.
SMALL = 8
BATCH_WORDS = 400_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Found(NamedTuple):
    """Runs as arrays: first symbol, end (exclusive), smallest period."""

    start: np.ndarray
    end: np.ndarray
    period: np.ndarray


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each prime, the base's powers 0 to n - 1 and those of its inverse."""
    held = memo().get("powers")
    if held is None or len(held[0][0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        held = []
        for p, b in zip(PRIMES, BASES):
            pair = []
            for base in (b, pow(b, -1, p)):
                power = np.ones(1, dtype=np.uint64)
                while len(power) < size:
                    power = np.concatenate([power, power * np.uint64(pow(base, len(power), p)) % np.uint64(p)])
                pair.append(power)
            held.append(tuple(pair))
        memo()["powers"] = held
    return held


class Text:
    """Symbols with fingerprints of all their windows."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        n = len(symbols)
        self.sums, self.inverses = [], []
        mixed = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        for (power, inverse), p in zip(_powers(n + 1), PRIMES):
            sums = np.zeros(n + 1, dtype=np.uint64)
            value = (mixed >> np.uint64(32)) % np.uint64(p)
            np.cumsum(value * power[:n] % np.uint64(p), out=sums[1:])
            self.sums.append(sums % np.uint64(p))
            self.inverses.append(inverse)

    def __len__(self) -> int:
        return len(self.symbols)

    def windows(self, at: np.ndarray, length: int) -> np.ndarray:
        """A fingerprint of the ``length`` symbols from each of ``at``."""
        parts = []
        for sums, inverse, p in zip(self.sums, self.inverses, PRIMES):
            p = np.uint64(p)
            parts.append((sums[at + length] + p - sums[at]) % p * inverse[at] % p)
        return (parts[0] << np.uint64(31) | parts[1]).astype(np.int64)

    def common_after(self, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
        """How many symbols from i and from j (j > i) on are equal."""
        return self._common(i, j, most, 1)

    def common_before(self, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
        """How many symbols before i and before j (j > i) are equal."""
        return self._common(i, j, most, -1)

    def _common(self, i: np.ndarray, j: np.ndarray, most: int, way: int) -> np.ndarray:
        done = np.zeros(len(i), dtype=np.int64)
        step = 1 << max(0, most.bit_length())
        while step:
            a, b = (i + done, j + done) if way > 0 else (i - done - step, j - done - step)
            inside = np.flatnonzero((a >= 0) & (b + step <= len(self)))
            same = self.windows(a[inside], step) == self.windows(b[inside], step)
            done[inside[same]] += step
            step //= 2
        return done


def _distinct(runs: Found) -> Found:
    """One run, that of the smallest period, for each interval; ``runs`` by ascending period."""
    key = runs.start << 32 | runs.end
    first = np.sort(np.unique(key, return_index=True)[1])
    return Found(*(a[first] for a in runs))


def _small_runs(symbols: np.ndarray, exponent: int) -> Found:
    """Runs with periods up to SMALL, each by comparing the text with itself moved."""
    found = []
    for q in range(1, SMALL + 1):
        same = np.zeros(max(len(symbols) - q, 0) + 2, dtype=np.int8)
        same[1:-1] = symbols[q:] == symbols[:-q]
        edge = np.flatnonzero(np.diff(same))
        start, end = edge[::2], edge[1::2] + q
        long = end - start >= exponent * q
        found.append(Found(start[long], end[long], np.full(long.sum(), q)))
    return _distinct(Found(*(np.concatenate(a) for a in zip(*found))))


def synchronising_set(text: Text, n: int, tau: int, runs: Found) -> np.ndarray:
    """Positions i among the first n symbols whose window of ``tau`` symbols, or that of i + tau,
    has the least fingerprint of those from i to i + tau.

    So two positions with equal 2 tau symbols after them are both chosen or both not. Windows
    with a period of at most tau / 3 take no part, or a stretch of them would be chosen whole;
    ``runs`` must hold the runs of those periods. Any other stretch of 3 tau symbols has a chosen
    position among its first tau.
    """
    last = n - 2 * tau + 1
    if last <= 0:
        return np.zeros(0, dtype=np.int64)
    rank = text.windows(np.arange(n - tau + 1), tau)
    rank = (rank * np.int64(-7046029254386353131) >> 2) & np.int64(0x3FFFFFFFFFFFFFFF)
    none = np.int64(0x7FFFFFFFFFFFFFFF)
    regular = (runs.period * 3 <= tau) & (runs.end - runs.start >= tau) & (runs.end <= n)
    depth = np.zeros(n + 2, dtype=np.int32)
    np.add.at(depth, runs.start[regular], 1)
    np.add.at(depth, runs.end[regular] - tau + 1, -1)
    rank[np.cumsum(depth)[: len(rank)] > 0] = none
    least, width = rank, 1
    while width < tau:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:last], rank[tau : tau + last])
    chosen = (rank[:last] == least) | (rank[tau : tau + last] == least)
    return np.flatnonzero(chosen & (least != none))


def _proposed(text: Text, at: np.ndarray, n: int, low: int, high: int, most: int) -> Found:
    """Maximal stretches with a period in (low, high], from equal contexts of chosen positions.

    A context of ``high`` symbols, no shorter than the period, stands in its run once a period, so
    neighbours in the sorted list of equal contexts are a period apart. Contexts begin at the
    position or half their length before it: one of the two lies in the run with its next copy.
    """
    lefts, periods = [], []
    for back in (0, high // 2):
        w = at - back
        w = w[(w >= 0) & (w + high <= n)]
        context = text.windows(w, high)
        order = np.argsort(context, kind="stable")
        context, w = context[order], w[order]
        gap = w[1:] - w[:-1]
        pair = np.flatnonzero((context[1:] == context[:-1]) & (gap > low) & (gap <= high))
        lefts.append(w[pair])
        periods.append(gap[pair])
    left, period = np.concatenate(lefts), np.concatenate(periods)
    if not len(left):
        return Found(left, left, left)
    order = np.lexsort((left, period))
    left, period = left[order], period[order]
    # Stretches of one period that share a period's length are one stretch.
    fresh = np.ones(len(left), dtype=bool)
    fresh[1:] = (period[1:] != period[:-1]) | (left[1:] > left[:-1] + high)
    heads = np.flatnonzero(fresh)
    tails = np.append(heads[1:], len(left)) - 1
    start, q, matched = left[heads], period[heads], left[tails] + high
    start = start - text.common_before(start, start + q, most)
    matched = matched + text.common_after(matched, matched + q, most)
    return Found(start, matched + q, q)


def _checked(symbols: np.ndarray, runs: Found) -> Found:
    """``runs`` cut where symbols themselves differ, should fingerprints ever have misled."""
    start, end = runs.start.copy(), runs.end.copy()
    for k, (s, e, q) in enumerate(zip(*runs)):
        wrong = np.flatnonzero(symbols[s : e - q] != symbols[s + q : e])
        if len(wrong):
            edges = np.concatenate([[-1], wrong, [e - q - s]])
            best = int(np.argmax(np.diff(edges)))
            start[k], end[k] = s + edges[best] + 1, s + edges[best + 1] + q
    return Found(start, end, runs.period)


def runs_of(symbols: np.ndarray, lengths: np.ndarray, exponent: int = 3) -> Found:
    """All runs of at least ``exponent`` (3 or more) periods in documents of ``lengths`` symbols.

    ``symbols`` holds the documents, longest first, with a symbol of its own after each.
    """
    runs = _small_runs(symbols, exponent)
    ends = np.cumsum(lengths + 1)
    text, low, tau, at = Text(symbols), SMALL, 0, None
    while True:
        high = (low + 1) * 5 // 4
        fits = int(np.searchsorted(-lengths, -exponent * (low + 1), side="right"))
        if not fits:
            return runs
        n, most = int(ends[fits - 1]), int(lengths[0])
        scale = 1 << (((low + 1) // 4).bit_length() - 1)
        if scale != tau:
            tau = scale
            at = synchronising_set(text, n, tau, runs)
        new = _proposed(text, at[at < n], n, low, high, most)
        long = new.end - new.start >= exponent * new.period
        new = _checked(symbols, Found(*(a[long] for a in new)))
        long = new.end - new.start >= exponent * new.period
        merged = (np.concatenate([a, b[long]]) for a, b in zip(runs, new))
        runs = _distinct(Found(*merged))
        low = high


def _suspects(symbols: np.ndarray, lengths: np.ndarray, shared: int) -> np.ndarray:
    """Which documents say ``shared`` words in a row twice: without that there is no run."""
    ends = np.cumsum(lengths + 1)
    n = len(symbols) - shared + 1
    if n <= 0:
        return np.zeros(len(lengths), dtype=bool)
    keys = Text(symbols).windows(np.arange(n), shared)
    owner = np.repeat(np.arange(len(lengths)), lengths + 1)[:n]
    keys ^= owner * np.int64(0x5851F42D4C957F2D)
    order = np.argsort(keys)
    twice = keys[order[1:]] == keys[order[:-1]]
    marked = np.zeros(len(ends), dtype=bool)
    marked[owner[order[1:][twice]]] = True
    return marked


def _concatenated(texts: list[list[bytes]]) -> np.ndarray:
    """Numbers of the words of all texts, with a number of its own after each text."""
    numbers: dict[bytes, int] = {}
    for words in texts:
        for word in words:
            numbers.setdefault(word, len(numbers))
    separators = count(len(numbers))
    parts = []
    for words in texts:
        parts.extend(map(numbers.__getitem__, words))
        parts.append(next(separators))
    return np.array(parts, dtype=np.int64)


def _batch_runs(texts: list[list[bytes]], min_length: int) -> list[list[tuple[int, int, int]]]:
    """Each text's runs (start, length, period), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((i for i, t in enumerate(texts) if len(t) >= min_length), key=lambda i: -len(texts[i]))
    if not order:
        return out
    lengths = np.array([len(texts[i]) for i in order], dtype=np.int64)
    symbols = _concatenated([texts[i] for i in order])
    suspects = _suspects(symbols, lengths, min_length - min_length // 3)
    if not suspects.any():
        return out
    order = [i for i, s in zip(order, suspects) if s]
    symbols = symbols[np.repeat(suspects, lengths + 1)]
    lengths = lengths[suspects]
    runs = runs_of(symbols, lengths)
    starts = np.cumsum(lengths + 1) - lengths - 1
    long = runs.end - runs.start >= min_length
    owner = np.searchsorted(starts, runs.start, side="right") - 1
    for k in np.flatnonzero(long):
        own = int(owner[k])
        start = int(runs.start[k] - starts[own])
        out[order[own]].append((start, int(runs.end[k] - runs.start[k]), int(runs.period[k])))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words without what repeats a run's first period."""
    if runs:
        depth = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            depth[start + period] += 1
            depth[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
    return b" ".join(words).decode()


def periodic_runs(docs: DataFrame, min_length: int = 24) -> DataFrame:
    """(doc_id, runs, collapsed) for every row.

    A run is a stretch of at least ``min_length`` words and three times its smallest period that
    no neighbouring word extends. ``runs`` lists start, length and period by start, then period;
    ``collapsed`` is the text's words without all but the first period of each run, joined by one
    blank. Words are parted by the blanks \\x20 and \\x09 to \\x0D.

    Documents are worked on many at a time as one row of numbers, a narrow map without a shuffle.
    Memory follows ``BATCH_WORDS``, or the longest text, and time the words times the number of
    scales, whatever repeats.

    A null or empty text has no words, no runs and collapses to nothing. Repeated rows give
    repeated, equal results; an empty table none; other columns are ignored.
    """

    def results(rows: Iterator[tuple]) -> Iterator[tuple]:
        ids, texts, held = [], [], 0
        for doc_id, text in rows:
            words = (text or "").encode().split()  # of bytes: splits at ASCII blanks alone
            ids.append(doc_id)
            texts.append(words)
            held += len(words) + 1
            if held >= BATCH_WORDS:
                yield from _finished(ids, texts)
                ids, texts, held = [], [], 0
        yield from _finished(ids, texts)

    def _finished(ids: list, texts: list[list[bytes]]) -> Iterator[tuple]:
        for doc_id, words, runs in zip(ids, texts, _batch_runs(texts, min_length)):
            # Arrow takes a struct from a dictionary.
            listed = [{"start": s, "length": n, "period": q} for s, n, q in runs]
            yield doc_id, listed, _collapsed(words, runs)

    return rows_mapped(
        docs.select("doc_id", "text"), results, f"doc_id bigint, runs {RUNS}, collapsed string"
    )
