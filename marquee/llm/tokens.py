"""Token ids of whole texts by public vocabulary files."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marquee.llm.common import memo

#: Words a worker remembers for one vocabulary; forgotten all at once, then learnt anew.
MEMO_WORDS = 1_000_000

# Texts of ASCII and Latin letters, with spaces and line breaks as their only blanks, can be
# parted by a plain pattern whose classes are spelt out; others go through the tokenizer whole.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_NUMBERS = "0-9²³¹¼-¾"
_OTHER = f"[^ \n{_LETTERS}{_NUMBERS}]+"
_UNUSUAL = re.compile(r"[^\n\x20-\x7e¡-ſ]")
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_SPACED = re.compile(
    f"{_ENDINGS}| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?{_OTHER}|[ \n]+(?![^ \n])|[ \n]+"
)
_BARE = re.compile(f"{_ENDINGS}|[{_LETTERS}]+|[{_NUMBERS}]|{_OTHER}")
# Where ``at_blanks`` cuts in any case: between a letter and a point or comma.
_POINTS = "([a-z])([.,])"

#: The words that a vocabulary's tokenizer parts a text into, or None to leave it to that.
Cut = Callable[[str], list[str] | None]


def whole(text: str) -> None:
    """Right for every vocabulary."""
    return None


def at_spaces(text: str) -> list[str] | None:
    """Words of byte-level vocabularies that carry the space before them."""
    return None if _UNUSUAL.search(text) else _SPACED.findall(text)


def at_blanks(text: str) -> list[str] | None:
    """Words of byte-level vocabularies in lower case that drop blanks."""
    if _UNUSUAL.search(text):
        return None
    text = text.lower()
    return [text] if text.isalpha() else _BARE.findall(text)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: itself if it can be seen."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Memo(dict):
    """Values by key, computed when first asked for."""

    def __init__(self, compute: Callable[[str], bytes]):
        self.compute = compute

    def __missing__(self, key: str) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class Encoder:
    """Ids of texts as bytes (little-endian, ``width`` bytes each).

    Words repeat, so each new one is merged once by the vocabulary's model and remembered.
    """

    def __init__(self, path: str, cut: Cut):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Texts with an added token's string are left to the tokenizer, in whatever case.
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = re.compile("|".join(re.escape(a.content) for a in added) or "(?!)", re.I)
        self.cut = cut
        self.width = id_width(self.tokenizer.get_vocab_size())
        self.dtype = f"<u{self.width}"
        letters, model = _byte_letters(), self.tokenizer.model

        def word(text: str) -> bytes:
            octets = text.encode().decode("latin-1").translate(letters)
            return self._bytes([token.id for token in model.tokenize(octets)])

        self.words = _Memo(word)

    def _bytes(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def ids(self, texts: list[str | None], end_id: int) -> Iterator[bytes]:
        """For each text (None: empty) its ids and ``end_id``."""
        end, known = self._bytes([end_id]), self.words.__getitem__
        for text in texts:
            text = text or ""
            own = None if self.added.search(text) else self.cut(text)
            if own is None:
                yield self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids) + end
            else:
                yield b"".join(map(known, own)) + end

    def ids_by_chunk(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``ids`` of all texts end to end, and how many each has; for ``at_blanks``.

        No word crosses a blank there, so each distinct chunk between blanks is looked up once,
        and Arrow and numpy put the ids of all chunks in their places.
        """
        # A chunk that no text left to the cut can hold marks the end of each text. What is left
        # to the tokenizer has a chunk of its own, that mark with a number.
        end, whole = "\x00", {}
        parts = []
        for text in texts:
            text = text or ""
            if self.added.search(text) or _UNUSUAL.search(text):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                text = f"{end}{len(whole)}"
                whole[text] = self._bytes(ids)
            parts.append(text)
        if not parts:
            return np.empty(0, self.dtype), np.empty(0, "i8")
        whole[end] = self._bytes([end_id])
        joined = pa.array([f" {end}\n".join([*parts, ""])], pa.large_string())
        joined = pc.replace_substring_regex(pc.ascii_lower(joined), _POINTS, r"\1 \2")
        chunks = pc.ascii_split_whitespace(joined).flatten().dictionary_encode()
        distinct = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = chunks.indices.to_numpy()
        # A remembered word is a chunk of its own too, as the cut leaves it as it is.
        known, words, cut = self.words.get, self.words.__getitem__, self.cut
        held = [
            known(c) or (whole[c] if c in whole else b"".join(map(words, cut(c)))) for c in distinct
        ]
        flat = np.frombuffer(b"".join(held), dtype=self.dtype)
        sizes = np.fromiter(map(len, held), "i8", len(held)) // self.width
        starts = np.cumsum(sizes) - sizes
        counts = sizes[at]
        ends = np.cumsum(counts)
        places = np.repeat(starts[at] - ends + counts, counts)
        places += np.arange(len(places))
        bounds = ends[at == distinct.index(end)]
        return flat[places], np.diff(bounds, prepend=0)


def id_width(vocabulary: int) -> int:
    """Bytes that hold every id."""
    return 2 if vocabulary <= 1 << 16 else 4


def encoder(path: str, cut: Cut) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    loaded = memo().setdefault("encoders", {})
    key = (path, cut.__name__)
    if key not in loaded:
        loaded[key] = Encoder(path, cut)
    return loaded[key]


def slices(rows: Iterator[tuple], texts_at: int, characters: int = 1 << 20) -> Iterator[list]:
    """``rows`` in lists of about so many characters of text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[texts_at] or "")
        if size >= characters:
            yield held
            held, size = [], 0
    if held:
        yield held


def text_slices(
    batch: pa.RecordBatch, texts_at: int, size: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about so many bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(texts_at)), 0).to_numpy()
    group = np.cumsum(sizes, dtype="i8") // size
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)
