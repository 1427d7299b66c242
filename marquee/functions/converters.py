"""Text and JSON values to typed columns, with the reason when a value is refused.

A converter makes the value of a ``Raw``: its text and, for values that come out of a JSON
document, what the text does not tell. The value is NULL where the input is null, empty or
refused; ``error`` tells these apart from the input and the finished value, so the conversion
itself runs once. All are SQL expressions over column names: built-ins only, and one
expression per field to hand to Spark.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from marquee.functions.json import COMPACT, bracketed, document, is_document

# Fixed values and patterns of the dump format, as SQL literals.
NULL_MARK = r"r'\N'"
TRUE_WORDS = "('1', 'true', 't', 'yes')"
FALSE_WORDS = "('0', 'false', 'f', 'no')"
TCONST = r"r'^tt[0-9]+\z'"
NCONST = r"r'^nm[0-9]+\z'"
# All characters the dump's producer strips as blanks around booleans.
BLANKS = (
    r"' \t\n\r\u000B\u000C\u001C\u001D\u001E\u001F\u0085\u00A0\u1680\u2000\u2001\u2002\u2003\u2004"
    r"\u2005\u2006\u2007\u2008\u2009\u200A\u2028\u2029\u202F\u205F\u3000'"
)
DIGIT_GROUPS = "r'(?<=[0-9])_(?=[0-9])'"


@dataclass(frozen=True)
class Raw:
    """Names of columns: the text, the JSON type name, the elements of a JSON list."""

    text: str
    kind: str | None = None
    items: str | None = None


def _given(text: str) -> str:
    """Not the null mark nor empty; NULL, so not true, for NULL."""
    return f"{text} NOT IN ({NULL_MARK}, '')"


def _ungrouped(number: str) -> str:
    """``1_000`` as ``1000``; a misplaced underscore stays and fails the cast."""
    return f"if(contains({number}, '_'), regexp_replace({number}, {DIGIT_GROUPS}, ''), {number})"


def nullify(text: str) -> str:
    return f"CASE WHEN {text} <> {NULL_MARK} THEN {text} END"


def text(raw: Raw) -> str:
    return nullify(raw.text)


def integer(raw: Raw) -> str:
    """32-bit integer; a fractional JSON number is cut, fractional text and booleans fail."""
    whole = f"try_cast({_ungrouped(raw.text)} AS int)"
    if raw.kind:
        cut = f"try_cast(try_cast({raw.text} AS double) AS int)"
        fraction = f"startswith({raw.kind}, 'DECIMAL') OR startswith({raw.kind}, 'DOUBLE')"
        whole = f"CASE WHEN {fraction} THEN {cut} WHEN {raw.kind} <> 'BOOLEAN' THEN {whole} END"
    return f"CASE WHEN {_given(raw.text)} THEN {whole} END"


def rating(raw: Raw) -> str:
    """A decimal from 0 to 10, checked before it is rounded to one place.

    Underscores are ignored wherever they stand.
    """
    number = f"try_cast(replace({raw.text}, '_', '') AS decimal(38,28))"
    in_range = f"{number} BETWEEN cast(0 AS decimal(38,28)) AND cast(10 AS decimal(38,28))"
    return f"CASE WHEN {_given(raw.text)} AND {in_range} THEN cast({number} AS decimal(3,1)) END"


def boolean(raw: Raw) -> str:
    word = f"lower(btrim({raw.text}, {BLANKS}))"
    return f"CASE WHEN {word} IN {TRUE_WORDS} THEN true WHEN {word} IN {FALSE_WORDS} THEN false END"


def array(raw: Raw) -> str:
    """A JSON list or comma-separated text; empty parts are dropped, '' is the empty array."""
    parts = f"split({nullify(raw.text)}, ',', -1)"
    if raw.items:
        parts = f"coalesce({raw.items}, {parts})"
    return f"filter({parts}, part -> part <> '')"


def json_text(raw: Raw) -> str:
    """Valid JSON, stored without blanks between tokens."""
    valid = f"{_given(raw.text)} AND {is_document(raw.text)}"
    if raw.kind:
        valid += f" AND {raw.kind} <> 'BOOLEAN'"
    return f"CASE WHEN {valid} THEN {COMPACT.format(raw.text)} END"


def metadata(raw: Raw) -> str:
    """A JSON object, given as one or as text holding one; absent means empty."""
    is_object = f"startswith(btrim({raw.text}, {BLANKS}), '{{')"
    parsed = f"to_json({document(raw.text, bracketed(raw.text))})"
    return f"CASE WHEN {raw.text} IS NULL THEN '{{}}' WHEN {is_object} THEN {parsed} END"


def tconst(raw: Raw) -> str:
    return f"CASE WHEN {raw.text} RLIKE {TCONST} THEN {raw.text} END"


def nconst(raw: Raw) -> str:
    return f"CASE WHEN {raw.text} RLIKE {NCONST} THEN {raw.text} END"


@dataclass(frozen=True)
class Converter:
    """``noun`` names the value in errors (None: nothing is refused); ``blank`` tells whether
    null and empty input pass as NULL; ``needs`` which part of a JSON value besides its text."""

    value: Callable[[Raw], str]
    noun: str | None = None
    blank: bool = True
    needs: str | None = None

    def error(self, text: str, value: str) -> str:
        """Why column ``text`` was refused, or NULL; ``value`` names the finished value."""
        if self.noun is None:
            return "cast(NULL AS string)"
        given = f" AND {_given(text)}" if self.blank else ""
        shown = f"""coalesce(concat("'", {text}, "'"), 'null')"""
        return f"CASE WHEN {value} IS NULL{given} THEN concat('invalid {self.noun}: ', {shown}) END"


CONVERTERS: dict[str, Converter] = {
    "text": Converter(text),
    "integer": Converter(integer, "integer", needs="kind"),
    "rating": Converter(rating, "rating"),
    "boolean": Converter(boolean, "boolean"),
    "array": Converter(array, needs="items"),
    "json_text": Converter(json_text, "JSON", needs="kind"),
    "metadata": Converter(metadata, "metadata", blank=False),
    "tconst": Converter(tconst, "tconst", blank=False),
    "nconst": Converter(nconst, "nconst", blank=False),
    "optional_nconst": Converter(nconst, "nconst"),
}
