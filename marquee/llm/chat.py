"""Chat formatting: a small template language, compiled to Python closures.

Text outside of braces is literal. ``{{ expression }}`` puts a value, ``{% for x in messages %}
... {% endfor %}`` repeats, ``{% if e %} ... {% elif e %} ... {% else %} ... {% endif %}``
chooses, ``{% generation %} ... {% endgeneration %}`` marks text the model learns. Expressions
know strings, variables, ``.role``-like fields, ``+``, ``==``, ``!=``, ``and``, ``or``, ``not``,
parentheses and the filters given to ``compile``; there is no call, index or attribute beyond
the fields of a message, so a template reaches nothing else.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import rows_mapped

Segment = tuple[str, bool]  # text, and whether it is generated


class TemplateError(ValueError):
    pass


# --- syntax tree ---


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: Any
    name: str


@dataclass(frozen=True)
class Operation:
    kind: str  # + == != and or not, or a filter's name
    parts: tuple


@dataclass(frozen=True)
class Put:
    value: Any


@dataclass(frozen=True)
class Loop:
    variable: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Choice:
    branches: tuple  # (condition, body)
    otherwise: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('[^']*'|\"[^\"]*\")|([A-Za-z_]\w*)|(==|!=|[+().|]))")
_WORDS = {"and", "or", "not"}


class _Expression:
    """Recursive descent: or, and, not, comparison, sum, filter, field."""

    def __init__(self, text: str):
        self.tokens, at = [], 0
        while text[at:].strip():
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append(m.group().strip())
            at = m.end()
        self.at = 0

    def parse(self):
        tree = self._any("or", lambda: self._any("and", self._negation))
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at]!r}")
        return tree

    def _next(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at] in wanted:
            self.at += 1
            return self.tokens[self.at - 1]
        return None

    def _any(self, word: str, part: Callable):
        tree = part()
        while self._next(word):
            tree = Operation(word, (tree, part()))
        return tree

    def _negation(self):
        if self._next("not"):
            return Operation("not", (self._negation(),))
        tree = self._sum()
        if kind := self._next("==", "!="):
            tree = Operation(kind, (tree, self._sum()))
        return tree

    def _sum(self):
        tree = self._filtered()
        while self._next("+"):
            tree = Operation("+", (tree, self._filtered()))
        return tree

    def _filtered(self):
        tree = self._atom()
        while True:
            if self._next("."):
                tree = Field(tree, self._name())
            elif self._next("|"):
                tree = Operation(self._name(), (tree,))
            else:
                return tree

    def _name(self) -> str:
        if self.at >= len(self.tokens) or not self.tokens[self.at].isidentifier():
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1]

    def _atom(self):
        if self._next("("):
            tree = self._any("or", lambda: self._any("and", self._negation))
            if not self._next(")"):
                raise TemplateError("a parenthesis is not closed")
            return tree
        if self.at < len(self.tokens) and self.tokens[self.at][0] in "'\"":
            self.at += 1
            return Const(self.tokens[self.at - 1][1:-1])
        name = self._name()
        if name in _WORDS:
            raise TemplateError(f"unexpected {name!r}")
        return Name(name)


def parse(template: str) -> tuple:
    """The template's syntax tree: a tuple of nodes."""
    pieces, at = [], 0
    for m in _TAG.finditer(template):
        pieces.append(("text", template[at : m.start()]))
        pieces.append(("put", m.group(1)) if m.group(1) is not None else ("tag", m.group(2).strip()))
        at = m.end()
    pieces.append(("text", template[at:]))
    position = 0

    def block(ends: tuple[str, ...]) -> tuple[tuple, str]:
        nonlocal position
        body = []
        while position < len(pieces):
            kind, text = pieces[position]
            position += 1
            if kind == "text":
                if text:
                    body.append(Put(Const(text)))
                continue
            if kind == "put":
                body.append(Put(_Expression(text).parse()))
                continue
            word, _, rest = text.partition(" ")
            if word in ends:
                return tuple(body), text
            if word == "for":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"cannot read {text!r}")
                inner, _ = block(("endfor",))
                body.append(Loop(m.group(1), _Expression(m.group(2)).parse(), inner))
            elif word == "if":
                branches, otherwise, closing = [], (), text
                while closing.partition(" ")[0] in ("if", "elif"):
                    test = _Expression(closing.partition(" ")[2]).parse()
                    inner, closing = block(("elif", "else", "endif"))
                    branches.append((test, inner))
                if closing == "else":
                    otherwise, _ = block(("endif",))
                body.append(Choice(tuple(branches), otherwise))
            elif word == "generation":
                inner, _ = block(("endgeneration",))
                body.append(Generation(inner))
            else:
                raise TemplateError(f"unexpected {text!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(body), ""

    return block(())[0]


def _apply(kind: str, values: list, filters: dict[str, Callable[[str], str]]):
    if kind == "+":
        return f"{values[0]}{values[1]}"
    if kind == "==":
        return values[0] == values[1]
    if kind == "!=":
        return values[0] != values[1]
    if kind == "not":
        return not values[0]
    return filters[kind](values[0])


def fold(node, filters: dict[str, Callable[[str], str]]):
    """``node`` with constant parts computed, dead branches gone and literals joined."""
    if isinstance(node, tuple):
        out: list = []
        for part in (fold(x, filters) for x in node):
            for x in part if isinstance(part, tuple) else (part,):
                joined = out and isinstance(x, Put) and isinstance(out[-1], Put)
                if joined and isinstance(x.value, Const) and isinstance(out[-1].value, Const):
                    out[-1] = Put(Const(f"{out[-1].value.value}{x.value.value}"))
                else:
                    out.append(x)
        return tuple(out)
    if isinstance(node, Operation):
        parts = tuple(fold(p, filters) for p in node.parts)
        if node.kind in ("and", "or") and isinstance(parts[0], Const):
            decided = bool(parts[0].value) == (node.kind == "or")
            return parts[0] if decided else parts[1]
        if node.kind not in ("and", "or", "not", "+", "==", "!=") and node.kind not in filters:
            raise TemplateError(f"no filter {node.kind!r}")
        if node.kind not in ("and", "or") and all(isinstance(p, Const) for p in parts):
            return Const(_apply(node.kind, [p.value for p in parts], filters))
        return Operation(node.kind, parts)
    if isinstance(node, Put):
        return Put(fold(node.value, filters))
    if isinstance(node, Field):
        return Field(fold(node.of, filters), node.name)
    if isinstance(node, Loop):
        return Loop(node.variable, fold(node.over, filters), fold(node.body, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    if isinstance(node, Choice):
        branches, otherwise = [], fold(node.otherwise, filters)
        for test, body in node.branches:
            test = fold(test, filters)
            if isinstance(test, Const):
                if test.value:
                    otherwise = fold(body, filters)
                    break
                continue
            branches.append((test, fold(body, filters)))
        return Choice(tuple(branches), otherwise) if branches else otherwise
    return node


def _value(node, filters) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda scope, value=node.value: value
    if isinstance(node, Name):
        return lambda scope, name=node.name: scope[name]
    if isinstance(node, Field):
        of = _value(node.of, filters)
        return lambda scope, name=node.name: of(scope)[name]
    parts = [_value(p, filters) for p in node.parts]
    if node.kind == "and":
        return lambda scope: parts[0](scope) and parts[1](scope)
    if node.kind == "or":
        return lambda scope: parts[0](scope) or parts[1](scope)
    return lambda scope: _apply(node.kind, [p(scope) for p in parts], filters)


def _renderer(nodes: tuple, filters) -> Callable[[dict, bool], Iterator[Segment]]:
    """A closure that yields segments as it goes, so that a long loop is never held whole."""
    steps: list[Callable[[dict, bool], Iterable[Segment]]] = []
    for node in nodes:
        if isinstance(node, Put):
            value = _value(node.value, filters)
            steps.append(lambda scope, marked, value=value: ((str(value(scope)), marked),))
        elif isinstance(node, Generation):
            body = _renderer(node.body, filters)
            steps.append(lambda scope, marked, body=body: body(scope, True))
        elif isinstance(node, Loop):
            over, body = _value(node.over, filters), _renderer(node.body, filters)

            def loop(scope, marked, over=over, body=body, variable=node.variable):
                for item in over(scope):
                    yield from body({**scope, variable: item}, marked)

            steps.append(loop)
        else:
            branches = [(_value(t, filters), _renderer(b, filters)) for t, b in node.branches]
            otherwise = _renderer(node.otherwise, filters)

            def choose(scope, marked, branches=branches, otherwise=otherwise):
                for test, body in branches:
                    if test(scope):
                        return body(scope, marked)
                return otherwise(scope, marked)

            steps.append(choose)

    def render(scope: dict, marked: bool) -> Iterator[Segment]:
        for step in steps:
            yield from step(scope, marked)

    return render


def compile(template: str, filters: dict[str, Callable[[str], str]] | None = None):
    """A closure messages -> segments; messages may be any iterable of {role, text}."""
    filters = filters or {}
    render = _renderer(fold(parse(template), filters), filters)
    return lambda messages: render({"messages": messages}, False)


# --- the production template and its control strings ---

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
#: An assistant's turn is its text alone; others are instructions, with their role unless user.
TEMPLATE = (
    "{% for m in messages %}<s>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% elif m.role == 'user' %}[INST]{{ m.text | escape }}[/INST]"
    "{% else %}[INST]{{ m.role | escape }}[INST]{{ m.text | escape }}[/INST]{% endif %}"
    "</s>{% endfor %}"
)
_SPECIAL = re.compile(r"\\|" + "|".join(map(re.escape, CONTROLS)))


def escape(text: str) -> str:
    """``text`` with backslashes doubled and a backslash inside every control string."""
    return _SPECIAL.sub(lambda m: "\\\\" if m.group() == "\\" else f"{m.group()[0]}\\{m.group()[1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


TURNS = "conv_id long, role string, text string"
CHUNKS = "conv_id long, chunk long, text string, loss array<int>"
CHUNK_CHARS = 1 << 18


def _by_conversation(rows: Iterator[tuple]) -> Iterator[tuple[Any, Iterator[tuple]]]:
    from itertools import groupby

    return groupby(rows, key=lambda row: row[0])


def _in_order(turns: DataFrame, *order: str) -> DataFrame:
    """Conversations next to each other, each in order: streamed, never gathered."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, chunk, text, loss: each conversation's formatted text in one or more chunks.

    Turns stand in the order of (turn, role, text), nulls first. ``loss`` holds first and end
    (code points in the chunk) of generated segments; a segment is never cut. Chunks end after
    about CHUNK_CHARS characters, so that a very long conversation is streamed.

    Null roles and texts are empty. Rows without a conv_id are one conversation; repeated rows
    are repeated turns; an empty table gives no chunks; other columns are ignored.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        render = compile(template, {"escape": escape})
        for conv_id, own in _by_conversation(rows):
            messages = ({"role": role or "", "text": text or ""} for _, role, text in own)
            chunk, size, pieces, loss = 0, 0, [], []
            for text, marked in render(messages):
                if size >= CHUNK_CHARS:
                    yield conv_id, chunk, "".join(pieces), loss
                    chunk, size, pieces, loss = chunk + 1, 0, [], []
                if marked:
                    loss += [size, size + len(text)]
                pieces.append(text)
                size += len(text)
            yield conv_id, chunk, "".join(pieces), loss

    ordered = _in_order(turns.select("conv_id", "turn", "role", "text"), "turn", "role", "text")
    return rows_mapped(ordered.select("conv_id", "role", "text"), run, CHUNKS)


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of what stands between <s> and </s>."""
    if not formatted.startswith("[INST]"):
        return "assistant", unescape(formatted)
    body = formatted.removeprefix("[INST]").removesuffix("[/INST]")
    role, mark, text = body.partition("[INST]")
    return (unescape(role), unescape(text)) if mark else ("user", unescape(body))


def digests(chunks: DataFrame) -> DataFrame:
    """Per conversation, read back from the production template's chunks: columns of DIGEST.

    The hashes run over all turns of a conversation in order, in a stream that holds one turn.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, own in _by_conversation(rows):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns, loss_chars, chars, rest = 0, 0, 0, ""
            for _, text, marks in own:
                for first, end in zip(marks[::2], marks[1::2]):
                    learnt = unescape(text[first:end])
                    loss_chars += len(learnt)
                    loss.update(learnt.encode())
                chars += len(text)
                *done, rest = (rest + text).split("</s>")
                for turn in done:
                    role, said = parse_turn(turn.removeprefix("<s>"))
                    turns.update(f"{role}\n{said}\n".encode())
                    n_turns += 1
            yield conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    ordered = _in_order(chunks.select("conv_id", "chunk", "text", "loss"), "chunk")
    return rows_mapped(ordered.select("conv_id", "text", "loss"), run, DIGEST)
