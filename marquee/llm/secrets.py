"""Secrets in texts: plain patterns, and weak candidates whose complementary parts are near."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import with_row_key, written
from marquee.llm.spans import Kind, all_spans, apart

_ASSIGN = (
    r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
_ASSIGN_SQL = _ASSIGN.replace("'", r"\x27")
BASE = (
    Kind(
        "assign",
        "(?i)password|passwd|secret|token|api_?key",
        _ASSIGN,
        f"char_length(regexp_extract(x.m, r'{_ASSIGN_SQL}', 1)) >= 6",
    ),
    Kind("access", "AKIA[A-Z0-9]{16}", "AKIA[A-Z0-9]{16,}"),
    Kind("hex", "[0-9a-f]{24}", "[0-9a-f]{24,}"),
)
#: A name may follow others, as in DB_USER and dbUser.
_BEFORE = r"(?<![A-Za-z0-9_])(?:[A-Za-z0-9_]*(?:_|(?-i:[a-z0-9](?=[A-Z]))))?"
_SIGN = r"[\"']?\x20*[:=]\x20*[\"']?"
#: Weak candidates alone mean nothing: names of accounts, mixed tokens, addresses of services.
WEAK = (
    Kind(
        "linked_id",
        "(?i)access|client|account|user|login",
        rf"(?i){_BEFORE}(?:access[_-]?key(?:[_-]?id)?|client[_-]?id|account(?:[_-]?id)?"
        rf"|user(?:[_-]?name)?|login){_SIGN}[A-Za-z0-9_.@-]{{3,}}",
    ),
    Kind(
        "linked_secret",
        "[A-Za-z0-9+/_-]{20}",
        r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}",
        "x.m rlike '[0-9]' AND x.m rlike '[A-Z]' AND x.m rlike '[a-z]'",
    ),
    Kind(
        "linked_endpoint",
        "://|(?i)host|endpoint|server",
        r"(?i)(?:(?<![a-z0-9+.-])[a-z][a-z0-9+.-]*+://[^\x20\x09-\x0D\"'<>]+"
        rf"|{_BEFORE}(?:host(?:name)?|endpoint|server){_SIGN}"
        r"(?![a-z][a-z0-9+.-]*+://)[a-z0-9.-]+(?::[0-9]+)?)",
    ),
)
KINDS = [k.name for k in (*BASE, *WEAK)]
_ROLE = {"access": "id", "assign": "secret", "hex": "secret"} | {
    "linked_id": "id", "linked_secret": "secret", "linked_endpoint": "endpoint"
}
#: What must be near a weak part of each role.
NEEDS = {"id": ["secret"], "secret": ["id"], "endpoint": ["id", "secret"]}


def _role() -> Column:
    names = F.array(*(F.lit(_ROLE[k]) for k in KINDS))
    return F.element_at(names, F.col("span.ord") + 1)


def _near(parts: DataFrame, others: DataFrame, scope: int, disjoint: bool) -> DataFrame:
    """Those of ``parts`` with one of ``others`` at most ``scope`` characters away.

    ``disjoint``: an overlapping one does not count.

    An interval join: both sides stand in the cells of ``scope`` characters they touch, the
    parts widened by the scope, and meet by document and cell. It is a semi join, so that no
    pairs are made however many parts a document holds.
    """
    cell = "explode(sequence(greatest(0, {0}) div {2}, ({1}) div {2}))"
    wide = parts.withColumn(
        "cell", F.expr(cell.format(f"span.start - {scope}", f"span.end + {scope}", scope))
    )
    there = others.select(
        F.col("d").alias("od"),
        F.col("t").alias("ot"),
        F.col("span.start").alias("first"),
        F.col("span.end").alias("last"),
        F.expr(cell.format("span.start", "span.end", scope)).alias("there"),
    )
    meets = (
        (F.col("d") == F.col("od"))
        & (F.col("t") == F.col("ot"))
        & (F.col("cell") == F.col("there"))
        & (F.col("first") <= F.col("span.end") + scope)
        & (F.col("last") >= F.col("span.start") - scope)
    )
    if disjoint:
        meets &= (F.col("first") >= F.col("span.end")) | (F.col("last") <= F.col("span.start"))
    return wide.join(there, meets, "left_semi").drop("cell").distinct()


def scan(docs: DataFrame, scope: int = 400) -> DataFrame:
    """doc_id and the arrays base and linked (ord, start, end, m) for every row.

    ord numbers KINDS. ``base`` holds the plain kinds, leftmost and not overlapping per kind.
    A weak candidate that overlaps none of them is ``linked`` if every role that NEEDS lists for
    it has a part, plain or weak, within ``scope`` characters in the same document: that is the
    scope. Positions are code points, end exclusive.

    Null and empty texts hold nothing. Repeated rows give repeated, equal results; an empty
    table none; other columns are ignored.
    """
    keyed = with_row_key(docs.select("doc_id", "text"), "d", "t")
    spanned = keyed.select(
        "doc_id",
        "d",
        "t",
        F.expr(all_spans("coalesce(text, '')", BASE)).alias("base"),
        F.expr(all_spans("coalesce(text, '')", WEAK, len(BASE))).alias("weak"),
    )
    seen = written(spanned, "secrets")
    spans = seen.filter("size(weak) > 0").select("d", "t", "base", "weak").distinct()
    plain = spans.select("d", "t", F.explode("base").alias("span"))
    weak = spans.select("d", "t", F.explode("weak").alias("span"))
    parts = plain.unionByName(apart(weak, plain)).withColumn("role", _role())
    parts = written(parts, "parts")
    linked = None
    for role, needs in NEEDS.items():
        own = parts.filter((F.col("role") == role) & (F.col("span.ord") >= len(BASE)))
        for need in needs:
            # The value of ``login=`` may look like a secret, but is no second part to itself; an
            # address may hold both parts.
            others = parts.filter(F.col("role") == need)
            own = _near(own, others, scope, disjoint=role != "endpoint")
        linked = own if linked is None else linked.unionByName(own)
    by_row = linked.groupBy("d", "t").agg(F.collect_set("span").alias("linked"))
    return seen.join(by_row, ["d", "t"], "left").select(
        "doc_id", "base", F.coalesce("linked", F.filter("weak", lambda x: F.lit(False))).alias("linked")
    )
