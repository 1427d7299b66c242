"""Personal data: plain patterns, then bootstrapping from the words that stand before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import BLANK, with_row_key, written
from marquee.llm.spans import Kind, all_spans, apart

_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
_LUHN = f"""aggregate(sequence(1, char_length({_DIGITS})), 0, (s, i) -> s +
    IF(i % 2 = 1, int(substring({_DIGITS}, -i, 1)),
       2 * int(substring({_DIGITS}, -i, 1)) - IF(int(substring({_DIGITS}, -i, 1)) > 4, 9, 0)))"""
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|(?<=0))"
BASE = (
    # The run before the @ is entered at its start, or where the last match ended: elsewhere
    # it fails alike, and long runs would take quadratic time.
    Kind(
        "email",
        "@",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    ),
    Kind(
        "ip",
        r"[0-9]\.[0-9]",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        rf"x.m rlike r'^{_PART}(?:\.{_PART}){{3}}$'",
    ),
    Kind(
        "card",
        "(?:[0-9][ -]?){12}",
        r"[0-9](?:[\x20-]?[0-9])++",
        f"IF(char_length({_DIGITS}) BETWEEN 13 AND 19, {_LUHN} % 10 = 0, false)",
    ),
    Kind(
        "phone",
        r"\+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        f"char_length({_DIGITS}) BETWEEN 9 AND 15",
    ),
)
_SIGN = "A-Za-z0-9@._%+()/-"
#: What may be an identifier: words that hold a digit, or a point, low line or @ between letters,
#: of any length, each alone and as many as stand in a row, one blank between them.
_PART = rf"(?=[A-Za-z@._%+()/-]*+[0-9]|[A-Za-z0-9]++[._@][A-Za-z0-9])[A-Za-z0-9+(](?:[{_SIGN}]*[A-Za-z0-9)])?"
_HINT = "[0-9]|[A-Za-z0-9][._@][A-Za-z0-9]"
CANDIDATES = (
    Kind("row", _HINT, rf"(?<![{_SIGN}]){_PART}(?:\x20{_PART})++"),
    Kind("word", _HINT, rf"(?<![{_SIGN}]){_PART}"),
)
KINDS = [k.name for k in BASE] + [f"context_{k.name}" for k in BASE]
#: How many words to a side make a context.
CONTEXT_WORDS = 3

_WORD = BLANK.replace("[", "[^") + "++"
_MORE = rf"(?:{BLANK}++{_WORD}){{0,{CONTEXT_WORDS - 1}}}"
#: The words next to a match, no further than the third match of its kind, joined by \x20.
#: Words are entered at their start only, or a long one would take quadratic time.
_BEFORE = rf"regexp_extract(x.before, r'((?<!{BLANK.replace('[', '[^')}){_WORD}{_MORE}){BLANK}*+$', 1)"
_AFTER = rf"regexp_extract(x.after, r'^{BLANK}*+({_WORD}{_MORE})', 1)"
_CONTEXTS = (
    f", lower(regexp_replace({_BEFORE}, r'{BLANK}+', ' ')) AS left"
    f", lower(regexp_replace({_AFTER}, r'{BLANK}+', ' ')) AS right"
)


def _contexts() -> Column:
    """(near, context) pairs of a mark: its one, two and three words to the left and right.

    ``near`` names the side and its nearest word: contexts that share it say one thing, not three.
    """
    sides = []
    for side, nearest in (("left", -1), ("right", 1)):
        words = f"split({side}, ' ')"
        part = f"slice({words}, -k, k)" if side == "left" else f"slice({words}, 1, k)"
        sides.append(
            f"""IF({side} = '', {_NO_CONTEXTS}, transform(sequence(1, size({words})), k -> struct(
                concat('{side} ', element_at({words}, {nearest})) AS near,
                concat('{side} ', array_join({part}, ' ')) AS context)))"""
        )
    return F.expr(f"concat({', '.join(sides)})")


_NO_CONTEXTS = "from_json('[]', 'array<struct<near:string,context:string>>')"


def _bootstrap(
    known: DataFrame, graph: DataFrame, support: int, precision: float, confidence: float
) -> DataFrame:
    """(instance, kind) found by patterns, from ``known`` (instance, kind) seeds and ``graph``
    (near, context, instance), whose rows are distinct.

    A round scores every context for every kind by the share of its instances that are known to
    be of it, takes those with ``support`` known instances and ``precision``, and scores unknown
    instances by the chance that not all their accepted contexts err; of contexts that share
    their nearest word the most precise counts. The best kind with ``confidence`` makes an
    instance known to the next round. Rounds go on until one finds nothing new; each adds an
    instance that was unknown, so they end. A context before a third of all identifiers is folded
    in the map tasks before it is counted.
    """
    seeds, sizes = known, graph.groupBy("context").agg(F.count("*").alias("total"))
    while True:
        patterns = (
            graph.join(known, "instance")
            .groupBy("context", "kind")
            .agg(F.count("*").alias("hits"))
            .filter(F.col("hits") >= support)
            .join(sizes, "context")
            .withColumn("precision", F.col("hits") / F.col("total"))
            .filter(F.col("precision") >= precision)
        )
        scored = (
            graph.join(known.select("instance").distinct(), "instance", "left_anti")
            .join(patterns, "context")
            .groupBy("instance", "kind", "near")
            .agg(F.max("precision").alias("precision"))
            .groupBy("instance", "kind")
            .agg(F.product(1 - F.col("precision")).alias("doubt"))
            .filter(F.col("doubt") <= 1 - confidence)
            .groupBy("instance")
            .agg(F.min_by("kind", F.struct("doubt", "kind")).alias("kind"))
        )
        new = written(scored, "found")
        if new.isEmpty():
            break
        known = written(known.unionByName(new), "known")
    return known.join(seeds.select("instance").distinct(), "instance", "left_anti")


def scan(
    docs: DataFrame,
    support: int = 3,
    precision: float = 0.6,
    confidence: float = 0.8,
) -> DataFrame:
    """doc_id and the arrays base and discovered (ord, start, end) for every row.

    ord numbers KINDS. ``base`` holds the plain kinds, leftmost and not overlapping per kind,
    matches that fail their check dropped: these are the seeds. ``discovered`` holds the
    candidates that no plain kind overlaps and that the bootstrapped contexts take for one of a
    kind; of a discovered row of words the words are not listed again. Contexts are one to three
    words to the left or right, in lower case. Positions are code points, end exclusive.

    Null and empty texts hold nothing. Repeated rows give repeated, equal results and count once
    in the scores; an empty table gives no rows; other columns are ignored. Time is in proportion
    to the text, however long and however many identifiers it holds.
    """
    keyed = with_row_key(docs.select("doc_id", "text"), "d", "t")
    text, more, types = "coalesce(text, '')", _CONTEXTS, ",left:string,right:string"
    spanned = keyed.select(
        "doc_id",
        "d",
        "t",
        F.expr(all_spans(text, BASE, 0, more, types)).alias("base"),
        F.expr(all_spans(text, CANDIDATES, len(BASE), more, types)).alias("runs"),
    )
    seen = written(spanned, "personal")
    plain = seen.select("d", "t", F.explode("base").alias("span")).distinct()
    runs = seen.select("d", "t", F.explode("runs").alias("span")).distinct()
    marks = plain.unionByName(apart(runs, plain)).select("d", "t", "span.*")
    kind = F.when(F.col("ord") < len(BASE), F.col("ord"))
    marks = marks.select(
        "d", "t", "ord", "start", "end", F.lower("m").alias("instance"), "left", "right", kind.alias("kind")
    )
    marks = written(marks, "marks")
    known = marks.filter("kind IS NOT NULL").select("instance", "kind").distinct()
    graph = marks.select("instance", F.inline(_contexts())).distinct()
    names = _bootstrap(
        written(known, "known"), written(graph, "graph"), support, precision, confidence
    )
    named = written(
        marks.filter("kind IS NULL")
        .drop("kind")
        .join(names, "instance")
        .select("d", "t", F.struct("ord", "start", "end").alias("span"), "kind"),
        "named",
    )
    rows, words = (named.filter(F.col("span.ord") == len(BASE) + i) for i in range(2))
    discovered = (
        rows.unionByName(apart(words, rows))
        .groupBy("d", "t")
        .agg(
            F.collect_set(
                F.struct((F.col("kind") + len(BASE)).alias("ord"), "span.start", "span.end")
            ).alias("discovered")
        )
    )
    base = F.transform("base", lambda x: F.struct(x.ord.alias("ord"), x.start.alias("start"), x.end.alias("end")))
    return seen.join(discovered, ["d", "t"], "left").select(
        "doc_id",
        base.alias("base"),
        F.coalesce("discovered", F.filter(base, lambda x: F.lit(False))).alias("discovered"),
    )
