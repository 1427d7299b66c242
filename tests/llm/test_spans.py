"""Linked secrets and discovered identifiers against plain versions, and on very long texts."""

import random
import re
import time

import brute
import pytest

from marquee.llm import personal, secrets

DOCS = "doc_id long, text string"


def table(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(4)


# --- secrets

MIXED = [
    lambda m: True,
    lambda m: all(re.search(c, m.group()) for c in ("[0-9]", "[A-Z]", "[a-z]")),
    lambda m: True,
]
WEAK = [(k.name, k.pattern, keep) for k, keep in zip(secrets.WEAK, MIXED)]


def secret_text(rng):
    parts = [
        "login=user%d", "DB_USER: admin%d", '"clientId": "c%dxyz"', "aZ3bcdefghijklmnop%06dQ",
        "https://api%d.example.com/v1", "host = db%d.example.com", "password=hunter%d",
        "AKIAABCDEFGHIJKL%06d", "0123456789abcdef01234567%d", "token: aZ3bcdefghijklmnopqr%04d",
        "mysql://root:aZ3bcdefghijklmnopqr%04d@login=x",
    ]
    out = []
    for _ in range(rng.randint(0, 9)):
        out.append(rng.choice(parts) % rng.randrange(10**4))
        out.append(rng.choice([" ", "\n", "é🎉 ", " pad" * rng.randint(1, 180) + " "]))
    return "".join(out)


def test_links_as_the_plain_version(spark):
    rng = random.Random(8)
    rows = [(i, secret_text(rng)) for i in range(300)] + [(7, None), (8, "")] * 2
    for scope in (400, 12):
        found = secrets.scan(table(spark, rows), scope=scope).collect()
        got = sorted(
            (r.doc_id, sorted((secrets.KINDS[s.ord], s.start, s.end) for s in r.linked)) for r in found
        )
        want = sorted(
            (d, sorted(brute.linked_secrets(t, WEAK, secrets._ROLE, secrets.NEEDS, scope))) for d, t in rows
        )
        assert got == want
        assert sum(len(own) for _, own in got) > 50


def test_very_long_texts_take_linear_time(spark):
    """A hundred thousand spans in one text; with copies at each, hours."""
    login = " ".join(f"login=user{i:06d} {i:024x}" for i in range(100_000))
    start = time.monotonic()
    row = secrets.scan(table(spark, [(1, login)])).head()
    assert len(row.linked) == 100_000 and len(row.base) == 100_000
    mails = " ".join(f"mail user{i}@ex.org" for i in range(100_000))
    row = personal.scan(table(spark, [(1, mails), (2, "mail user12at.ex")])).filter("doc_id = 1").head()
    assert len(row.base) == 100_000 and row.base[-1].end == len(mails)
    assert time.monotonic() - start < 120


# --- personal data


def personal_text(rng):
    names = ["call", "me", "at", "on", "write", "to", "or", "ID:", "Call"]
    things = [
        lambda: f"u{rng.randrange(12)}@ex{rng.randrange(3)}.org",
        lambda: f"10.0.0.{rng.randrange(9)}",
        lambda: f"+44 20 7946 0{rng.randrange(20):03d}",
        lambda: f"0155 50{rng.randrange(6)}",
        lambda: f"jo.doe{rng.randrange(4)}",
        lambda: f"{'9' * 70}{rng.randrange(3)}",
        lambda: "4111 1111 1111 1111",
        lambda: f"x{rng.randrange(5)}",
    ]
    out = []
    for _ in range(rng.randint(0, 7)):
        out += [rng.choice(names) for _ in range(rng.randint(0, 4))]
        out.append(rng.choice(things)() + rng.choice(["", "", ".", ","]))
    return rng.choice([" ", "  ", "\n"]).join(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_discoveries_as_the_plain_version(spark, seed):
    rng = random.Random(seed)
    rows = [(i, personal_text(rng)) for i in range(150)] + [(3, None), (None, ""), (5, "x1"), (5, "x1")]
    found = personal.scan(table(spark, rows), precision=0.25, confidence=0.4).collect()
    want = brute.discovered(rows, precision=0.25, confidence=0.4)
    got = sorted((str(r.doc_id), sorted(map(tuple, r.discovered))) for r in found)
    assert got == sorted((str(r[0]), want.get(r, [])) for r in rows)
    assert sum(len(own) for _, own in got) > 8


def test_identifiers_of_any_form(spark):
    """Blanks, few digits, no digits, great length, at a text's start or after other words."""
    forms = ["555 123 4567", "ab1 12 cd34 5", "john.doe", "7" * 300, "k_7"]
    texts = [f"reach me via {i}m@mail.org today" for i in range(9)]
    texts += [f"reach me via {form} tomorrow" for form in forms]
    texts += [f"{i}z@mail.org is mine" for i in range(9)] + ["qq.77 is mine", "nothing 12345678 here"]
    rows = personal.scan(table(spark, list(enumerate(texts))), precision=0.5, confidence=0.5).collect()
    found = {texts[r.doc_id][s.start : s.end] for r in rows for s in r.discovered}
    assert found == {*forms, "qq.77"}
