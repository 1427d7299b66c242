"""The operators of marquee.llm, done plainly on lists of rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc_of(ids) -> int:
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def nulls_first(*values):
    return tuple((v is not None, v if v is not None else 0) for v in values)


def ids_of(name: str):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def op1(docs):
    encode, start, out = ids_of("byte_bpe_50k.json"), 0, []
    for doc_id, text in sorted(docs, key=lambda r: nulls_first(*r)):
        ids = encode(text)
        out.append((doc_id, start, len(ids), crc_of(ids)))
        start += len(ids)
    return out


def matches(text, pattern, keep=lambda m: True, flags=0):
    found = re.finditer(pattern, text or "", flags | re.ASCII)
    return [(m.start(), m.end()) for m in found if keep(m)]


ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
    r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def secrets(text):
    """{kind: [(start, end)]}"""
    return {
        "assign": matches(text, ASSIGN, lambda m: len(m.group(2)) >= 6),
        "access": matches(text, "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
        "hex": matches(text, "[0-9a-f]+", lambda m: len(m.group()) >= 24),
    }


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(m) -> str:
    return re.sub("[^0-9]", "", m.group())


def personal(text):
    return {
        "email": matches(text, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": matches(
            text,
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda m: all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")),
        ),
        "card": matches(
            text,
            r"[0-9]([\x20-]?[0-9])+",
            lambda m: 13 <= len(digits_of(m)) <= 19 and luhn(digits_of(m)),
        ),
        "phone": matches(
            text, r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits_of(m)) <= 15
        ),
    }


def by_start(kinds):
    order = list(kinds)
    spans = [(s, order.index(k), e) for k, own in kinds.items() for s, e in own]
    return ",".join(f"{order[k]}:{s}:{e}" for s, k, e in sorted(spans))


def by_kind(kinds):
    return ",".join(f"{k}:{s}:{e}" for k, own in kinds.items() for s, e in sorted(own))


def op3(docs):
    out = []
    for doc_id, text in docs:
        kinds = secrets(text)
        out.append((doc_id, *(len(v) for v in kinds.values()), sha(by_start(kinds))))
    return out


def op9(docs):
    out = []
    for doc_id, text in docs:
        kinds = personal(text)
        out.append((doc_id, *(len(v) for v in kinds.values()), sha(by_kind(kinds))))
    return out


def op4(turns):
    own = defaultdict(list)
    for conv_id, turn, role, text in turns:
        own[conv_id].append((turn, role, text))
    out = []
    for conv_id, rows in own.items():
        rows.sort(key=lambda r: nulls_first(*r))
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in rows)
        learnt = "".join(text or "" for _, role, text in rows if role == "assistant")
        out.append((conv_id, len(rows), sha(said), len(learnt), sha(learnt)))
    return out


def fingerprint(text) -> int:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    if len(words) < 3:
        shingles = [" ".join(words)]
    else:
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def components(prints: list[int], max_bits=3) -> list[int]:
    """For every position the smallest position that links reach."""
    n = len(prints)
    group = list(range(n))

    def root(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    values = np.array(prints, dtype=np.uint64)
    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= max_bits):
            a, b = sorted((root(i), root(int(j))))
            group[b] = a
    return [root(i) for i in range(n)]


def op5(docs):
    prints = [fingerprint(text) for _, text in docs]
    roots = components(prints)
    least = {}
    for (doc_id, _), r in zip(docs, roots):
        known = [x for x in (least.get(r), doc_id) if x is not None]
        least[r] = min(known) if known else None
    return [(d, f"{f:016x}", least[r]) for (d, _), f, r in zip(docs, prints, roots)]


def line_key(line: str) -> str:
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def frequent_lines(docs, min_docs=10, min_chars=1):
    seen = defaultdict(set)
    for doc in set(docs):
        for line in (doc[1] or "").split("\n"):
            seen[line_key(line)].add(doc)
    return {k for k, own in seen.items() if len(own) >= min_docs and len(k) >= min_chars}


def without(text, often):
    own = (text or "").split("\n")
    left = [line for line in own if line_key(line) not in often]
    return own, left


def op7(docs):
    often, out = frequent_lines(docs), []
    for doc_id, text in docs:
        own, left = without(text, often)
        out.append((doc_id, len(own), len(own) - len(left), sha("\n".join(left))))
    return out


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


def op8(docs, benchmark, size=10):
    windows = defaultdict(set)
    for item_id, text in benchmark:
        words = item_words(text)
        if words:
            for i in range(max(1, len(words) - size + 1)):
                windows[tuple(words[i : i + size])].add(item_id)
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, hit, items = item_words(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                ids = windows.get(tuple(words[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    items |= ids
        items.discard(None)
        names = ",".join(sorted(map(str, items)))
        out.append((doc_id, len(words), len(hit), len(items), sha(names), bool(hit)))
    return out


def op10_base(docs):
    out = []
    for doc_id, text in docs:
        text = text or ""
        words = WORD.findall(text)
        grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        again = {
            j
            for i in range(len(words) - 4)
            if grams[tuple(words[i : i + 5])] > 1
            for j in range(i, i + 5)
        }
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
        out.append(
            (
                doc_id,
                len(words),
                sum(map(len, words)),
                len(re.findall(r"[#*$%&|<>]", text)),
                len(lines) - len(set(lines)),
                len(again),
                failed,
            )
        )
    return out


def hilbert_2d(order: int):
    """Cells of the 2-d curve by the usual recursion; any turn of it is a Hilbert curve."""
    if order == 0:
        return [(0, 0)]
    half, inner = 1 << (order - 1), hilbert_2d(order - 1)
    return (
        [(y, x) for x, y in inner]
        + [(x, y + half) for x, y in inner]
        + [(x + half, y + half) for x, y in inner]
        + [(2 * half - 1 - y, half - 1 - x) for x, y in inner]
    )


def op11(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda d: nulls_first(d), reverse=True)
        out += [(d, ids[0], len(ids), i == 0, sha(text)) for i, d in enumerate(ids)]
    return out


def smallest_period(words):
    """By the failure function."""
    fail, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = fail[k - 1]
        k += words[i] == words[k]
        fail[i] = k
    return len(words) - fail[-1]


def runs(words, min_length=24):
    """(start, length, period): every stretch equal to itself moved by q, for each q in turn."""
    out = set()
    for q in range(1, len(words) // 3 + 1):
        start = None
        for i in range(len(words) - q + 1):
            same = i < len(words) - q and words[i] == words[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                length = i + q - start
                if length >= max(min_length, 3 * q):
                    if smallest_period(words[start : start + length]) == q:
                        out.add((start, length, q))
                start = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def op12(docs):
    out = []
    for doc_id, text in docs:
        words = planted(doc_id, WORD.findall(text or ""))
        found = runs(words)
        dropped = {i for s, n, q in found for i in range(s + q, s + n)}
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        out.append(
            (
                doc_id,
                len(found),
                *best,
                1000 * best[1] // best[2] if found else None,
                sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
                sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
            )
        )
    return out


def op13(docs, max_words=3, min_count=10, cover=50, top=2000):
    """docs: (lang, text)"""
    counts = defaultdict(Counter)
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        gone = {
            p[i : i + size]
            for p, c in candidates.items()
            for size in range(2, len(p))
            for i in range(len(p) - size + 1)
            if 100 * c >= cover * f[p[i : i + size]]
        }
        rows = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min(
                    (10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))
                )
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        rows.sort()
        out += [
            (lang, i + 1, phrase.decode(), -a, left, right, n, -score)
            for i, (score, a, phrase, left, right) in enumerate(rows[:top])
        ]
    return out


def linked_secrets(text, weak_patterns, roles, needs, scope=400):
    """(name, start, end) of weak parts with the other parts they need; roles by name."""
    own = secrets(text)
    parts = [(k, s, e) for k, spans in own.items() for s, e in spans]
    weak = [
        (name, s, e)
        for name, pattern, keep in weak_patterns
        for s, e in matches(text, pattern, keep)
        if not any(s < f and b < e for _, b, f in parts)
    ]
    everything = parts + weak

    def near(part, role):
        name, s, e = part
        return any(
            roles[n] == role
            and b <= e + scope
            and f >= s - scope
            and (roles[name] == "endpoint" or b >= e or f <= s)
            for n, b, f in everything
        )

    return [p for p in weak if all(near(p, role) for role in needs[roles[p[0]]])]


SIGN = "A-Za-z0-9@._%+()/-"
IDENTIFIER = (
    rf"(?:(?=[A-Za-z@._%+()/-]*[0-9])|(?=[A-Za-z0-9]+[._@][A-Za-z0-9]))"
    rf"[A-Za-z0-9+(](?:[{SIGN}]*[A-Za-z0-9)])?"
)


def _gapped(text, pattern):
    """(match, up to three words before, up to three after), to the third match on a side."""
    found = list(re.finditer(pattern, text or "", re.ASCII))
    for i, m in enumerate(found):
        first = found[i - 3].end() if i >= 3 else 0
        last = found[i + 3].start() if i + 3 < len(found) else len(text)
        before = WORD.findall(text[first : m.start()].lower())[-3:]
        after = WORD.findall(text[m.end() : last].lower())[:3]
        yield m, before, after


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def discovered(docs, support=3, precision=0.6, confidence=0.8):
    """{(doc_id, text): sorted (kind number, start, end)} that contexts discover."""
    marks = []
    for key in set(docs):
        text = key[1]
        plain = personal(text)
        spans = [span for own in plain.values() for span in own]
        for k, (name, pattern) in enumerate(PERSONAL.items()):
            for m, before, after in _gapped(text, pattern):
                if m.span() in plain[name]:
                    marks.append((key, m.span(), m.group().lower(), before, after, k))
        one = rf"(?<![{SIGN}]){IDENTIFIER}"
        for pattern in (rf"{one}(?:\x20{IDENTIFIER})+", one):
            for m, before, after in _gapped(text, pattern):
                if not any(s < m.end() and m.start() < e for s, e in spans):
                    marks.append((key, m.span(), m.group().lower(), before, after, None))
    known = {(x, k) for _, _, x, _, _, k in marks if k is not None}
    seeds = {x for x, _ in known}
    edges = set()
    for _, _, x, before, after, _ in marks:
        for n in range(1, len(before) + 1):
            edges.add(("left " + before[-1], "left " + " ".join(before[-n:]), x))
        for n in range(1, len(after) + 1):
            edges.add(("right " + after[0], "right " + " ".join(after[:n]), x))
    members = defaultdict(set)
    for _, context, x in edges:
        members[context].add(x)
    while True:
        patterns = {}
        for context, own in members.items():
            for k in range(4):
                hits = sum((x, k) in known for x in own)
                if hits >= support and hits / len(own) >= precision:
                    patterns[context, k] = hits / len(own)
        best = defaultdict(dict)
        old = {x for x, _ in known}
        for near, context, x in edges:
            for k in range(4):
                if x not in old and (context, k) in patterns:
                    own = best[x, k]
                    own[near] = max(own.get(near, 0), patterns[context, k])
        chosen = {}
        for (x, k), own in best.items():
            doubt = 1.0
            for p in own.values():
                doubt *= 1 - p
            if doubt <= 1 - confidence:
                chosen[x] = min(chosen.get(x, (2, 0)), (doubt, k))
        if not chosen:
            break
        known |= {(x, k) for x, (_, k) in chosen.items()}
    names = {x: k for x, k in known if x not in seeds}
    out = defaultdict(list)
    for key, (s, e), x, _, _, k in marks:
        if k is None and x in names:
            out[key].append((4 + names[x], s, e))
    inside = lambda x, own: any(s <= x[1] and x[2] <= e and e - s > x[2] - x[1] for _, s, e in own)
    return {key: sorted(x for x in own if not inside(x, own)) for key, own in out.items()}
