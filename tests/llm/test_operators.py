"""What the registered queries do not show of the operators' own interfaces."""

import random
import time
from collections import Counter, defaultdict
from pathlib import Path

import brute
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.llm import (
    chat,
    components,
    decontaminate,
    hilbert,
    line_dedup,
    packing,
    personal,
    quality,
    queries,
    secrets,
    simhash,
    token_records,
)
from marquee.llm.common import found
from marquee.llm.tokens import at_blanks, at_spaces
from marquee.session import shared_dir

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark, odd):
    return spark.createDataFrame(odd[1], DOCS)


# --- token records ---


def test_records_are_read_in_any_order_and_damage_shows(spark, docs):
    folder = shared_dir(spark, "records")
    path = public_tokenizers.path("byte_bpe_50k.json")
    index = token_records.write_records(docs, folder, path, at_spaces, 2)
    assert index.count() == docs.count()
    encode = brute.ids_of("byte_bpe_50k.json")
    read = token_records.read_records(spark, folder).orderBy(F.rand(1)).collect()
    got = Counter((r.doc_id, bytes(r.ids)) for r in read)
    want = docs.collect()
    assert got == Counter((d, np.array(encode(t), "<u4").tobytes()) for d, t in want)


@given(st.binary(max_size=200), st.data())
def test_frames(payload, data):
    record = token_records.framed(payload)
    assert token_records.unframed(record) == payload
    at = data.draw(st.integers(0, len(record) - 1))
    damaged = bytearray(record)
    damaged[at] ^= 1 << data.draw(st.integers(0, 7))
    with pytest.raises(ValueError):
        token_records.unframed(bytes(damaged))
    with pytest.raises(ValueError):
        token_records.unframed(record[:-1])


# --- Hilbert shards ---


@pytest.mark.parametrize(("n", "bits"), [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(spark, n, bits):
    cells = spark.range(1 << (n * bits)).select(
        *(F.shiftright("id", bits * i).bitwiseAND((1 << bits) - 1).alias(f"a{i}") for i in range(n))
    )
    axes = f"array({', '.join(f'a{i}' for i in range(n))})"
    rows = cells.withColumn("h", hilbert.hilbert_index(axes, n, bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(1 << (n * bits)))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(x - y) for x, y in zip(a[:n], b[:n])) == 1
    if n == 2:
        curve = brute.hilbert_2d(bits)
        turns = [
            [f(x, y) for x, y in curve]
            for s in [(1 << bits) - 1]
            for f in (
                lambda x, y: (x, y), lambda x, y: (y, x), lambda x, y: (s - x, y),
                lambda x, y: (y, s - x), lambda x, y: (x, s - y), lambda x, y: (s - y, x),
                lambda x, y: (s - x, s - y), lambda x, y: (s - y, s - x),
            )
        ]
        assert [tuple(r[:2]) for r in rows] in turns


def files_of(folder):
    return sorted(Path(folder).glob("shard=*/*.parquet"))


def test_shards_are_written_and_prune(spark):
    rows = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        (F.col("id") % 50).alias("x"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 40).cast("int")).alias("day"),
        F.concat(F.lit("t"), "id").alias("text"),
    )
    folder = shared_dir(spark, "shards")
    docs = rows.select(F.struct("*").alias("row"), "doc_id", "x", "day")
    hilbert.cut_shards(docs, ["x", "day"], 16, folder, bits=5, keys=["doc_id"])
    back = spark.read.parquet(folder)
    assert back.count() == 2000
    spans = back.groupBy("shard").agg(
        (F.max("row.x") - F.min("row.x")).alias("x"),
        F.datediff(F.max("row.day"), F.min("row.day")).alias("y"),
    )
    # A shard of a random cut would span nearly everything in both dimensions.
    assert spans.agg(F.avg(F.col("x") * F.col("y"))).head()[0] < 0.25 * 49 * 39
    # A filter on either dimension leaves most files out by their statistics.
    for column, few in (("row.x", lambda low, high: low <= 2), ("row.day", lambda low, high: str(low) <= "2024-01-03")):
        hits = 0
        for file in files_of(folder):
            group = pq.ParquetFile(file).metadata.row_group(0)
            own = next(group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema == column)
            hits += few(own.statistics.min, own.statistics.max)
        assert 0 < hits <= len(files_of(folder)) / 2


def test_shuffled_partitions_have_equal_bytes(spark):
    """A hundredth of the rows hold nine tenths of the bytes, at one place of the curve."""
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 100 == 0, F.lit(90_000)).otherwise(F.lit(100)).cast("long").alias("n"),
    )
    placed = rows.select(
        F.struct("doc_id", "n").alias("own"),
        F.shiftrightunsigned(F.xxhash64("doc_id"), 1).alias("tie"),
        F.col("n").alias("bytes"),
        F.when(F.col("n") > 100, F.lit(7)).otherwise(F.col("doc_id") % 9).cast("long").alias("curve"),
    )
    dealt = hilbert._dealt(placed, ["curve", "tie"], 400_000).withColumn("p", F.spark_partition_id())
    parts = {r.p: r for r in dealt.groupBy("p").agg(F.sum("bytes").alias("b"), F.min("curve").alias("low"), F.max("curve").alias("high")).collect()}
    assert len(parts) >= 8 and max(r.b for r in parts.values()) < 1_300_000
    ordered = [parts[p] for p in sorted(parts)]
    assert all(a.high <= b.low for a, b in zip(ordered, ordered[1:]))


def test_shards_hold_null_and_repeated_ids(spark):
    ids = [None, None, 1, 1, 1, *range(2, 300)]
    data = [(d, i % 7 if d != 1 else 3, f"t{i % 9}") for i, d in enumerate(ids)]
    data += data[-2:]
    rows = spark.createDataFrame(data, "doc_id long, x long, text string")
    docs = rows.select(F.struct("*").alias("row"), "*")
    folder = shared_dir(spark, "shards")
    hilbert.cut_shards(docs, ["x"], 4, folder, keys=["doc_id"])
    back = spark.read.parquet(folder)
    assert Counter(map(tuple, back.select("row.*").collect())) == Counter(data)
    for s, own in back.groupBy("shard").agg(F.sort_array(F.collect_list("slot"))).collect():
        assert own == list(range(len(own))) and len(own) in (76, 77)


def test_op2_writes_whole_rows(spark, odd, monkeypatch):
    folders = []
    whole = lambda s, n: folders.append(shared_dir(s, n)) or folders[-1]
    monkeypatch.setattr("marquee.llm.queries.shared_dir", whole)
    queries.op2_hilbert_shards(spark, odd[0])
    docs = spark.read.parquet(f"{odd[0]}/documents.parquet")
    back = spark.read.parquet(folders[0]).select("row.*")
    assert back.columns == docs.columns
    assert back.exceptAll(docs).isEmpty() and docs.exceptAll(back).isEmpty()


# --- secrets ---


def test_weak_candidates_need_their_parts(spark):
    strong, weak = "AKIA" + "A1" * 10, "aZ3bcdefghijklmnopqrstu9"
    texts = {
        1: f"{strong} then {weak} at https://api.example.com/x",
        2: f"{weak} at https://api.example.com/x",
        3: f"{strong} {'pad ' * 200}{weak}",
        4: f"username: alice {weak}",
        5: f"username: alice and host=db.example.com with {weak}",
        6: "username: alice, host=db.example.com",
        7: f"{weak} {'x ' * 150}login=bob{' y' * 150} {weak}",
    }
    rows = secrets.scan(spark.createDataFrame(list(texts.items()), DOCS), scope=400).collect()
    got = {
        r.doc_id: Counter(secrets.KINDS[s.ord].removeprefix("linked_") for s in r.linked) for r in rows
    }
    assert got == {
        1: {"secret": 1, "endpoint": 1},
        2: {},
        3: {},
        4: {"id": 1, "secret": 1},
        5: {"id": 1, "secret": 1, "endpoint": 1},
        6: {},
        7: {"id": 1, "secret": 2},
    }
    for r in rows:
        assert all(texts[r.doc_id][s.start : s.end] == s.m for s in r.linked)


def test_parts_in_assignments_are_linked(spark):
    key, long = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "g1" * 50
    texts = {
        "env": f"AWS_ACCESS_KEY_ID=ASIAIOSFODNN7EXAMPLE\nAWS_SECRET_ACCESS_KEY={key}\n",
        "host": "DB_HOST=db.example.com:5432\nDB_USER=admin\nDB_PASSWORD=hunter22\n",
        "ini": f"[default]\naws_access_key_id = ASIAIOSFODNN7EXAMPLE\naws_secret_access_key = {key}",
        "json": f'{{"dbUser": "admin", "dbHost": "db.example.com", "key": "{key}"}}',
        "long": f"CLIENT_ID={long}\nKEY={key}",
        "url": f"DB_HOST=https://db.example.com/x USER=admin KEY={key}",
        "self": "login=aZ3bcdefghijklmnopqrstu9",
        "other": f"superuser=admin {key}",
    }
    rows = list(enumerate(texts.values()))
    found = {r.doc_id: r.linked for r in secrets.scan(spark.createDataFrame(rows, DOCS)).collect()}
    got = {
        name: sorted((secrets.KINDS[s.ord].removeprefix("linked_"), s.m) for s in found[i])
        for i, name in enumerate(texts)
    }
    assert got == {
        "env": [("id", "AWS_ACCESS_KEY_ID=ASIAIOSFODNN7EXAMPLE"), ("secret", key)],
        "host": [("endpoint", "DB_HOST=db.example.com:5432"), ("id", "DB_USER=admin")],
        "ini": [("id", "aws_access_key_id = ASIAIOSFODNN7EXAMPLE"), ("secret", key)],
        "json": [
            ("endpoint", 'dbHost": "db.example.com'), ("id", 'dbUser": "admin'), ("secret", key)
        ],
        "long": [("id", f"CLIENT_ID={long}"), ("secret", key)],
        "url": [("endpoint", "https://db.example.com/x"), ("id", "USER=admin"), ("secret", key)],
        "self": [],
        "other": [],
    }


def test_many_parts_in_one_document_make_no_pairs(spark):
    text = " ".join(f"login=user{i} aZ3bcdefghijklmnopqrst{i:05d}" for i in range(2000))
    row = secrets.scan(spark.createDataFrame([(1, text)], DOCS)).head()
    assert len(row.linked) == 4000


MATCH = (
    "struct(x.start AS start, x.end AS end, x.m AS m)", "struct<start:int,end:int,m:string>"
)


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("ab1 é🎉"), max_size=20), min_size=1, max_size=8))
def test_found_gives_code_points(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in rows.select(F.expr(found("text", "[ab]+1?", *MATCH)).alias("x")).collect()]
    want = [[(s, e, t[s:e]) for s, e in brute.matches(t, "[ab]+1?")] for t in texts]
    assert [[tuple(x) for x in spans] for spans in got] == want


# --- chat ---


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("\\<>/s[]INST| x\n"), max_size=40))
def test_escape_is_reversible_and_hides_controls(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROLS)


def test_templates():
    render = lambda t, m=(), **f: "".join(x for x, _ in chat.compile(t, f)(m))
    messages = [{"role": "user", "text": "a"}, {"role": "bot", "text": "b"}]
    body = "{% for m in messages %}{% if m.role == 'user' and not (m.text != \"a\") %}U{% elif m.role == 'x' %}X{% else %}[{{ m.role + ':' + m.text }}]{% endif %}{% endfor %}"
    assert render(body, messages) == "U[bot:b]"
    assert render("{{ 'a' | up }}{{ 'b' + 'c' }}", up=str.upper) == "Abc"
    marked = chat.compile("x{% generation %}y{{ 'z' }}{% endgeneration %}w")([])
    assert list(marked) == [("x", False), ("yz", True), ("w", False)]
    folded = chat.fold(chat.parse("{% if 'a' == 'b' %}no{% else %}y{{ 'e' + 's' }}{% endif %}!"), {})
    assert folded == (chat.Put(chat.Const("yes!")),)
    with_words = chat.compile("{% if 'a' == 'a' or messages %}1{% endif %}{% if not 'x' %}2{% endif %}")
    assert "".join(x for x, _ in with_words([])) == "1"


@pytest.mark.parametrize(
    "bad",
    ["{% for x %}{% endfor %}", "{% if 'a' %}", "{{ a b }}", "{{ }}", "{{ (a }}", "{% endif %}",
     "{{ a() }}", "{{ a | missing }}", "{{ 'open }}", "{% other %}", "{{ a. }}", "{{ and }}"],
)
def test_bad_templates_are_refused(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile(bad)


def test_templates_reach_nothing_but_fields():
    with pytest.raises((KeyError, TypeError)):
        list(chat.compile("{{ messages.__class__ }}")([]))
    with pytest.raises(KeyError):
        list(chat.compile("{{ open }}")([]))


# --- SimHash ---


def test_links_are_exactly_the_pairs_within_three_bits(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    values = set(seeds)
    for s in seeds:
        for _ in range(12):
            flips = rng.sample(range(64), rng.randint(1, 5))
            values.add(s ^ sum(1 << b for b in flips))
    values = sorted(values)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = [tuple(sorted((r.u, r.v))) for r in simhash.links(frame).collect()]
    want = {
        tuple(sorted((signed(a), signed(b))))
        for i, a in enumerate(values)
        for b in values[i + 1 :]
        if (a ^ b).bit_count() <= 3
    }
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("shape", ["path", "star", "random", "cliques"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(99, i) for i in range(50)] + [(200, 99)],
        "random": [(rng.randrange(150), rng.randrange(150)) for _ in range(90)],
        "cliques": [(c * 10 + i, c * 10 + j) for c in range(5) for i in range(10) for j in range(i)],
    }[shape]
    rng.shuffle(edges)
    got = components.connected(spark.createDataFrame(edges, "u long, v long")).collect()
    label = {}
    for u, v in edges:
        label.setdefault(u, u), label.setdefault(v, v)
    for _ in label:
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    touched = {x for u, v in edges if u != v for x in (u, v)}
    assert {r.node: r.label for r in got} == {x: label[x] for x in touched}
    assert len(got) == len(touched)


# --- packing ---


@pytest.mark.parametrize("partitions", [1, 7])
def test_sequences_hold_all_ids_and_pad(spark, docs, partitions):
    path, folder = public_tokenizers.path("word_bpe_49k.json"), shared_dir(spark, "sequences")
    written = packing.write_sequences(
        docs.repartition(partitions), path, at_blanks, 2, folder, window=64
    )
    rows = written.orderBy("sequence_id").collect()
    encode = brute.ids_of("word_bpe_49k.json")
    texts = {d: encode(t) for d, t in docs.collect()}
    total = sum(len(encode(t)) for _, t in docs.collect())
    assert [r.sequence_id for r in rows] == list(range(len(rows)))
    assert sum(r.length for r in rows) == total
    assert all(r.length == 64 for r in rows[:-1])
    for r in rows:
        full = r.length if r.length & (r.length - 1) == 0 else 64
        assert len(r.ids) == 4 * full and not any(r.ids[4 * r.length :])
        assert [p.offset for p in r.pieces] == [sum(q.length for q in r.pieces[:i]) for i in range(len(r.pieces))]
        assert sum(p.length for p in r.pieces) == r.length
    seen = Counter()
    for piece in packing.boundaries(written).collect():
        ids = np.frombuffer(piece.ids, "<u4").tolist()
        seen[piece.doc_id] += len(ids)
        if piece.doc_id is not None and piece.doc_id != 206:  # ids that stand once
            assert ids == texts[piece.doc_id][piece.start : piece.start + piece.length]
    assert seen.total() == total


# --- line dedup ---


def streamed(rows, cuts, min_docs, keep_first):
    """Dropped lines when sorted rows are cut into partitions and these into batches."""
    out = []
    for part in np.split(rows, cuts, axis=1):
        runs = line_dedup._Runs(min_docs, keep_first)
        for batch in np.array_split(part, 3, axis=1):
            out += list(runs.add(batch))
        out += list(runs.end())
    out = [x for x in out if x.shape[1]]
    table = np.concatenate(out, axis=1).T.tolist() if out else []
    often = Counter()
    for kind, h1, h2, *_, n in table:
        if kind == line_dedup.EDGE:
            often[h1, h2] += n
    dropped = [tuple(r[3:6]) for r in table if r[0] == line_dedup.DROP]
    pending = defaultdict(list)
    for kind, h1, h2, d, t, pos, _ in table:
        if kind == line_dedup.PENDING and often[h1, h2] >= min_docs:
            pending[h1, h2].append((d, t, pos))
    for own in pending.values():
        dropped += sorted(own)[1:] if keep_first else own
    return sorted(dropped)


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_runs_do_not_depend_on_partitions(data):
    line = st.tuples(*(st.integers(0, k) for k in (2, 1, 4, 1, 3)))
    rows = np.array(sorted(data.draw(st.sets(line, max_size=60))), dtype=np.int64).reshape(-1, 5).T
    min_docs, keep_first = data.draw(st.integers(1, 5)), data.draw(st.booleans())
    # A document's lines with one hash share a partition.
    ends = [i for i in range(1, rows.shape[1]) if (rows[:4, i] != rows[:4, i - 1]).any()]
    cuts = sorted(data.draw(st.sets(st.sampled_from(ends), max_size=4))) if ends else []
    groups = defaultdict(list)
    for h1, h2, d, t, pos in rows.T.tolist():
        groups[h1, h2].append((d, t, pos))
    want = []
    for own in groups.values():
        if len({x[:2] for x in own}) >= min_docs:
            want += sorted(own)[1:] if keep_first else own
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(line_dedup, "HELD_LINES", data.draw(st.sampled_from([0, 1, 5, 100_000])))
        assert streamed(rows, cuts, min_docs, keep_first) == sorted(want)


def test_one_line_said_millions_of_times_is_not_held():
    """Time in proportion and bounded memory: a document of equal lines, in batches."""

    def stream(n):
        runs, most = line_dedup._Runs(10, False), 0
        start = time.monotonic()
        for first in range(0, n, 10_000):
            batch = np.zeros((5, 10_000), dtype=np.int64)
            batch[4] = np.arange(first, first + 10_000)
            list(runs.add(batch))
            most = max(most, 0 if runs.held is None else runs.held.shape[1])
        list(runs.end())
        return time.monotonic() - start, most

    stream(1_000_000)
    short, held = stream(2_000_000)
    long, most = stream(20_000_000)
    assert most == held <= line_dedup.HELD_LINES + 10_000
    assert long < 30 * max(short, 0.02)


def test_first_occurrences_stay(spark, docs):
    kept = line_dedup.dedup_lines(docs, min_docs=2, min_chars=5, keep_first=True)
    lines = Counter()
    for text in {(r.row.doc_id, r.kept.text) for r in kept.collect()}:
        lines.update(x for x in map(brute.line_key, (text[1] or "").split("\n")) if len(x) >= 5)
    before = Counter()
    for text in {tuple(r) for r in docs.collect()}:
        before.update({x for x in map(brute.line_key, (text[1] or "").split("\n")) if len(x) >= 5})
    assert all(lines[k] == 1 for k, n in before.items() if n >= 2)
    assert all(lines[k] >= 1 for k in before)


# --- decontamination ---


def test_blocks_give_one_blocks_answer(spark, odd):
    docs = spark.createDataFrame(odd[1], DOCS).repartition(4)
    items = spark.createDataFrame(odd[2], "item_id long, text string")
    shape = lambda df: Counter(
        (r.doc_id, r.n_words, tuple(r.hit), tuple(r["items"])) for r in df.collect()
    )
    whole = decontaminate.find(docs, items)
    split = decontaminate.find(docs, items, block_bytes=200)
    assert shape(whole) == shape(split)


def test_item_ids_of_text(spark):
    docs = spark.createDataFrame([(1, "so one two three it is"), (2, "four")], DOCS)
    items = spark.createDataFrame(
        [("a1", "one two three"), ("b", "two three it"), (None, "four")], "item_id string, text string"
    )
    for block_bytes in (1 << 20, 5):
        found = decontaminate.find(docs, items, size=3, block_bytes=block_bytes)
        assert [(r.doc_id, r["items"]) for r in found.orderBy("doc_id").collect()] == [(1, ["a1", "b"]), (2, [])]


def test_copies_of_an_item_fill_no_block(spark):
    items = [(7, "one two three")] * 500 + [(i, f"word{i} more") for i in range(20)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    blocks = list(decontaminate._blocks(benchmark, 100))
    assert sorted(item for block in blocks for item in block) == sorted(set(items))
    assert len(blocks) == 3


def test_spans_or_documents_go(spark):
    docs = spark.createDataFrame(
        [(1, "Keep, one TWO-three é four! end", "x"), (2, "one two three", "y"), (3, None, "z")],
        "doc_id long, text string, hit string",
    )
    items = spark.createDataFrame([(7, "One two; three é four")], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.remove(docs, items, 4).orderBy("doc_id").collect()] == [2, 3]
    cut = decontaminate.remove(docs, items, 4, spans=True).orderBy("doc_id")
    assert cut.columns == docs.columns
    assert [r.text for r in cut.collect()] == ["Keep, ! end", "one two three", None]


# --- personal data ---


def test_contexts_discover_identifiers(spark, docs):
    rows = {r.doc_id: r for r in personal.scan(docs).collect()}
    names = lambda d: [(personal.KINDS[s.ord], s.start) for s in rows[d].discovered]
    text = dict(docs.collect())[340]
    assert names(340) == [
        ("context_email", text.index("user12345")), ("context_phone", text.index("0155501099"))
    ]
    assert names(341) == []


def test_contexts_are_followed_to_the_end(spark):
    # Past the first hop, seeds are too few for support without the instances of the hop before.
    hops = 5
    texts = [f"before hop0 seed{i}@mail.example.com" for i in range(6)]
    texts += [f"before hop{k} seed{i}at{k}@ex.org" for k in range(1, hops) for i in range(2)]
    for k in range(hops):
        for i in range(3):
            texts += [f"before hop{k} id{k}x{i}12345", f"before hop{k + 1} id{k}x{i}12345"]
    rows = personal.scan(spark.createDataFrame(list(enumerate(texts)), DOCS), confidence=0.5)
    found = {r.doc_id for r in rows.collect() if r.discovered}
    unseen = {i for i, text in enumerate(texts) if "@" not in text}
    assert found == unseen


# --- quality ---


def test_forest_sets_the_odd_rows_apart():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(2000, 7))
    odd = rng.normal(loc=6, size=(20, 7))
    forest = quality.Forest(rows, 50, 256, 1)
    usual = quality.anomaly_scores(forest.trees, forest.sample, rows)
    strange = quality.anomaly_scores(forest.trees, forest.sample, odd)
    assert strange.min() > np.quantile(usual, 0.99)


def test_threshold_spares_the_good_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    learn, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    judged = quality.judge(docs, learn).select("doc_id", "base_failed", "kept")
    good = held.filter("quality = 1 AND toxic = 0").join(judged, "doc_id").filter("NOT base_failed")
    assert good.agg(F.avg(F.col("kept").cast("int"))).head()[0] > 0.97
    bad = held.filter("quality = 0").join(judged, "doc_id")
    assert bad.agg(F.avg(F.col("kept").cast("int"))).head()[0] < 0.6
    none = quality.judge(docs, labels.limit(0))
    assert none.filter("kept = base_failed").isEmpty()


def test_most_bad_rows_that_pass_the_base_rules_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    learn, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    judged = quality.judge(docs, learn).filter("NOT base_failed").select("doc_id", "kept")
    shares = held.join(judged, "doc_id").agg(
        F.expr("avg(int(NOT kept)) FILTER (WHERE quality = 0)").alias("bad"),
        F.expr("avg(int(NOT kept)) FILTER (WHERE quality = 1 AND toxic = 0)").alias("good"),
    ).head()
    assert shares.bad > 0.5 and shares.good < 0.01, shares
