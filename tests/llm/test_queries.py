"""Every registered query of marquee.llm against its plain version, on odd and supplied tables."""

from collections import Counter, defaultdict

import brute
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()
SF_DIR = "/root/testdata/sf0.001"


def rows_of(folder, name, *columns):
    return list(zip(*(pq.read_table(f"{folder}/{name}.parquet")[c].to_pylist() for c in columns)))


@pytest.fixture(scope="module", params=["odd", "supplied"])
def tables(request, odd):
    """folder, documents, benchmark, turns"""
    folder = odd[0] if request.param == "odd" else SF_DIR
    return (
        folder,
        rows_of(folder, "documents", "doc_id", "text"),
        rows_of(folder, "benchmark", "item_id", "text"),
        rows_of(folder, "conversations", "conv_id", "turn", "role", "text"),
    )


def result(spark, name, folder, *columns):
    query = next(k for k in QUERIES if k.startswith(name + "_"))
    return Counter(map(tuple, QUERIES[query](spark, folder).select(*columns).collect()))


def test_op1(spark, tables):
    found = result(spark, "op1", tables[0], "doc_id", "start", "n_tokens", "ids_crc32")
    assert found == Counter(brute.op1(tables[1]))


def test_op2(spark, tables):
    folder, docs, *_ = tables
    query = QUERIES["op2_hilbert_shards"](spark, folder)
    rows = query.collect()
    import zlib

    expected = Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs
    )
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    assert {r.law for r in rows} == {"rows"} and all(r.grown_shard is None for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r)
    counts = [len(slots[s]) for s in range(24)]
    assert set(slots) <= set(range(24)) and max(counts) - min(counts) <= 1
    key = lambda r: r.curve_position
    run = []
    for s in range(24):
        own = sorted(slots[s], key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        run += map(key, own)
    assert run == sorted(run)


def test_op3(spark, tables):
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    assert result(spark, "op3", tables[0], *columns) == Counter(brute.op3(tables[1]))


def test_op4(spark, tables):
    folder, _, _, turns = tables
    ok = "</s>[INST] ok [/INST]"
    turns = [*turns, (-1, 0, "user", ok), (-1, 1, "assistant", ok)]
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    assert result(spark, "op4", folder, *columns) == Counter(brute.op4(turns))


def test_op5(spark, tables):
    found = result(spark, "op5", tables[0], "doc_id", "fingerprint", "component_id")
    assert found == Counter(brute.op5(tables[1]))


def test_op6(spark, tables):
    folder, docs, *_ = tables
    rows = QUERIES["op6_packing"](spark, folder).collect()
    check_packing(rows, docs)


def check_packing(rows, docs):
    encode = brute.ids_of("word_bpe_49k.json")
    ids = [(d, encode(t)) for d, t in docs]
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.sequence_id].append(r)
    assert sorted(pieces) == list(range(len(pieces)))
    starts = []
    for s in sorted(pieces):
        at = 0
        for r in sorted(pieces[s], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
            starts.append(r)
        assert at == 4096 or s == len(pieces) - 1 and at <= 4096
    # Pieces in order make whole documents; each is one of the table's.
    left = Counter((d, len(x), brute.crc_of(x)) for d, x in ids)
    bodies = {(d, len(x), brute.crc_of(x)): x for d, x in ids}
    by_key = defaultdict(list)
    for key in left:
        by_key[key[0], key[1]].append(key)
    i = 0
    while i < len(starts):
        own = [starts[i]]
        while own[-1].start + own[-1].length < own[-1].doc_tokens:
            i += 1
            own.append(starts[i])
        i += 1
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        fits = [
            key
            for key in by_key[own[0].doc_id, own[0].doc_tokens]
            if left[key]
            and all(
                brute.crc_of(bodies[key][r.start : r.start + r.length]) == r.ids_crc32 for r in own
            )
        ]
        assert fits
        left[fits[0]] -= 1
    assert not any(left.values())


def test_op7(spark, tables):
    found = result(spark, "op7", tables[0], "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert found == Counter(brute.op7(tables[1]))


def test_op8(spark, tables):
    folder, docs, benchmark, _ = tables
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert result(spark, "op8", folder, *columns) == Counter(brute.op8(docs, benchmark))


def test_op9(spark, tables):
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    assert result(spark, "op9", tables[0], *columns) == Counter(brute.op9(tables[1]))


def test_op10(spark, tables):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = result(spark, "op10", tables[0], "doc_id", *columns)
    assert found == Counter(brute.op10_base(tables[1]))
    rows = QUERIES["op10_quality"](spark, tables[0]).collect()
    assert not any(r.kept for r in rows if r.base_failed)


def test_op11(spark, tables):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert result(spark, "op11", tables[0], *columns) == Counter(brute.op11(tables[1]))


def test_op12(spark, tables):
    # The plain version takes quadratic time: two texts of 60000 words are left to it elsewhere.
    docs = [r for r in tables[1] if len(r[1] or "") < 100_000]
    columns = [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256",
    ]
    found = result(spark, "op12", tables[0], *columns)
    assert not Counter(brute.op12(docs)) - found and found.total() == len(tables[1])


def test_op13(spark, tables):
    docs = rows_of(tables[0], "documents", "lang", "text")
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert result(spark, "op13", tables[0], *columns) == Counter(brute.op13(docs))


@pytest.mark.parametrize("name", [k for k in QUERIES if k.startswith("op") or k == "pipeline"])
def test_empty_tables(spark, empty, name):
    rows = QUERIES[name](spark, empty).collect()
    assert [r.conv_id for r in rows] == [-1] if name.startswith("op4") else not rows
