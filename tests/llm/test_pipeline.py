"""The pipeline stage by stage against plain versions, and as a whole."""

from collections import defaultdict

import brute
import pytest

import corpus_pipeline
from test_queries import check_packing


@pytest.mark.parametrize("which", ["odd", "supplied"])
def test_stages(spark, odd, which, tmp_path):
    folder = odd[0] if which == "odd" else "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, benchmark = docs.columns, spark.read.parquet(f"{folder}/benchmark.parquet")
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        out = stage(spark, docs, folder)
        if k == 4:
            check_packing(out.collect(), before)
            break
        assert out.columns == columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        order = lambda rows: sorted(rows, key=lambda r: brute.nulls_first(*r))
        if k == 0:
            failed = [b[-1] for b in brute.op10_base(before)]
            sound = [d for d, f in zip(before, failed) if not f]
            assert set(after) <= set(sound) and len(after) > 0.9 * len(sound)
        if k == 1:
            often = brute.frequent_lines(before)
            want = [
                (d, "\n".join(brute.without(t, often)[1]) if t is not None else None)
                for d, t in before
            ]
            assert order(after) == order(want)
        if k == 2:
            roots = brute.components([brute.fingerprint(t) for _, t in before])
            groups = defaultdict(list)
            for doc, root in zip(before, roots):
                groups[root].append(doc)
            assert len(after) == len(groups)
            least = [min((d for d, _ in g if d is not None), default=None) for g in groups.values()]
            assert sorted(map(str, least)) == sorted(str(d) for d, _ in after)
            assert set(after) <= set(before)
        if k == 3:
            clean = [not r[-1] for r in brute.op8(before, items)]
            assert order(after) == order([d for d, c in zip(before, clean) if c])


def test_run_gives_pieces(spark, odd):
    rows = corpus_pipeline.run(spark, odd[0])
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows.columns)
    assert rows.count() > 0
