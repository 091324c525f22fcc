"""The stages of the pipeline against plain Python, and hard rows through all of them."""

from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from marquee.session import materialise
from tests.llm import brute
from tests.llm.test_texts import check_packing

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        after = materialise(stage(spark, docs, SF_DIR), "test")
        out.append((docs, after))
        docs = after
    return out


def test_all_but_the_last_return_documents(stages):
    for docs, after in stages[:-1]:
        assert after.schema.simpleString() == docs.schema.simpleString()


def test_quality_stage(spark, stages):
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[0][1].collect()}
    shares = Counter((labels[r.doc_id], r.doc_id in kept) for r in stages[0][0].collect() if r.doc_id in labels)
    assert shares[(1, 0), True] >= 0.95 * (shares[(1, 0), True] + shares[(1, 0), False])
    assert shares[(0, 0), False] >= 0.9 * (shares[(0, 0), True] + shares[(0, 0), False])


def test_exact_stage(stages):
    best = defaultdict(lambda: -1)
    for r in stages[1][0].collect():
        key = brute.ascii_lower(r.text)
        best[key] = max(best[key], r.doc_id)
    assert sorted(r.doc_id for r in stages[1][1].collect()) == sorted(best.values())


def test_near_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages[2][0].collect()]
    fps = np.array([brute.fingerprint(text) for _, text in rows], np.uint64)
    close = np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4, 1))
    least = defaultdict(lambda: 1 << 60)
    for at, root in enumerate(brute.components(len(rows), close.tolist())):
        least[root] = min(least[root], rows[at][0])
    assert len(least) < len(rows)
    assert sorted(r.doc_id for r in stages[2][1].collect()) == sorted(least.values())


def test_secret_stage(stages):
    texts = "\n".join(r.text for r in stages[3][1].collect())
    assert "token = \"" not in texts.lower() and "[SECRET]" in texts
    assert all(r.n_chars == len(r.text) for r in stages[3][1].collect())
    assert stages[3][0].count() == stages[3][1].count()


def test_packing_stage(stages):
    docs, packed = stages[4]
    used, least = check_packing(packed.collect(), [(r.doc_id, r.text) for r in docs.collect()], 2, 1024)
    assert used <= least * 1.01 + 1


def test_hard_rows_pass_all_stages(spark):
    docs = brute.hard_docs(spark)
    before = brute.hard_rows()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, brute.SF_DIR), "hard")
        after = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "secret scans":
            assert len(after) == len(before)
        else:
            assert 0 < len(after) <= len(before) and set(after) <= set(before)
        before = after
    packed = corpus_pipeline.pack(spark, docs, brute.SF_DIR).collect()
    check_packing(packed, before, 2, 1024)
    empty = brute.hard_docs(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = materialise(stage(spark, empty, brute.SF_DIR), "none")
        assert empty.count() == 0


def test_run(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    rows = corpus_pipeline.run(spark, brute.SF_DIR)
    # Stages go once the next is written; what the result reads is all that is left.
    assert len(set(shared.iterdir()) - before) == 1
    assert rows.count() > 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns)
