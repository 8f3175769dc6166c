"""Neighbour search over several blocks of either kind equals brute force."""

import numpy as np
from pyspark.sql import functions as F

from terracell.llm import ann


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "STRIPS", 5)
    monkeypatch.setattr(ann, "TILE", 16)
    monkeypatch.setattr(ann, "QUERY_TILE", 3)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    x = np.random.default_rng(1).standard_normal((300, 8)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {(r.query_id, r["rank"]): r.vec_id for r in ann.search(rows, F.col("vec_id") % 20 == 0, k=5).collect()}
    s = x.astype(np.float64) @ x.astype(np.float64).T
    np.fill_diagonal(s, -np.inf)
    assert got == {(q, k + 1): int(c) for q in range(0, 300, 20) for k, c in enumerate(np.argsort(-s[q])[:5])}


def test_lists_grow_with_the_queries_alone(spark):
    """A block's heaps leave a strip once, however many tiles the strip has."""
    import pyarrow as pa

    x = np.random.default_rng(2).standard_normal((9000, 4))
    rows = pa.RecordBatch.from_pydict({"cell": np.zeros(9000, np.int32), "dim": np.full(9000, 4, np.int32), "asks": np.arange(9000) < 10, "vec_id": np.arange(9000), "embedding": x.tolist()})
    out = list(ann.meet_in_order(iter(rows.slice(a, 700) for a in range(0, 9000, 700)), 3))
    assert [b.num_rows for b in out] == [30]
    got = {(q, v) for b in out for q, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
    s = x[:10] @ x[10:].T
    assert got == {(q, int(c) + 10) for q in range(10) for c in np.argsort(-s[q])[:3]}
