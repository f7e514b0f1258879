import math
import random

import numpy as np
from pyspark.sql import functions as F

from seatloom.llm import topk


def brute(rows, every, k):
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in good]
    out = []
    for a, (i, v) in enumerate(whole):
        if i % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(whole) if a != b)[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def check(spark, rows, every=10, k=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).withColumn("score", F.lit("clash")).withColumn("sheet", F.lit(1))
    got = topk.top_k(frame, F.col("vec_id") % every == 0, k).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, every, k)


def test_against_brute_force(spark, monkeypatch):
    r = random.Random(4)
    monkeypatch.setattr(topk, "SHEET", 100)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(500)]
    rows += [(1000 + i, [r.choice([-1.0, 0.0, 1.0]) for _ in range(6)]) for i in range(300)]  # many ties
    rows += [(-20, [0.5] * 6), (2000, None), (2010, [1.0, None]), (2020, [float("nan")] * 6), (2030, [float("inf")] * 6), (2040, []), (2050, [3.0]), (2060, [1.0] * 9), (None, [1.0] * 6)]
    rows += [rows[3], rows[10], (10, [9.0] * 6), (2070, [1e6] * 6), (2080, [2e4] * 6)]
    check(spark, rows)


def test_small_tables(spark):
    check(spark, [])
    check(spark, [(0, [1.0, 2.0])])
    check(spark, [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (10, [0.1, -0.1])])
    check(spark, [(1, [1.0])])


def test_many_equal_rows(spark, monkeypatch):
    """A third of all rows under one vec_id and vector; each row is a query and a candidate of its own."""
    monkeypatch.setattr(topk, "SHEET", 64)
    monkeypatch.setattr(topk, "BUCKET", 2)
    r = random.Random(2)
    rows = [(50, [0.25, 0.5, -1.0])] * 120 + [(i, [r.gauss(0, 1) for _ in range(3)]) for i in range(240)]
    check(spark, rows)


def test_blocks_are_skipped(spark, monkeypatch):
    """Where vectors stand in clusters, most blocks fall below the kth score; on an even sphere none can."""
    monkeypatch.setattr(topk, "SHEET", 256)
    r = np.random.default_rng(0)
    centres = r.normal(0, 1, (40, 24))
    near = centres[r.integers(0, 40, 3000)] + r.normal(0, 0.05, (3000, 24))
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(near.astype(np.float32))]
    check(spark, rows, 50)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = topk.pruning(frame, F.col("vec_id") % 50 == 0).first()
    assert got.pairs > 60 * 40 and got.scored < 0.3 * got.pairs
    even = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = topk.pruning(even, F.col("vec_id") % 50 == 0).first()
    assert 0 < got.scored <= got.pairs


def test_search_stops_early():
    r = np.random.default_rng(0)
    matrix = np.floor(r.normal(0, 20, (640, 16)))
    matrix[:64] += 300
    index = topk.BlockIndex(matrix, np.arange(640), 5000 + np.arange(640))
    ids, best, scored = index.search(np.ones((1, 16)), np.array([-1]), np.array([-np.inf]), 5)
    assert scored == 1 and best[0].tolist() == sorted(matrix.sum(1), reverse=True)[:5] and (ids < 64).all()
