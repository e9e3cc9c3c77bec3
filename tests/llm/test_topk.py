import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from findery.llm import topk
from tests.compare import same


def test_query(spark):
    same(topk.op8_exact_topk(spark, "/root/testdata/sf0.01"), topk.ORACLE_SQL, "/root/testdata/sf0.01")


def brute(rows, asked, k=5, scale=256, kind=np.float32):
    vectors = []
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all():
            vectors.append((i, [int(np.floor(scale * float(kind(x)))) for x in v]))
    out = []
    for q in sorted({i for i, _ in vectors} & asked):
        own = min((np.array(v, "<i4" if max(map(abs, v), default=0) < 2**31 else "<f8").tobytes(), v) for i, v in vectors if i == q)[1]
        scores = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), i) for i, v in vectors if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_hard_rows(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "SEEDS", 7)
    monkeypatch.setattr(topk, "STEP", 8)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, rng.uniform(-3, 3)]) for _ in range(6)]) for i in range(120)]
    rows += [(200, None), (None, [1.0] * 6), (201, [None] * 6), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (204, []), (205, [1.0, 2.0]), (100, rows[3][1]), rows[7], (206, rows[8][1]), (207, [0.0] * 6), (208, [1e6, -1e6, 3.25, 0.0, 1.0, 2.0]), (209, [999999.0, -1e6, 0.5, 0.0, 0.0, 0.0]), (211, [2e6, 0.0, 0.0, 1.0, 0.0, 0.0]), (212, [-2e6, 3e6, 0.25, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, rank int, score int").repartition(4)
    asked = {i for i in range(210) if i % 10 == 0} | {205, 207}
    got = topk.search(df, df.filter(df.vec_id.isin(*asked)))
    assert sorted(map(tuple, got.collect())) == brute(rows, asked)


def test_few_and_no_rows(spark):
    shape = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], shape)
    assert [tuple(r) for r in topk.search(df, df.filter("vec_id = 0")).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.search(df.limit(0), df).count() == 0
    assert topk.search(df, df.limit(0)).count() == 0


@pytest.mark.parametrize("blocks", [1, 2, 8, 16])
def test_blocks_have_numbers_of_their_own(spark, blocks):
    rows = spark.range(64 * blocks).select(F.col("id").alias("vec_id"), F.lit(b"").alias("v"), F.lit(False).alias("wide"), F.rand(3).alias("norm"))
    dealt = topk._numbered(rows.repartitionByRange(blocks, F.desc("norm")), 32, False)
    assert len({r["block"] for r in dealt.coalesce(1).collect()}) == dealt.count()
    got = dealt.collect()
    assert len({r["block"] for r in got}) == len(got) >= 2 * blocks
    dealt = spark.createDataFrame([(r["block"],) for r in got], "block long").select(F.pmod(F.xxhash64("block"), F.lit(len(got))).alias("lane")).distinct().count()
    assert dealt > len(got) // 3


def test_more_query_blocks_than_tasks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(5)
    v = rng.standard_normal((600, 8))
    rows = [(i, [float(x) for x in r / np.linalg.norm(r)]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    asked = {i for i in range(600) if i % 3 == 0}  # 50 blocks for 16 tasks
    assert sorted(map(tuple, topk.search(df, df.filter("vec_id % 3 = 0")).collect())) == brute(rows, asked, kind=float)


def test_two_query_blocks_of_one_number_are_an_error():
    ids, cells = np.array([1], "<i8").tobytes(), [np.array([3, 4], "<i4").tobytes()]
    row = {"q": 0, "lane": 0, "side": 0, "top": 5.0, "ids": ids, "cells": cells, "wide": [False], "least": np.array([-np.inf]).tobytes()}
    with pytest.raises(RuntimeError, match="one number"):
        list(topk._unit(2, np.eye(2), 1.0, 5, 2)(iter([pa.RecordBatch.from_pylist([row, row])])))


def test_large_components(spark):
    shape = "vec_id long, embedding array<float>"
    three = [(0, [1.0, 0.0]), (1, [2000000.0, 0.0]), (2, [3.0, 0.0])]
    df = spark.createDataFrame(three, shape)
    assert [tuple(r) for r in topk.search(df, df.filter("vec_id = 0")).orderBy("rank").collect()] == [(0, 1, 1, 256 * 512000000), (0, 2, 2, 256 * 768)]
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, rng.uniform(-1, 1), rng.uniform(-1, 1) * 2.0 ** rng.randrange(0, 15)]) for _ in range(200)]) for i in range(60)]
    rows += [(100, [1e30] + [0.0] * 199), (101, [0.0, 0.0, 1e25] + [0.0] * 197)]
    rows = [(i, [0.0, 1.0, 0.0] + v[3:] if i < 100 else v) for i, v in rows]
    df = spark.createDataFrame(rows, shape)
    asked = {i for i in range(60) if i % 5 == 0}
    assert sorted(map(tuple, topk.search(df, df.filter(df.vec_id.isin(*asked))).collect())) == brute(rows, asked)
    wide = [(i, [float(rng.randrange(-(2**19), 2**19)) * 2 for _ in range(200)]) for i in range(30)]
    df = spark.createDataFrame(wide, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.search(df, df.filter("vec_id < 3")).collect())) == brute(wide, {0, 1, 2}, kind=float)


@pytest.mark.parametrize("sign", [1.0, -1.0])
def test_a_score_that_fits_no_long_is_an_error(spark, sign):
    df = spark.createDataFrame([(i, [1048575.0 * 256 * (sign if i else 1.0)] * 200) for i in range(3)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fits no long"):
        topk.search(df, df.filter("vec_id = 0")).collect()


def test_sums_near_the_ends_of_a_long():
    a, b = np.array([[2.0**62, -(2.0**62)], [2.0**31, 0.0], [-(2.0**62), 0.0], [2.0**62, 0.0], [3.0, 4.0]]), np.array([[1.0, -1.0], [2.0**31, 5.0], [2.0, 0.0], [-4.0, 0.0], [5.0, 6.0]])
    s, beyond = topk.scores(a, b)
    assert beyond.tolist() == [1, 0, 0, -1, 0] and s[[1, 2, 4]].tolist() == [2**62, -(2**63), 39]


def test_pruning_loses_nothing():
    rng = np.random.default_rng(3)
    p = (rng.integers(-300, 300, (500, 12)) * rng.integers(1, 4, (500, 1))).astype(np.float64)
    p = p[np.argsort(-(p**2).sum(1), kind="stable")]
    turn = np.linalg.eigh(p.T @ p)[1][:, ::-1]
    ids = rng.permutation(500).astype(np.int64)
    for unit in (1.0, 700.0):
        own = topk.Search(ids[:20], p[:20], np.full(20, -np.inf), turn, unit, leading=4)
        own.show(ids, p, 32)
        qi, who, score, _ = own.found
        full = (p[:20] @ p.T).astype(np.int64)
        for n in range(20):
            want = sorted((-full[n, j], ids[j]) for j in range(500) if ids[j] != ids[n])[:5]
            assert [(-s, i) for i, s in zip(who[qi == n], score[qi == n], strict=True)] == want
