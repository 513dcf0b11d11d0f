"""Exact top-k search against brute force."""

import math
import random

import numpy as np
import pytest

from txrisk.llm import topk
from txrisk.llm.common import prepare

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def brute(rows, every=50, k=5):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, u) in enumerate(good):
        if q is None or q % every:
            continue
        near = [(-min(sum(x * y for x, y in zip(u, v, strict=True)), 2**63 - 1), c is None, c or 0, c)
                for b, (c, v) in enumerate(good) if b != a and len(u) == len(v)]
        out += [(q, r, c, -s) for r, (s, _, _, c) in enumerate(sorted(near)[:k], 1)]
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s", "r") for i, v in rows], SCHEMA).repartition(4)


def check(spark, rows, **sizes):
    df = frame(spark, rows)
    got = topk.search(df.where("vec_id % 50 = 0"), df, **sizes).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_odd_rows_and_ties(spark):
    prepare(spark)
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(8)]) for i in range(300)]
    rows += [(400 + i, [0.5] * 8) for i in range(200)]                       # one vector many times: ties by id
    rows += [(50, [0.1] * 8), (100, rows[100][1]), (None, [0.9] * 8), (None, [0.5] * 8)]   # repeated and null ids
    rows += [(700, None), (750, [None] * 8), (800, [float("nan")] * 8), (850, [float("inf")] * 8), (900, [0.0] * 8),
             (950, []), (951, []), (1000, [0.2] * 3), (1050, [1e30] * 3), (1051, [2.0] * 3), (-50, [-1.0] * 8)]
    check(spark, rows)
    check(spark, rows, bucket_values=256, block_values=32)
    assert topk.digest(frame(spark, rows).limit(0)).collect() == []
    check(spark, [(0, [0.5])])


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_pruning_keeps_the_answer(spark, spread):
    """Clusters of close vectors (coordinates prune) and spread lengths (lengths prune)."""
    prepare(spark)
    r = np.random.default_rng(7)
    centres = r.normal(size=(30, 16))
    rows = []
    for i in range(1500):
        v = centres[i % 30] + r.normal(size=16) * 0.02
        rows.append((i, (v / np.linalg.norm(v) * np.exp(spread * r.normal())).tolist()))
    check(spark, rows, bucket_values=16 * 200, block_values=16 * 10)


def test_both_prunings_are_used():
    r = np.random.default_rng(3)
    centres = r.normal(size=(200, 16))
    values = np.floor(256 * (centres[r.integers(0, 200, 4000)] + r.normal(size=(4000, 16)) * 0.01))
    values = values[np.argsort(-np.sqrt((values**2).sum(1)), kind="stable")]
    import pyarrow as pa
    bucket = topk.Bucket(pa.array(np.arange(4000)), values)
    unit = values[5] / np.linalg.norm(values[5])
    rows = bucket.within(unit, 0.98)
    cosines = bucket.unit() @ unit
    assert rows is not None and len(rows) < 400 and set(np.flatnonzero(cosines >= 0.98)) <= set(rows)
    assert bucket.within(unit, -1.0) is None
