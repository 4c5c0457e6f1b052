"""Hard negatives against a plain scan."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.llm import hard_negatives as hn


def vectors(seed: int, n: int, dims: int, groups: int, big: float = 1.0):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(groups)]
    rows = []
    for k in range(n):
        g = rng.randrange(groups)
        rows.append((k, rng.randrange(3), [big * (x + rng.gauss(0, 0.4)) for x in base[g]]))
    same = rows[1][2]
    rows += [(n + k, rng.randrange(3), list(same)) for k in range(n // 3)]  # one vector held by many rows
    rows += [(5, 1, rows[5][2]), (10, 0, rows[10][2]), (10, 0, rows[10][2])]  # repeated ids
    rows += [(None, 1, rows[2][2]), (n + 900, None, rows[2][2]), (n + 901, 1, None), (n + 902, 1, [1.0, None]), (n + 903, 1, [math.nan]), (n + 904, 2, [math.inf, 0.0])]
    rows += [(n + 910, 1, []), (n + 911, 2, [0.0] * dims), (n + 912, 0, [3.0 * big]), (-10, 2, rows[4][2])]
    rng.shuffle(rows)
    return rows


def scan(rows, every, k, low=80, high=100):
    ok = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    top = 2**63 - 1
    dot = lambda a, b: max(-top, min(top, sum(x * y for x, y in zip(a, b))))
    key = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for p, (i, label, v) in enumerate(ok):
        if i is None or i % every:
            continue
        scored = [(dot(v, w), j, other) for q, (j, other, w) in enumerate(ok) if q != p]
        near = sorted((t for t in scored if t[2] == label), key=key)[:k]
        far = sorted((t for t in scored if t[2] != label), key=key)
        for s, j, _ in near:
            fit = [t for t in far if low * s <= 100 * t[0] <= high * s][:k]
            out += [(i, j, r + 1, t[1], s, t[0]) for r, t in enumerate(fit)]
    return sorted(out, key=repr)


def mined(spark, rows, every, **more):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for c in ("uid", "v", "query", "cluster", "rank"):
        df = df.withColumn(c, F.lit("own"))
    return sorted((tuple(r) for r in hn.mine(df.repartition(3), F.col("vec_id") % every == 0, **more).collect()), key=repr)


@pytest.mark.parametrize(
    ("seed", "dims", "big", "more"),
    [
        (1, 8, 0.1, {}),
        (2, 3, 1.0, {"block": 7, "cluster_size": 3, "shard_rows": 50, "fit_rows": 9}),
        (3, 5, 1e7, {"cluster_size": 2, "shard_rows": 40}),  # sums beyond 2**53: integers
        (4, 4, 1e12, {}),  # beyond 64 bits
    ],
)
def test_equals_plain_scan(spark, seed, dims, big, more):
    rows = vectors(seed, 150, dims, 4, big)
    got = mined(spark, rows, 10, **more)
    assert got and got == scan(rows, 10, 5)


def test_fewer_than_asked(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.9, 0.0]), (3, 3, [-1.0, 0.0])]
    assert mined(spark, rows, 100) == scan(rows, 100, 5) == [(0, 1, 1, 2, 65536, 58880)]
    assert mined(spark, rows[:2], 100) == [] and mined(spark, [], 100) == [] and mined(spark, rows[1:], 100) == []


def test_walk_ends_early_and_exact():
    """Anchors in tight clusters: lists end long before the last candidate, with the full scan's rows."""
    rng = np.random.default_rng(0)
    base = rng.normal(size=(20, 16))
    x = np.floor(256 * (base[rng.integers(0, 20, 6000)] + 0.05 * rng.normal(size=(6000, 16))))
    import pyarrow as pa

    rows = pa.table({"uid": np.arange(40), "vec_id": np.arange(40), "label": np.zeros(40, np.int64), "v": pa.array((x[:40] / 256).tolist()), "cluster": np.arange(40) % 20})
    block = hn.Anchors(rows, 256.0)
    seen = []
    plain = hn.dots
    try:
        hn.dots = lambda a, b: seen.append(len(a) * len(b)) or plain(a, b)
        q, c, s = block.search(np.arange(6000), np.arange(6000), np.zeros(6000, np.int64), x, 5, True)
    finally:
        hn.dots = plain
    full = plain(x[:40], x)
    for i in range(40):
        others = [j for j in np.lexsort((np.arange(6000), -full[i])) if j != i][:5]
        assert sorted(c[q == i]) == sorted(others) and sorted(s[q == i]) == sorted(full[i][others])
    assert sum(seen) < 40 * 6000 / 3
