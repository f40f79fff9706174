"""Hard negatives against brute force, with ties, repeated rows, odd vectors and blocks of a few rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from halfstar.llm import hard_negatives, queries

SMALL = "/root/testdata/sf0.001"


def brute(rows, positives=5, negatives=10):
    """Rows of (vec_id, vector, label) as the contract words it."""
    good = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for n, (anchor, label, v) in enumerate(good):
        if anchor is None or anchor % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), math.inf if i is None else i, i, other) for m, (i, other, w) in enumerate(good) if m != n and len(w) == len(v)]
        scored.sort(key=lambda r: r[:2])
        for p, _, positive, _ in [r for r in scored if r[3] == label][:positives]:
            found = [r for r in scored if r[3] != label and 30 * -p <= 100 * -r[0] <= 90 * -p][:negatives]
            out += [(anchor, positive, k + 1, r[2], -p, -r[0]) for k, r in enumerate(found)]
    return sorted(out, key=repr)


def mined(spark, rows):
    table = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<double>, label int, row string, score long").repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    result = hard_negatives.hard_negatives(hard_negatives.quantised(table, 256.0, label), F.col("vec_id") % 100 == 0)
    return sorted(map(tuple, result.collect()), key=repr)


def odd_rows(n=400, dims=6, seed=2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(8)]
    rows = [(i, [c + rng.gauss(0, 0.4) for c in rng.choice(centres)], rng.randrange(3)) for i in range(n)]
    rows += [(n + i, rows[5][1], rng.randrange(3)) for i in range(60)]  # one very common vector
    rows += [rows[100], rows[100], rows[7], (100, rows[9][1], 1)]  # repeated rows, anchors among them, and another row of one id
    rows += [(None, rows[3][1], 1), (None, rows[3][1], None), (1000, None, 1), (1001, [1.0, None] + [0.0] * 4, 1), (1002, [math.nan] * dims, 1), (1003, [math.inf] * dims, 2), (1100, [0.0] * dims, 1), (1200, [], 1), (1201, [], 2), (1300, [1.0, 2.0], 0), (1301, [1.0, 2.0], 0), (1302, [0.5, 0.9], 1), (1400, [-1.0] * dims, 0)]
    return rows


def test_equals_brute_force_in_small_blocks(spark, monkeypatch):
    rows = odd_rows()
    want = brute(rows)
    assert len(want) > 150 and any(r[3] is None for r in brute([(100, [1.0], 0), (101, [1.0], 0), (None, [0.5], 1)]))
    monkeypatch.setattr(hard_negatives, "DEPTH", 1)
    monkeypatch.setattr(hard_negatives, "BLOCK", 37)
    assert mined(spark, rows) == want
    monkeypatch.setattr(hard_negatives, "SLICE_ANCHORS", 3)
    assert mined(spark, rows) == want


def test_nulls_and_empty_tables(spark):
    assert mined(spark, [(100, [1.0], 0), (101, [1.0], 0), (None, [0.5], 1)]) == [(100, 101, 1, None, 65536, 32768)]
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []
    assert mined(spark, [(None, None, None)]) == []
    huge = [(100, [1e8, 1.0], 0), (101, [2e5, 1.0], 0), (102, [1e5, 3.0], 1), (103, [1e5, 3.0], 1)]
    assert mined(spark, huge) == brute(huge) != []


def test_reading_stops_before_the_end():
    """Where few rows stand out, the threshold falls below the kth score early, and the rest is never scored."""
    rng = np.random.default_rng(1)
    vectors = rng.integers(-20, 20, (5000, 8))
    vectors[:30] = 200
    block = hard_negatives.Block(vectors, np.zeros(5000, dtype=np.int64), np.arange(5000), np.arange(5000))
    seen = []
    windows = hard_negatives.Windows([np.full(8, 3)], [1], [-1], np.array([0, 1]), [-(10**9)], [10**9], False, 10)
    scan = block.scan
    block.scan = lambda anchor: (seen.append(len(r)) or (r, s, t) for r, s, t in scan(anchor))
    best = hard_negatives.Best(1, 10)
    hard_negatives.search_block(block, windows, best)
    assert best.rows[0].tolist() == list(range(10)) and sum(seen) < 500


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_query_equals_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    result = queries.QUERIES["op13_hard_negatives"](spark, f"/root/testdata/{sf}")
    assert result.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    got = sorted(map(tuple, result.collect()), key=repr)
    assert got == brute(rows) and got
