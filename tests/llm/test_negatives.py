"""Hard negatives against brute force: ties, odd rows, many blocks, groups and lanes, pruned blocks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelake.llm import negatives

COLUMNS = "vec_id long, label int, embedding array<double>, block int, anchor string, score int"


def brute(rows, positives=5, negatives_=5, scale=256):
    """Every anchor against every row."""
    kept = []
    for vec_id, label, vector, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, label, tuple(math.floor(scale * x) for x in vector)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a_id, a_label, a in sorted({r for r in kept if r[0] % 10 == 0}):
        own = sorted((-dot(a, v), i) for i, lab, v in kept if lab == a_label and i != a_id)[:positives]
        for s, i in own:
            window = sorted((-dot(a, v), j) for j, lab, v in kept if lab != a_label and 80 * -s <= 100 * dot(a, v) <= 100 * -s)
            out += [(a_id, i, rank + 1, j, -s, -t) for rank, (t, j) in enumerate(window[:negatives_])]
    return sorted(out)


def mined(spark, rows, **settings):
    df = spark.createDataFrame([tuple(r) + (1, "x", 2) for r in rows], COLUMNS)
    found = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"), **settings)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def clustered(n, seed, labels=4, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    label = rng.integers(0, labels, n)
    x = centres[rng.integers(0, labels, n)] * 0.4 + rng.normal(size=(n, width)) * 0.1
    return [(i, int(k), [float(c) for c in v]) for i, (k, v) in enumerate(zip(label, x))]


@pytest.mark.parametrize("settings", [{}, {"block": 16, "group": 7, "lane": 40}])
def test_every_row_counts(spark, settings):
    rows = clustered(300, 1)
    rows += [(i + 1000, k, v) for i, k, v in rows[:60]]                        # equal vectors: ties by id
    rows += [(2000 + i, 1, [0.5] * 6) for i in range(90)]                      # one very common vector
    rows += rows[:25]                                                          # repeated rows
    assert mined(spark, rows, **settings) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, 1, [0.5, 0.5]), (1, 1, [0.5]), (2, 2, [0.4, 0.4, 9.0]), (3, 2, None), (4, None, [1.0, 1.0]), (None, 2, [1.0, 1.0]),
            (5, 2, [1.0, None]), (6, 2, [float("nan"), 1.0]), (7, 2, [float("inf"), 1.0]), (8, 2, []), (10, 1, [-0.5, 0.1]),
            (20, 2, [0.0, 0.0]), (30, 9, [1.0, 1.0]), (40, 1, [300.0, 200.0]), (9, 2, [0.3, 0.1])]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == [] and mined(spark, [(None, None, None)]) == [] and mined(spark, rows[1:3]) == []


def test_blocks_are_left_out(spark, monkeypatch):
    """Where labels lie apart, an anchor's blocks are few, and the result stays whole."""
    rng = np.random.default_rng(3)
    centre = np.eye(8) * 2
    rows = [(i, i % 5, [float(x) for x in centre[(i // 5) % 8] + rng.normal(size=8) * 0.05]) for i in range(2000)]
    made = {}
    kept = negatives.stage
    monkeypatch.setattr(negatives, "stage", lambda df, name: made.setdefault(name + str(len(made)), kept(df, name)))
    found = mined(spark, rows, block=32, group=20)
    needed = [made[k] for k in made if k.startswith("needed")]
    zones = next(made[k] for k in made if k.startswith("zones")).count()
    groups = needed[0].agg(F.count_distinct("group")).first()[0]
    assert groups == 10
    for table in needed:
        assert table.count() < 0.6 * zones * groups, (table.count(), zones, groups)
    assert found == brute(rows)


def test_curve_steps_by_one():
    """Neighbours along the curve are neighbours in space, and every cell is met once."""
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    place = negatives.hilbert(cells, 3)
    assert sorted(place) == list(range(512))
    walked = cells[np.argsort(place)]
    assert (np.abs(np.diff(walked, axis=0)).sum(1) == 1).all()
