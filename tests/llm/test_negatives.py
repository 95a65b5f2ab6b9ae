"""Hard negatives against all pairs in Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
LAST = 1 << 62


def plain(rows):
    used = [(k, i, label, [int(np.floor(256 * x)) for x in v]) for k, (i, v, label) in enumerate(rows)
            if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for k, i, label, vector in used:
        if i is None or i % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, w)), LAST if j is None else j, n, j, other == label)
                        for n, j, other, w in used if n != k)
        for positive in [s for s in scored if s[4]][:5]:
            p = -positive[0]
            hard = [s for s in scored if not s[4] and 30 * p <= -100 * s[0] <= 90 * p][:10]
            out += [(i, positive[3], rank, s[3], p, -s[0]) for rank, s in enumerate(hard, 1)]
    return sorted(out, key=repr)


def made(n, lengths, seed):
    rng = np.random.default_rng(seed)
    size, rows = max(lengths), []
    base = rng.normal(size=(6, size))
    for i in range(n):
        v = base[rng.integers(6)] * rng.choice([0, 0.5, 1, 2]) + rng.normal(size=size) * rng.choice([0, 0.2, 1])
        rows.append((i, v[:rng.choice(lengths)].astype("f4").tolist(), int(rng.choice([0, 0, 0, 1, 2]))))
    return rows


def check(spark, rows):
    found = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0).collect()
    expected = plain(rows)
    assert sorted(map(tuple, found), key=repr) == expected
    return expected


@pytest.mark.parametrize("lengths", [[24], [40, 40, 39, 5, 0]])
def test_agrees_with_all_pairs(spark, lengths):
    assert check(spark, made(250, lengths, 1))


def test_many_cells(spark, monkeypatch):
    monkeypatch.setattr(negatives, "VALUES", 700)
    monkeypatch.setattr(negatives, "ANCHORS_SHARD", 9)
    assert check(spark, made(200, [16], 2))


def test_odd_rows(spark):
    rows = made(60, [8], 3)
    rows += [(100, None, 0), (110, [1.0, None], 0), (120, [float("nan")] * 8, 1), (130, [float("inf")] * 8, 1), (None, [1.0] * 8, 0),
             (140, [1.0] * 8, None), (150, [0.0] * 8, 1), (160, [], 1), (170, [-0.001] * 8, 2)]
    check(spark, rows + rows[:30] * 3)  # repeated rows, as anchors too, and ties between them
    clash = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS row", "2 AS score", "3 AS id", "4 AS shard")
    found = negatives.hard_negatives(clash, F.col("id") % 10 == 0).collect()
    assert sorted(map(tuple, found), key=repr) == plain(rows)
    huge = rows + [(180, [3e38] * 8, 0)]  # beyond 64 bits: takes no part
    found = negatives.hard_negatives(spark.createDataFrame(huge, SCHEMA), F.col("id") % 10 == 0).collect()
    assert sorted(map(tuple, found), key=repr) == plain(rows)
    assert negatives.hard_negatives(clash.where("false"), F.col("id") % 10 == 0).count() == 0


def test_join_finds_every_pair_over_its_threshold():
    rng = np.random.default_rng(4)
    rows, anchors = rng.integers(-300, 300, (500, 40)), rng.integers(-300, 300, (20, 40))
    rows[:, :5] *= 4
    index, scores = negatives.Index(rows), anchors @ rows.T
    for least in (-10 ** 9, 0, 200_000, 2_000_000, 10 ** 9):
        at, place, found = index.join(anchors, np.full(20, least))
        assert set(zip(at, place)) == set(zip(*np.nonzero(scores >= least)))
        assert (scores[at, place] == found).all()


def test_the_index_leaves_out_covered_dimensions():
    """Energy in the first dimensions: at a high threshold no row is indexed beyond the first group."""
    rng = np.random.default_rng(5)
    rows = np.c_[rng.integers(50, 100, (300, 16)), rng.integers(-3, 3, (300, 48))]
    index = negatives.Index(rows)
    least = 0.9 * np.sort(rows[:1] @ rows.T)[0, -3]
    covered = index.rest * (index.rest[:1] / least).max(axis=0) < 1
    assert set(covered.argmax(axis=1)) == {0, 1}  # 0: not at all
    at, place, _ = index.join(rows[:1], np.array([int(least)]))
    assert set(place) == set(np.flatnonzero(rows[:1] @ rows.T >= int(least)) % 300)
