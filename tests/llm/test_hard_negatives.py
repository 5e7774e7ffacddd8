import math
import random

import pytest
from pyspark.sql import functions as F

from wordloom.llm import hard_negatives as hn
from wordloom.llm.queries import op11_hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, lane int, key string, ids binary"


def table(spark, rows):
    return spark.createDataFrame([(*row, 7, "k", b"x") for row in rows], SCHEMA)


def mined(spark, rows, **options):
    df = hn.hard_negatives(table(spark, rows), F.col("vec_id") % 100 == 0, **options)
    return sorted(tuple(r) for r in df.collect())


def brute(rows, n_positives=5, n_negatives=10, low=30, high=90):
    usable = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, v, label) in enumerate(usable):
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, m) for b, (j, w, m) in enumerate(usable) if b != a]
        positives = sorted((s, j) for s, j, m in scored if m == label)[:n_positives]
        negatives = sorted((s, j) for s, j, m in scored if m != label)
        for p, j in positives:
            inside = [(s, n) for s, n in negatives if low * -p <= 100 * -s <= high * -p][:n_negatives]
            out += [(i, j, rank, n, -p, -s) for rank, (s, n) in enumerate(inside, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    # A third of the rows under one label, coarse values for ties, and a table not ordered by id.
    out = [
        (i, [r.choice([-0.5, -0.25, 0.0, 0.25, 0.5]) + r.choice([0.0, 0.1]) for _ in range(6)], 0 if i % 3 == 0 else r.randrange(1, 4))
        for i in range(700)
    ]
    r.shuffle(out)
    return out


def test_equals_brute_force(spark, rows):
    want = brute(rows)
    assert len(want) > 100 and mined(spark, rows) == want


@pytest.mark.parametrize("name, value", [("PIECE", 50), ("GROUP", 2), ("LANE_PIECES", 100)])
def test_layout_changes_nothing(spark, rows, monkeypatch, name, value):
    monkeypatch.setattr(hn, name, value)
    assert mined(spark, rows[:400]) == brute(rows[:400])


def test_other_limits(spark, rows):
    options = {"n_positives": 2, "n_negatives": 3, "low": 0, "high": 100}
    assert mined(spark, rows[:300], **options) == brute(rows[:300], **options)


def test_unusable_rows_and_repeats(spark):
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (100, [0.5, 0.5], 2), (1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1),
        (2, [0.75], 2), (3, [0.5, 0.25, 9.0], 3), (4, [], 2), (5, None, 1), (6, [1.0, None], 1), (7, [1.0, 0.0], None),
        (8, [float("nan"), 1.0], 2), (9, [float("inf"), 1.0], 2), (None, [1.0, 1.0], 2), (10, [-1.0, -1.0], 1),
        (11, [0.3, 0.0], 2), (12, [0.3, 0.0], 2),
    ]
    want = brute(rows)
    assert len(want) > 10 and mined(spark, rows) == want


def test_zero_scores_meet_whatever_their_ids(spark):
    rows = [(100, [0.0], 1), (101, [1.0], 1), (5, [1.0], 2), (200, [1.0], 2)]
    got = mined(spark, rows)
    assert (100, 101, 1, 5, 0, 0) in got and got == brute(rows)


def test_great_values_stay_exact(spark):
    rows = [(0, [65535.0, 65535.0], 1), (1, [65535.0, 65534.5], 1), (2, [40000.0, 40000.00390625], 2), (3, [40000.0, 40000.0], 2)]
    assert mined(spark, rows) == brute(rows)


def test_empty(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == [] and mined(spark, [(0, [1.0], 1)]) == []


def test_query_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in given]
    assert sorted(tuple(r) for r in op11_hard_negatives(spark, path).collect()) == brute(rows)
