"""The range join of embeddings against a plain version."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.llm import metric

SCHEMA = "vec_id long, embedding array<float>, label int, Node int, rows int, dist int"


def brute(rows, limit=0.93):
    """(vec_id, n_links, component_id) of rows that all can link, by place."""
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(np.float64)
    x = x / np.sqrt((x * x).sum(axis=1))[:, None]
    label = np.array([r[2] for r in rows])
    near = ((x @ x.T) >= limit) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    ids = np.array([r[0] for r in rows])
    least = ids.copy()
    while True:
        lower = np.minimum(least, np.where(near, least[None, :], 1 << 60).min(axis=1))
        if (lower == least).all():
            break
        least = lower
    return sorted(zip(ids.tolist(), near.sum(axis=1).tolist(), least.tolist()))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 1, 1) for i, v, label in rows], SCHEMA)


def result(df):
    return sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect())


def clustered(random, n, dims=8, centres=12, tight=0.01):
    """A third of all rows in one narrow group, copies, chains and scattered vectors."""
    middle = random.normal(size=(centres, dims))
    middle /= np.linalg.norm(middle, axis=1)[:, None]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            v = middle[0] + random.normal(size=dims) * tight
        elif i % 7 == 0 and rows:
            v = np.array(rows[int(random.integers(len(rows)))][1]) * random.choice([1.0, 2.0, 0.5])
        else:
            v = middle[random.integers(centres)] + random.normal(size=dims) * random.choice([0.05, 0.12, 0.3])
        rows.append((i, [float(c) for c in v], 0 if i % 3 == 0 else int(i % 4)))
    return rows


def test_given_table(spark):
    source = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in source.collect()]
    assert result(metric.near_copies(source)) == brute(rows)


@pytest.mark.parametrize("block, choices", [(1024, metric.CHOICES), (40, (8,)), (40, (1,))])
def test_clusters(spark, monkeypatch, block, choices):
    """Small blocks bring rings, rings linked as a whole, and parts; eight pivots bring visits."""
    monkeypatch.setattr(metric, "BLOCK", block)
    monkeypatch.setattr(metric, "CHOICES", choices)
    rows = clustered(np.random.default_rng(9), 500)
    out = metric.near_copies(frame(spark, rows))
    assert result(out) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.collect())


def test_narrow_group_is_linked_without_pairs(spark, monkeypatch):
    monkeypatch.setattr(metric, "BLOCK", 20)
    random = np.random.default_rng(2)
    rows = [(i, [float(c) for c in np.ones(6) + random.normal(size=6) * 0.001], 1) for i in range(200)]
    classes = frame(spark, rows).select("label", "embedding", F.lit(1).cast("long").alias("rows"), F.col("vec_id").alias("node"))
    links, sure = metric._joined(classes, 6, math.sqrt(2 - 2 * 0.93), 0.93)
    assert links.where("links is not null").count() == 0 and links.count() <= 3 * len(rows)
    assert {r["sure"] for r in sure.collect()} == {199}
    assert {(n, c) for _, n, c in result(metric.near_copies(frame(spark, rows)))} == {(199, 0)}


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
        (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [1.0, nan], 1), (9, [inf, 0.0], 1), (10, [1.0, None], 1),
        (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.1], 1), (None, [0.0, 1.0], 3), (12, [0.0, 1.0], 3), (13, [-1.0, -0.0], 1),
        (None, None, None), (14, [1e-30, 0.0], 4), (15, [1e30, 1e29], 4),
    ]
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in metric.near_copies(frame(spark, rows)).collect()), key=str)
    want = [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (None, 3, 1, False)]
    want += [(i, 0, i, True) for i in (5, 6, 7, 8, 9, 10, 11, 13)]
    want += [(None, 1, 12, False), (12, 1, 12, True), (None, 0, None, True), (14, 1, 14, True), (15, 1, 14, False)]
    assert got == sorted(want, key=str)
    assert metric.near_copies(frame(spark, rows[:0])).count() == 0


def test_links_span_their_components():
    random = np.random.default_rng(4)
    for _ in range(30):
        near = random.random((12, 9)) < 0.12
        rows, columns = metric.spanning(near)
        edges = {(i, 12 + j) for i, j in zip(*np.nonzero(near))}
        least = {k: k for k in range(21)}
        for _ in range(21):
            for a, b in edges:
                least[a] = least[b] = min(least[a], least[b])
        assert [*rows, *columns] == [least[k] for k in range(21)]
