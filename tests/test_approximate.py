"""Random-projection buckets against exact neighbours."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import approximate, neighbours

WIDE = [f"e{i}" for i in range(64)]


def table(spark, x, **more):
    rows = [(i, *map(float, v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, ", ".join(["id bigint", *[f"e{j} double" for j in range(x.shape[1])]])).repartition(4)
    return df.withColumns({k: F.lit(v) for k, v in more.items()})


def exact(x, q, k, same):
    far = np.sqrt(((q[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    if same:
        np.fill_diagonal(far, np.inf)
    return [sorted(zip(f.tolist(), range(len(x))))[:k] for f in far]


def share_found(rows, want, k):
    got = {}
    for r in rows:
        got.setdefault(r.id, {})[r["rank"]] = (r.distance, r.neighbour)
    hits = sum(len({n for _, n in got.get(i, {}).values()} & {n for _, n in w}) for i, w in enumerate(want))
    for i, ranked in got.items():  # distances are exact and ranks are in their order
        assert [ranked[r] for r in sorted(ranked)] == sorted(ranked.values()) and len(ranked) <= k
    return hits / (k * len(want))


def test_recall_on_the_embeddings(spark):
    place = "/root/testdata/sf0.1/embeddings.parquet"
    if not os.path.exists(place):
        pytest.skip("test tables not present")
    x = np.array([r.embedding for r in spark.read.parquet(place).orderBy("vec_id").collect()], float)
    df = table(spark, x)
    got = approximate.knn_approx(df, df, "id", "id", WIDE, 10, exclude_self=True, recall=0.92, leaf_rows=128).collect()
    assert share_found(got, exact(x, x, 10, True), 10) >= 0.9


def test_few_buckets_on_clusters(spark, monkeypatch):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(40, 64))[draw.integers(0, 40, 2000)] + 0.05 * draw.normal(size=(2000, 64))
    visited = []
    fitted = approximate._fitted_probes
    monkeypatch.setattr(approximate, "_fitted_probes", lambda *a: visited.append(fitted(*a)) or visited[-1])
    df = table(spark, x, colour="red")
    got = approximate.knn_approx(df, df, "id", "id", WIDE, 5, exclude_self=True, carry=["colour"], leaf_rows=32).collect()
    assert share_found(got, exact(x, x, 5, True), 5) >= 0.9
    assert visited[0] <= 8 and {r.colour for r in got} == {"red"}  # of 64 buckets a tree


def test_one_vector_in_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(approximate, "QUERY_ROWS", 100)
    draw = np.random.default_rng(3)
    x = np.concatenate([draw.normal(size=(400, 8)), np.tile(draw.normal(size=(1, 8)), (200, 1))])
    df = table(spark, x)
    got = approximate.knn_approx(df, df, "id", "id", WIDE[:8], 3, exclude_self=True, leaf_rows=20).collect()
    copies = [r for r in got if r.id >= 400]
    assert len(copies) == 600 and all(r.distance == 0 and r.neighbour >= 400 for r in copies)


def test_mode_of_the_join(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(30, 4))
    df = table(spark, x).withColumn("e2", F.when(F.col("id") != 7, F.col("e2")))
    args = (df, df, "id", "id", WIDE[:4], 3)
    near = [sorted(map(tuple, neighbours.knn_join(*args, p=1.0, exclude_self=True, mode=m).collect())) for m in ("exact", "approx")]
    assert len(near[0]) == 87 and [r[:2] for r in near[0]] == [r[:2] for r in near[1]]
    assert neighbours.knn_join(df, df.limit(0), *args[2:], mode="approx").collect() == []
    assert neighbours.knn_join(df.limit(0), df, *args[2:], mode="approx").collect() == []
    with pytest.raises(ValueError):
        neighbours.knn_join(*args, allow_missing=True, mode="approx")
    with pytest.raises(ValueError):
        neighbours.knn_join(*args, mode="quick")
