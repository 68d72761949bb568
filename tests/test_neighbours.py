"""Matrix-product neighbours, the grid and the pruned join against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import neighbours, resample

WIDE = [f"e{i}" for i in range(24)]


def brute(q, c, k, p, partial, q_keys, c_keys):
    far = neighbours._distances(q, c, p, partial)
    far[q_keys[:, None] == c_keys[None, :]] = np.nan
    out = []
    for i, row in enumerate(far):
        order = [j for j in np.lexsort((np.arange(len(c)), row)) if not np.isnan(row[j])][:k]
        out += [(i, c_keys[j], row[j]) for j in order]
    return out


@pytest.mark.parametrize("p, partial", [(2.0, False), (2.0, True), (1.0, False), (3.0, False)])
@pytest.mark.parametrize("kind", ["plain", "far off", "copies", "whole numbers", "huge"])
def test_closest_rows_are_exact(p, partial, kind):
    draw = np.random.default_rng(7)
    c = draw.normal(size=(2500, 6))
    if kind == "far off":
        c = c * 1e-2 + 1e6
    if kind == "copies":
        c[::3] = c[0]
    if kind == "whole numbers":
        c = np.round(c)
    if kind == "huge":
        c[5] = 1e200
    q = np.concatenate([c[:300], c[:40] * 1.5])
    if partial:
        c[draw.random(c.shape) < 0.2], q[draw.random(q.shape) < 0.2] = np.nan, np.nan
    keys = np.sort(draw.integers(0, 2400, len(c)))
    mine = np.r_[keys[:300], np.arange(40) + 5000]
    with np.errstate(all="ignore"):
        r, j, far = neighbours.closest(q, c, 4, p, partial, mine, keys)
        want = brute(q, c, 4, p, partial, mine, keys)
    assert list(zip(r.tolist(), keys[j].tolist())) == [w[:2] for w in want]
    np.testing.assert_allclose(far, [w[2] for w in want], rtol=1e-12)


def table(spark, x):
    rows = [(i, *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, ", ".join(["id bigint", *[f"e{j} double" for j in range(x.shape[1])]])).repartition(3)


def near(df, k, **more):
    got = neighbours.knn_join(df, df, "id", "id", [c for c in df.columns if c != "id"], k, exclude_self=True, **more).collect()
    return sorted((r.id, r["rank"], r.neighbour, round(r.distance, 9)) for r in got)


def wanted(x, k):
    ids = np.arange(len(x))
    found = brute(x, x, k, 2.0, False, ids, ids)
    return sorted((i, n % k + 1, int(j), round(float(d), 9)) for n, (i, j, d) in enumerate(found))


def test_vectors_that_boxes_cannot_rule_out_meet_in_a_grid(spark, monkeypatch):
    sides = []
    grid = neighbours.grid
    monkeypatch.setattr(neighbours, "grid", lambda *a: sides.append(a[2:4]) or grid(*a))
    monkeypatch.setattr(neighbours, "GRID_ROWS", 128)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    x = np.random.default_rng(1).normal(size=(300, 24))
    df = table(spark, x)
    assert near(df, 3, block_rows=20) == wanted(x, 3)
    assert sides == [(300, 300)]  # one row per lane or block that it meets, not one per query and box
    few = df.where("id < 0")
    assert neighbours.knn_join(few, df, "id", "id", WIDE, 2, block_rows=20).collect() == []


def test_boxes_that_rule_out_are_used(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "VISIT_ROWS", 0)
    monkeypatch.setattr(neighbours, "grid", lambda *a: pytest.fail("boxes rule out most blocks"))
    draw = np.random.default_rng(2)
    x = np.concatenate([draw.random((500, 2)), np.tile([[0.5, 0.5]], (100, 1))])
    assert near(table(spark, x), 3, block_rows=20, query_rows=30) == wanted(x, 3)


def test_rows_are_not_sent_to_ever_more_boxes(spark, monkeypatch):
    """Boxes that rule out only some blocks send rows as often as there are others: more with every block."""
    sides, blocks = [], []
    grid, share = neighbours.grid, neighbours._share_visited
    monkeypatch.setattr(neighbours, "grid", lambda *a: sides.append(a[2:4]) or grid(*a))
    monkeypatch.setattr(neighbours, "_share_visited", lambda *a: blocks.append((len(a[-1]), share(*a))) or blocks[-1][1])
    monkeypatch.setattr(neighbours, "VISIT_ROWS", 0)
    x = np.random.default_rng(6).random((600, 10))
    assert near(table(spark, x), 3, block_rows=8, query_rows=8) == wanted(x, 3)
    n, part = blocks[0]
    assert 20 < n * part <= 600 / 8  # fewer pairs than in a grid, but rows sent over 16 times
    assert sides == [(600, 600)]


def test_links_are_asked_from_the_smaller_classes(spark, monkeypatch):
    asked = []
    join = resample.knn_join
    monkeypatch.setattr(resample, "knn_join", lambda q, *a, **b: asked.append(q.count()) or join(q, *a, **b))
    draw = np.random.default_rng(3)
    x = draw.normal(size=(200, 3))
    label = draw.integers(0, 10, 200) // 8  # 0 in most rows, else 1
    df = table(spark, x).withColumn("y", F.element_at(F.array(*map(F.lit, label.tolist())), (F.col("id") + 1).cast("int")))
    got = sorted(r.id for r in resample.tomek_links(df, "id", ["e0", "e1", "e2"], "y").collect())
    first = {i: j for i, n, j, _ in wanted(x, 1)}
    assert got == sorted(i for i, j in first.items() if first[j] == i and label[i] != label[j]) and got
    assert asked[0] == (label == 1).sum() and sum(asked) < 200


def test_the_grid_reads_blocks_instead_of_shuffling_them_to_every_lane(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GRID_ROWS", 64)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    monkeypatch.setattr(neighbours, "GRID_CELLS", 0.01)
    x = np.round(np.random.default_rng(5).normal(size=(640, 8)), 1)
    x[::9] = x[0]
    df = table(spark, x).withColumn("tag", F.concat(F.lit("t"), F.col("id")))
    base = df.select(F.col("id").alias("key"), F.array(*[f"e{j}" for j in range(8)]).alias("v"), F.col("tag").alias("c0"))
    meet = neighbours.meeting(3, 2.0, False, True, ["c0"], 8)
    ddl = "query bigint, neighbour bigint, distance double, c0 string"
    found = neighbours.grid(base, base, 640, 640, meet, 3, ["c0"], ddl)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "CartesianProduct" in plan  # behind it, only k rows per query and piece are shuffled
    rows = found.collect()
    assert len(rows) == 640 * 3 and all(r.c0 == f"t{r.neighbour}" for r in rows)
    got = sorted((r.query, r.neighbour, round(r.distance, 9)) for r in rows)
    ids = np.arange(640)
    assert got == sorted((i, int(j), round(float(d), 9)) for i, j, d in brute(x, x, 3, 2.0, False, ids, ids))


def test_vectors_travel_short_only_where_that_is_exact():
    import pyarrow as pa

    for values, kind in (([[0.5, None], [float("nan"), 2.0]], pa.float32()), ([[0.1, 1.0]], pa.float64()), ([[1e300, 1.0]], pa.float64())):
        rows = pa.table({"key": list(range(len(values))), "v": pa.array(values, pa.list_(pa.float64()))})
        out = neighbours._narrow(rows)
        assert out.schema.field("v").type.value_type == kind
        np.testing.assert_array_equal(neighbours.vectors(out, 2), neighbours.vectors(rows, 2))
