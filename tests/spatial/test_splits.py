import math
import random

import pytest

from skylattice.operators import splits


def parts(df, id_col="id"):
    out = {"train": [], "val": [], "test": []}
    for r in df.collect():
        out[r.part].append(r[id_col])
    return {p: sorted(ids) for p, ids in out.items()}


@pytest.mark.parametrize("n,seed", [(0, 0), (1, 3), (20, 0), (333, 42)])
def test_exact_random_split_is_pythons(spark, n, seed):
    order = list(range(n))
    random.Random(seed).shuffle(order)
    a, b = int(n * 0.7), int(n * 0.15)
    got = parts(splits.random_split(spark.range(n).repartition(3), seed=seed, exact=True))
    assert got == {"train": sorted(order[:a]), "val": sorted(order[a : a + b]), "test": sorted(order[a + b :])}


@pytest.mark.parametrize("seed", [0, 7])
def test_exact_spatial_split_is_pythons(spark, seed):
    rng = random.Random(seed)
    points = [(i, rng.uniform(-0.4, 0.4), rng.uniform(46.9, 47.3)) for i in range(400)]
    cells = {}
    for i, lon, lat in points:
        cells.setdefault((math.floor(lon / 0.05), math.floor(lat / 0.05)), []).append(i)
    keys = sorted(cells)
    random.Random(seed).shuffle(keys)
    want, before = {"train": [], "val": [], "test": []}, 0
    for k in keys:
        want["train" if before < 400 * 0.7 else "val" if before < 400 * 0.7 + 400 * 0.15 else "test"] += cells[k]
        before += len(cells[k])
    got = parts(splits.spatial_split(spark.createDataFrame(points, "id int, lon double, lat double").repartition(4), seed=seed, exact=True))
    assert got == {p: sorted(ids) for p, ids in want.items()} and len(keys) > 50


def test_exact_orders_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(splits, "EXACT", 10)
    with pytest.raises(ValueError, match="over 10"):
        splits.random_split(spark.range(11), exact=True)
