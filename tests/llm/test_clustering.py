"""Clusters against plain rounds in whole numbers."""

import hashlib
import random

import numpy as np
import pytest

from ledgerloom.llm import clustering


def plain(points, k, rounds, seed):
    """(clusters, squared distances, centroids) by comparing each vector with each centroid."""
    order = sorted(range(len(points)), key=lambda i: (hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), points[i]))
    centroids = [list(points[i]) for i in order[:k]]
    near = lambda p: min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = [near(p)[1] for p in points]
        for j in range(len(centroids)):
            if mine := [p for p, o in zip(points, own, strict=True) if o == j]:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [near(p) for p in points]
    return [j for _, j in found], [d for d, _ in found], centroids


def by_steps(points, k, rounds, groups, cut=7):
    """The same by Step, in batches of `cut` rows; how many distances each round computed."""
    order = sorted(range(len(points)), key=lambda i: (hashlib.sha256(f"3:{i}".encode()).hexdigest(), points[i]))
    x = np.array(points, np.int64)
    centroids = x[order[:k]]
    group = clustering.grouped(centroids, groups)
    moved, state, scanned = np.zeros(len(centroids)), None, []
    for _ in range(rounds):
        step = clustering.Step(centroids, moved, group)
        state = state or step.first(len(x))
        parts = [step(x[i : i + cut], *(s[i : i + cut] for s in state)) for i in range(0, len(x), cut)]
        state = tuple(np.concatenate(p) for p in zip(*parts, strict=True))
        scanned.append(step.scanned)
        new = centroids.copy()
        for j in range(len(centroids)):
            if (mine := x[state[0] == j]).size:
                new[j] = [int(t) // len(mine) for t in mine.sum(0)]
        moved = clustering.above(np.sqrt(((new - centroids) ** 2).sum(1)))
        centroids = new
    step = clustering.Step(centroids, moved, group)
    own = step(x, *state)[0]
    return own.tolist(), step.distances(x, own).tolist(), centroids.tolist(), scanned


@pytest.mark.parametrize("groups", [1, 2, 3, 5])
@pytest.mark.parametrize("width", [2, 40])  # small numbers have many ties
def test_steps_equal_plain_rounds(groups, width):
    rnd = random.Random(groups * 100 + width)
    for _ in range(12):
        points = [[rnd.randint(-width, width) for _ in range(3)] for _ in range(rnd.randint(1, 60))]
        points += rnd.choices(points, k=5)
        k = rnd.randint(1, 9)
        own, d, centroids, _ = by_steps(points, min(k, len(points)), 6, groups)
        assert (own, d, centroids) == plain(points, k, 6, 3)


def test_bounds_spare_distances():
    rnd = random.Random(5)
    middles = [[rnd.randint(-1000, 1000) for _ in range(8)] for _ in range(9)]
    points = [[m + rnd.randint(-30, 30) for m in rnd.choice(middles)] for _ in range(3000)]
    own, d, centroids, scanned = by_steps(points, 9, 8, 3, cut=500)
    assert (own, d, centroids) == plain(points, 9, 8, 3)
    assert scanned[0] == 9 * len(points)
    assert scanned[-1] < len(points)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_frame_equals_plain_rounds(spark):
    rnd = random.Random(8)
    points = [[rnd.uniform(-2, 2) for _ in range(4)] for _ in range(90)]
    whole = [[int(np.floor(16 * v)) for v in p] for p in points]
    got = clustering.cluster(vectors(spark, list(enumerate(points))).repartition(3), k=5, rounds=4, dimensions=4, scale=16).collect()
    own, d, centroids = plain(whole, 5, 4, 3)
    assert {(r["vec_id"], r["cluster"], r["distance"]) for r in got} == set(zip(range(90), own, d, strict=True))
    for r in got:
        assert r["inertia"] == sum(d)
        assert r["cluster_inertia"] == sum(x for x, j in zip(d, own, strict=True) if j == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


def test_fewer_vectors_than_clusters(spark):
    rows = [(7, [0.25] * 64), (7, [0.25] * 64), (None, [0.5] * 64)]
    got = clustering.cluster(vectors(spark, rows)).collect()
    assert sorted((str(r["vec_id"]), r["distance"]) for r in got) == [("7", 0), ("7", 0), ("None", 0)]
    assert len({r["cluster"] for r in got}) == 2  # equal ones go to the smaller number


def test_components_too_large_for_a_long(spark):
    with pytest.raises(Exception, match="over 134217728 in size"):
        clustering.cluster(vectors(spark, [(1, [1e30] * 64)])).collect()
