"""Walsh-Hadamard clustering against plain k-means in unbounded integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import walsh_clusters as wc

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, id string"


def brute(rows, k=16, rounds=3):
    """[(vec_id, cluster, squared distance)] and centroids of the kept rows."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(64 * float(np.float32(x))) for x in v]))
    name = lambda r: hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()
    centroids = [v for _, v in sorted((r for r in kept if r[0] is not None), key=lambda r: (name(r), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for i, vs in members.items():
            centroids[i] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    return [(vec_id, nearest(v)[1], nearest(v)[0]) for vec_id, v in kept], centroids


def rows_of(rng, n=300):
    centre = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.4) for c in centre[i % 6]]) for i in range(n)]
    rows += [(n + i, list(rows[0][1])) for i in range(40)]  # equal vectors: ties between centroids
    rows += [(5, list(rows[5][1])), (None, [0.25] * 64), (None, [0.0] * 64)]
    bad = [float("nan")], [float("inf")], [float("-inf")], [None]
    rows += [(900 + i, [0.5] * 63 + b) for i, b in enumerate(bad)]
    rows += [(910, None), (911, []), (912, [0.1] * 63), (913, [0.1] * 65)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, "x") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_match_brute_force(spark, seed):
    rows = rows_of(random.Random(seed))
    got = wc.cluster(frame(spark, rows).repartition(5))
    want, centroids = brute(rows)
    assert got.centroids == centroids
    found = got.rows.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r["id"], r["cluster"], r["distance"]) for r in found), key=key) == sorted(want, key=key)
    # the search leaves out coefficients, yet decides as if it had them all
    assert sum(r["coefficients"] for r in found) < 0.6 * 64 * 16 * len(found)
    full = {(r["id"], r["cluster"]): r for r in wc.with_inertia(got).collect()}
    total = sum(d for _, _, d in want)
    for vec_id, c, _ in want:
        r = full[vec_id, c]
        assert r["inertia"] == total and r["cluster_inertia"] == sum(d for _, k, d in want if k == c)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()


def test_large_components_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * 3.0e5 * rng.random() for _ in range(64)]) for i in range(40)]
    rows += [(40 + i, [2.0**25] * 64) for i in range(3)]
    got = wc.cluster(frame(spark, rows))
    want, centroids = brute(rows)
    assert got.centroids == centroids
    assert sorted((r["id"], r["cluster"], r["distance"]) for r in got.rows.collect()) == sorted(want)
    with pytest.raises(Exception, match="cannot be clustered exactly"):
        wc.cluster(frame(spark, [(1, [1e30] * 64)])).rows.collect()


def test_few_and_no_vectors(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert [(r["id"], r["distance"]) for r in wc.cluster(frame(spark, rows)).rows.orderBy("id").collect()] == [(0, 0), (1, 0), (2, 0)]
    none = wc.cluster(frame(spark, rows).where(F.lit(False)))
    assert none.centroids == [] and wc.with_inertia(none).count() == 0


def test_transform_keeps_distances():
    rng = np.random.default_rng(4)
    a, b = rng.integers(-999, 999, (5, 64)), rng.integers(-999, 999, (5, 64))
    assert ((wc.transform(a) - wc.transform(b)) ** 2).sum(axis=1).tolist() == (64 * ((a - b) ** 2).sum(axis=1)).tolist()
    # coarse to fine: the first coefficient is the sum, sign changes grow
    assert wc.transform(a)[:, 0].tolist() == a.sum(axis=1).tolist()
