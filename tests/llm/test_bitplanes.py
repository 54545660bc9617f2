"""Bit-plane clustering against whole-number arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from parcelflow.llm import bitplanes

SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, cluster string, numbers string, distance string, planes string"


def plain(rows, k=16, rounds=3):
    kept = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and -(1 << 21) <= x < 1 << 21 for x in v)
    ]
    kept.sort(key=lambda p: (p[0] is None, hashlib.sha256(f"1:{p[0]}".encode()).hexdigest(), p[1]))
    centroids = [v for _, v in kept[:k]]
    for step in range(rounds + 1):
        at = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            at.append((d.index(min(d)), min(d)))
        for n in range(len(centroids) if step < rounds else 0):
            own = [v for (_, v), (c, _) in zip(kept, at, strict=True) if c == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = [sum(d for c, d in at if c == n) for n in range(len(centroids))]
    return sorted(((i, c, d, inertia[c], sum(inertia), sha[c]) for (i, _), (c, d) in zip(kept, at, strict=True)), key=str)


def found(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, *[None] * 6) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in bitplanes.cluster(df, **settings).collect()), key=str)


def vectors(seed, n, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (spread * rng.standard_normal(64)).tolist()) for i in range(n)]


@pytest.mark.parametrize(("seed", "n", "spread"), [(1, 200, 1.0), (2, 100, 1000.0), (3, 5, 0.1), (4, 40, 300_000.0)])
def test_equals_whole_number_arithmetic(llm, seed, n, spread):
    assert found(llm, vectors(seed, n, spread)) == plain(vectors(seed, n, spread))


def test_odd_rows(llm):
    nan, inf = float("nan"), float("inf")
    same = [0.5] * 64
    rows = [
        *vectors(5, 12), (100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [nan] + [0.0] * 63), (105, [-inf] + [0.0] * 63),
        (106, [None] + [0.0] * 63), (107, [1e30] + [0.0] * 63), (108, [0.0] * 64), (None, same), (None, [-0.25] * 64), (7, same), (7, same), (7, [2.0] * 64),
        (109, [-2097152.0] + [2097151.984375] * 63),
    ]
    assert found(llm, rows) == plain(rows)
    assert found(llm, rows, k=3, rounds=0) == plain(rows, 3, 0)


def test_ties_go_to_the_smaller_cluster(llm):
    rows = [(i, [1.0] * 64) for i in range(20)]
    assert {r[1] for r in found(llm, rows)} == {0} and found(llm, rows) == plain(rows)


def test_empty_table(llm):
    assert found(llm, []) == [] and found(llm, [(1, None)]) == []


def test_planes_give_exact_products_and_sums():
    rng = np.random.default_rng(9)
    for bits in (2, 7, 28):
        x = rng.integers(-(1 << (bits - 1)), 1 << (bits - 1), (50, 64))
        planes, weights = bitplanes.pack(x, bits), bitplanes.plane_weights(bits)
        for k in range(5):
            assert (bitplanes.dots(planes, planes[k], weights) == x @ x[k]).all()
        assert (weights @ bitplanes.set_bits(planes) == x.sum(axis=0)).all()
