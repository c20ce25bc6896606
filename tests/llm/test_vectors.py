import math
import random

import numpy as np

from sensorloom.llm import vectors as V

TYPES = "vec_id bigint, embedding array<float>, label int, n_links int, size int, cell int"


def clusters(seed=0, size=16):
    rng = np.random.default_rng(seed)
    rows, number = [], 0
    for _ in range(12):
        center = rng.normal(size=size)
        for _ in range(int(rng.integers(1, 25))):
            spread = rng.choice([0.0, 0.02, 0.05, 0.09])
            vector = (center + rng.normal(size=size) * spread) * rng.uniform(0.1, 9)
            label = [0, 0, 0, 1, None][int(rng.integers(5))]
            rows.append((number, [float(np.float32(x)) for x in vector], label, 1, 2, 3))
            number += 1
    # A chain of links, copies of one vector, and rows that link with nothing.
    for step in range(30):
        angle = step * 0.15
        rows.append((number, [math.cos(angle), math.sin(angle)] + [0.0] * (size - 2), 5, 1, 2, 3))
        number += 1
    rows += [(number + i, [1.0] * size, 6, 1, 2, 3) for i in range(40)]
    number += 40
    odd = [None, [], [0.0] * size, [float("nan")] * size, [float("inf")] + [1.0] * (size - 1), [None] * size, [1.0, 2.0]]
    rows += [(number + i, v, 0, 1, 2, 3) for i, v in enumerate(odd)]
    rows.append((None, [1.0] * size, 6, 1, 2, 3))
    random.Random(1).shuffle(rows)
    return rows


def usable(row):
    v = row[1]
    if row[0] is None or row[2] is None or not v or None in v:
        return False
    return all(map(math.isfinite, v)) and any(v)


def brute(rows, cosine=0.98):
    own = [r for r in rows if usable(r)]
    parent = {r[0]: r[0] for r in rows}
    links = {r[0]: 0 for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = [np.array(r[1], float) / np.linalg.norm(r[1]) for r in own]
    for i in range(len(own)):
        for j in range(i):
            if own[i][2] == own[j][2] and len(own[i][1]) == len(own[j][1]) and unit[i] @ unit[j] >= cosine:
                a, b = own[i][0], own[j][0]
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {r[0]: (links[r[0]], root(r[0])) for r in rows if r[0] is not None}


def check(spark, rows):
    got = V.near_vectors(spark.createDataFrame(rows, TYPES)).collect()
    assert len(got) == len(rows)
    expected = brute(rows)
    for row in got:
        if row["vec_id"] is None:
            assert (row["n_links"], row["component_id"]) == (0, None)
        else:
            assert (row["n_links"], row["component_id"]) == expected[row["vec_id"]]
            assert row["kept"] == (row["vec_id"] == row["component_id"])


def test_matches_brute_force(spark):
    check(spark, clusters())


def test_small_intervals(spark, monkeypatch):
    monkeypatch.setattr(V, "INTERVAL", 7)
    check(spark, clusters(3))


def test_recursion_in_small_parts(monkeypatch):
    monkeypatch.setattr(V, "PART", 2)
    rng = np.random.default_rng(5)
    vectors = np.repeat(rng.normal(size=(9, 8)), 5, axis=0) + rng.normal(size=(45, 8)) * 0.05
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    a = (np.arange(45), np.ones(45, np.int64), vectors)
    axes = np.linalg.qr(rng.normal(size=(8, 3)))[0]
    joined = V.Joined(a, a, 0.98, axes)
    near = vectors @ vectors.T >= 0.98
    np.fill_diagonal(near, False)
    assert joined.links[:45].tolist() == near.sum(axis=1).tolist()


def test_empty_and_unusable(spark):
    assert V.near_vectors(spark.createDataFrame([], TYPES)).count() == 0
    rows = [(1, None, 0, 1, 2, 3), (2, [0.0], 0, 1, 2, 3), (3, [1.0], None, 1, 2, 3)]
    got = V.near_vectors(spark.createDataFrame(rows, TYPES)).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got} == {
        (1, 0, 1, True),
        (2, 0, 2, True),
        (3, 0, 3, True),
    }
