import random

from sensorloom.llm import components as C
from sensorloom.llm.components import components


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(8, 60)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    edges += [(5, 5), (None, 3), (3, None), (8, 7), (8, 7)]
    parent = {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        parent.setdefault(a, a), parent.setdefault(b, b)
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    rows = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(rows) == len(parent)
    assert {r["node"]: r["component"] for r in rows} == {x: root(x) for x in parent}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_look_tells_whether_a_graph_is_settled(spark, monkeypatch):
    """Each round costs the driver one query without a join, however its edges lie."""
    table = type(spark.range(1))
    seen, empty = [], table.isEmpty

    def looked(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return empty(df)

    monkeypatch.setattr(table, "isEmpty", looked)
    for edges, settled in (
        ([], True),
        ([(5, 1), (6, 1), (9, 2)], True),
        ([(5, 1), (5, 2)], False),
        ([(5, 3), (3, 1)], False),
        ([(9, 5), (5, 1), (6, 1)], False),
    ):
        seen.clear()
        assert C._settled(spark.createDataFrame(edges, "a bigint, b bigint")) == settled
        assert len(seen) == 1 and "Join" not in seen[0]
