"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors are projected onto the leading principal axes, along which a grid of the width epsilon
orders them. The sequence of each label is cut into intervals. Two intervals whose boxes of
coordinates are further apart than epsilon hold no pair; the others meet in a task, which splits
them again and again, skips distant parts, and compares what is left in double precision.

A projection never lengthens a distance, so skipping is exact: cosine >= s means a distance of at
most sqrt(2 - 2 s) between unit vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.common import require, stored
from sensorloom.llm.components import components

COSINE = 0.98
AXES = 6
# Vectors in an interval, and in the smallest part that is compared at once.
INTERVAL, PART = 1024, 64
SLACK = 1e-9
_VECTOR = "vec_id bigint, label bigint, copies bigint, vector binary"


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors as bytes of doubles; rows that link with nothing are left out."""
    for batch in batches:
        rows = []
        for vec_id, label, values in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if not values or vec_id is None or label is None or None in values:
                continue
            vector = np.array(values, dtype=np.float64)
            largest = np.abs(vector).max()
            if not np.isfinite(largest) or largest == 0:
                continue
            vector = vector / largest
            rows.append((vec_id, label, 1, (vector / np.linalg.norm(vector)).tobytes()))
        ids, labels, copies, vectors = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(copies, pa.int64()), pa.array(vectors, pa.binary())],
            names=["vec_id", "label", "copies", "vector"],
        )


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)


def principal_axes(vectors: DataFrame, axes: int = AXES) -> dict[int, np.ndarray]:
    """For each length of vectors the leading principal axes, from sums of products over all rows.
    One small matrix per task and length is gathered."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            by_size: dict[int, list[bytes]] = {}
            for vector in batch.column(0).to_pylist():
                by_size.setdefault(len(vector) // 8, []).append(vector)
            for size, own in by_size.items():
                rows = np.hstack([_matrix(own), np.ones((len(own), 1))])
                total[size] = total.get(size, 0) + rows.T @ rows
        for size, matrix in total.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(matrix.size, size)),
                    pa.array(np.arange(matrix.size)),
                    pa.array(matrix.reshape(-1)),
                ],
                names=["size", "cell", "total"],
            )

    added = (
        vectors.select("vector")
        .mapInArrow(sums, "size bigint, cell bigint, total double")
        .groupBy("size", "cell")
        .agg(F.sum("total").alias("total"))
        .orderBy("size", "cell")
        .toArrow()
    )
    sizes, totals = np.asarray(added["size"]), np.asarray(added["total"])
    result = {}
    for size in np.unique(sizes).tolist():
        m = totals[sizes == size].reshape(size + 1, size + 1)
        mean = m[-1, :-1] / m[-1, -1]
        _, axis = np.linalg.eigh(m[:-1, :-1] / m[-1, -1] - np.outer(mean, mean))
        result[size] = axis[:, ::-1][:, :axes].copy()
    return result


def _interval_rows(axes: dict[int, np.ndarray]):
    """Cut the vectors of a task, which come in grid order, into intervals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                # A new label or length begins an interval.
                if held and (
                    len(held) >= INTERVAL or held[-1][1] != row[1] or len(held[-1][3]) != len(row[3])
                ):
                    yield _interval(held, axes)
                    held = []
                held.append(row)
        if held:
            yield _interval(held, axes)

    return run


_INTERVAL = (
    "interval bigint, label bigint, size bigint, ids binary, copies binary, vectors binary, "
    "low array<double>, high array<double>"
)


def _interval(rows: list[tuple], axes: dict[int, np.ndarray]) -> pa.RecordBatch:
    ids, labels, copies, vectors = zip(*rows)
    matrix = _matrix(list(vectors))
    places = matrix @ axes[matrix.shape[1]]
    return pa.RecordBatch.from_pylist(
        [
            {
                "interval": min(ids),
                "label": labels[0],
                "size": matrix.shape[1],
                "ids": np.array(ids, np.int64).tobytes(),
                "copies": np.array(copies, np.int64).tobytes(),
                "vectors": matrix.tobytes(),
                "low": places.min(axis=0).tolist(),
                "high": places.max(axis=0).tolist(),
            }
        ],
        schema=pa.schema(
            [
                ("interval", pa.int64()),
                ("label", pa.int64()),
                ("size", pa.int64()),
                ("ids", pa.binary()),
                ("copies", pa.binary()),
                ("vectors", pa.binary()),
                ("low", pa.list_(pa.float64())),
                ("high", pa.list_(pa.float64())),
            ]
        ),
    )


class Joined:
    """What joining two intervals gives: links per vector and a forest over the linked ones."""

    def __init__(self, a, b, cosine: float, axes: np.ndarray) -> None:
        self.same = a[0] is b[0]
        self.ids, self.copies = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
        self.vectors = (a[2], b[2])
        self.places = (a[2] @ axes, b[2] @ axes)
        self.offset = len(a[0])
        self.cosine = cosine
        self.epsilon = np.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
        self.links = np.zeros(len(self.ids), np.int64)
        self.parent = np.arange(len(self.ids))
        self.run(0, len(a[0]), 0, len(b[0]))

    def root(self, at: int) -> int:
        parent = self.parent
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    def run(self, a: int, a_end: int, b: int, b_end: int) -> None:
        """Join two parts of the sequences: skip them if their boxes are apart, compare them if
        they are small, else join the halves of both."""
        if self.same and b_end <= a:
            return
        p, q = self.places[0][a:a_end], self.places[1][b:b_end]
        if not len(p) or not len(q):
            return
        gap = np.maximum(p.min(axis=0) - q.max(axis=0), q.min(axis=0) - p.max(axis=0))
        if (np.maximum(gap, 0) ** 2).sum() > self.epsilon**2:
            return
        if max(a_end - a, b_end - b) <= PART:
            self.compare(a, a_end, b, b_end)
            return
        a_half, b_half = (a + a_end) // 2, (b + b_end) // 2
        for i, i_end in ((a, a_half), (a_half, a_end)):
            for j, j_end in ((b, b_half), (b_half, b_end)):
                self.run(i, i_end, j, j_end)

    def compare(self, a: int, a_end: int, b: int, b_end: int) -> None:
        near = self.vectors[0][a:a_end] @ self.vectors[1][b:b_end].T >= self.cosine
        if self.same:
            near &= np.arange(a, a_end)[:, None] < np.arange(b, b_end)[None, :]
        if not near.any():
            return
        left = np.arange(a, a_end)
        right = np.arange(b, b_end) + (0 if self.same else self.offset)
        self.links[left] += near @ self.copies[right]
        self.links[right] += near.T @ self.copies[left]
        # One link for each row and column of the part joins what the part joins.
        for row in np.flatnonzero(near.any(axis=1)).tolist():
            columns = np.flatnonzero(near[row])
            self.join(left[row], right[columns])

    def join(self, one: int, others: np.ndarray) -> None:
        here = self.root(one)
        for other in others.tolist():
            if self.parent[other] == here:
                continue
            there = self.root(other)
            if here != there:
                if self.ids[there] < self.ids[here]:
                    here, there = there, here
                self.parent[there] = here

    def result(self) -> list[tuple[int, int, int]]:
        linked = np.flatnonzero(self.links)
        roots = [int(self.ids[self.root(at)]) for at in linked.tolist()]
        return list(zip(self.ids[linked].tolist(), self.links[linked].tolist(), roots))


_LINKS = "vec_id bigint, links bigint, root bigint"


def _pair_rows(axes: dict[int, np.ndarray], cosine: float):
    def side(batch: pa.RecordBatch, row: int, first: int):
        ids, copies, vectors = (batch.column(first + i)[row].as_py() for i in range(3))
        ids = np.frombuffer(ids, np.int64)
        return ids, np.frombuffer(copies, np.int64), np.frombuffer(vectors, np.float64).reshape(len(ids), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int]] = []
            for row in range(batch.num_rows):
                a = side(batch, row, 0)
                b = a if batch.column(3)[row].as_py() is None else side(batch, row, 3)
                rows += Joined(a, b, cosine, axes[a[2].shape[1]]).result()
            ids, links, roots = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(links, pa.int64()), pa.array(roots, pa.int64())],
                names=["vec_id", "links", "root"],
            )

    return run


def near_vectors(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``embeddings`` (vec_id, embedding, label; other columns are ignored):
    vec_id, n_links, component_id and kept.

    Vectors are compared where their labels are equal and not null and their lengths agree. Null,
    empty and zero vectors and those with null or non-finite components link with nothing, as do
    rows without vec_id. Equal vectors of a label are compared once and counted as often as they
    occur. Repeated ids count as so many vectors; they share the result of their id.
    """
    rows = require(embeddings, ["vec_id", "label", "embedding"])
    unit = stored(
        rows.select("vec_id", F.col("label").cast("bigint").alias("label"), "embedding").mapInArrow(_unit, _VECTOR),
        "unit-vectors",
    )
    distinct = unit.groupBy("label", "vector").agg(
        F.min("vec_id").alias("vec_id"), F.sum("copies").alias("copies")
    )
    distinct = stored(distinct.select("vec_id", "label", "copies", "vector"), "distinct-vectors")
    axes = principal_axes(distinct)
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * cosine)))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The grid cell of each vector along the axes, in front of its columns."""
        for batch in batches:
            vectors = batch.column(3).to_pylist()
            cell = [
                np.floor(np.frombuffer(v, np.float64) @ axes[len(v) // 8] / epsilon).astype(np.int64).tolist()
                for v in vectors
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.list_(pa.int64()))],
                names=["vec_id", "label", "copies", "vector", "cell"],
            )

    order = ["label", F.length("vector"), "cell", "vec_id"]
    placed = stored(distinct.mapInArrow(cells, _VECTOR + ", cell array<bigint>"), "cells")
    intervals = stored(
        placed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("vec_id", "label", "copies", "vector")
        .mapInArrow(_interval_rows(axes), _INTERVAL),
        "intervals",
    )

    # Boxes of a label meet where their first coordinates are within epsilon: each box stands at
    # the cells it covers, and on one side also at the neighbours.
    boxes = intervals.select("interval", "label", "size", "low", "high")
    first, last = F.floor(F.col("low")[0] / epsilon), F.floor(F.col("high")[0] / epsilon)
    one = boxes.select("*", F.explode(F.sequence(first - 1, last + 1)).alias("cell"))
    two = boxes.select(
        F.col("interval").alias("other"),
        "label",
        "size",
        F.col("low").alias("low_b"),
        F.col("high").alias("high_b"),
        F.explode(F.sequence(first, last)).alias("cell"),
    )
    gaps = F.zip_with(
        F.zip_with("low", "high_b", lambda a, b: a - b),
        F.zip_with("low_b", "high", lambda a, b: a - b),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    distance = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    pairs = (
        one.join(two, ["label", "size", "cell"])
        .filter((F.col("interval") <= F.col("other")) & (distance <= (epsilon + SLACK) ** 2))
        .select("interval", "other")
        .distinct()
    )
    body = intervals.select("interval", "ids", "copies", "vectors")
    other = intervals.select(
        F.col("interval").alias("other"), F.col("ids").alias("ids_b"), F.col("copies").alias("copies_b"), F.col("vectors").alias("vectors_b")
    )
    single = pairs.filter("interval = other").join(body, "interval")
    empty = F.lit(None).cast("binary")
    double = pairs.filter("interval != other").join(body, "interval").join(other, "other")
    both = double.select("ids", "copies", "vectors", "ids_b", "copies_b", "vectors_b").unionByName(
        single.select("ids", "copies", "vectors", empty.alias("ids_b"), empty.alias("copies_b"), empty.alias("vectors_b"))
    )
    found = stored(
        both.repartition(F.xxhash64("ids", "ids_b")).mapInArrow(_pair_rows(axes, cosine), _LINKS), "links"
    )

    # Copies share the links of the one that was compared, and link with each other.
    linked = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    known = (
        distinct.join(linked, "vec_id", "left")
        .join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "label",
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
            F.coalesce("component", "vec_id").alias("component"),
        )
    )
    result = (
        unit.select("vec_id", "label", "vector")
        .join(known, ["label", "vector"])
        .groupBy("vec_id")
        .agg(F.max("n").alias("n_links"), F.min("component").alias("component_id"))
    )
    return (
        rows.select("vec_id")
        .join(result, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
