"""Removal of byte strings that an earlier document already has.

A string of MATCH bytes holds an anchor: of its grams, the one with the least hash. Equal strings
choose the same anchor, so it is enough to compare the surroundings of equal anchors. Each task
builds the suffix order of the surroundings it got, and from it the longest-previous-factor array:
the nearest suffixes in order that belong to a smaller document, on either side, give the longest
match with anything earlier. Where it is MATCH bytes or more the later copy goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.common import (
    INVERSE,
    HashFilter,
    counted_hashes,
    discard,
    hash_filter,
    mix64,
    powers,
    prefix_sums,
    require,
    stored,
    text_bytes,
    text_slices,
)

MATCH = 50
GRAM = 24
REACH = MATCH - GRAM + 1  # grams in a string
BEFORE = REACH - 1  # bytes of surroundings before an anchor
# An anchor in more texts than this share of all occurrences, and than so many, is routed by the
# strings around it.
HOT_SHARE, HOT_LEAST = 1e-3, 20_000
BLOCK_ROWS = 20_000
# Bytes of text that anchors are looked for in at a time: arrays of a number per byte stay in cache.
ANCHOR_BYTES = 1 << 17


def _sliding(values: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """The best of each run of ``size`` values."""
    done, width = values, 1
    while width * 2 <= size:
        done = best(done[:-width], done[width:])
        width *= 2
    rest = size - width
    return best(done[: len(done) - rest], done[rest:]) if rest else done


def anchors(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of texts that lie end to end."""
    if len(raw) < MATCH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums, inverse = prefix_sums(raw), powers(INVERSE, len(raw) + 1)
    grams = mix64((sums[GRAM:] - sums[:-GRAM]) * inverse[: len(raw) - GRAM + 1])
    grams >>= np.uint64(1)  # 0 is left for no string
    grams += np.uint64(1)
    least = _sliding(grams, REACH, np.minimum)
    # A string must lie within one text.
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    least = np.where(np.arange(len(least)) + MATCH <= ends, least, np.uint64(0))
    edge = np.zeros(REACH - 1, np.uint64)
    chosen = _sliding(np.concatenate([edge, least, edge]), REACH, np.maximum) == grams
    places = np.flatnonzero(chosen)
    return places, grams[places].view(np.int64)


def _text_anchors(column: pa.Array) -> np.ndarray:
    """The anchors of texts, each once per text."""
    raw, offsets = text_bytes(column)
    places, grams = anchors(raw, offsets)
    text = np.searchsorted(offsets, places, side="right")
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    return grams[fresh]


@dataclass(frozen=True)
class Repeated:
    """Which anchors may occur in several texts, and which of them are hot."""

    anchors: HashFilter
    hot: np.ndarray


def repeated_anchors(texts: DataFrame) -> Repeated:
    """Count the texts of every anchor, over all documents. What is sent on is a filter of bounded
    size and the hot anchors, of which there are at most 1 / HOT_SHARE."""
    twice = stored(counted_hashes(texts, _text_anchors, "anchor", ANCHOR_BYTES).filter("count > 1"), "anchors")
    known, total = twice.agg(F.count(F.lit(1)), F.sum("count")).first()
    least = max(HOT_LEAST, int((total or 0) * HOT_SHARE))
    hot = twice.filter(F.col("count") > least).select("anchor").toArrow()["anchor"]
    return Repeated(
        hash_filter(twice.select("anchor"), known), np.sort(np.asarray(hot, dtype=np.int64))
    )


class Surroundings:
    """The surroundings of the repeated anchors of texts that lie end to end: of each the text,
    its first and last byte, the anchor, and the place, a hash of all that makes it equal to
    another."""

    def __init__(self, column: pa.Array, repeated: Repeated) -> None:
        raw, offsets = text_bytes(column)
        places, grams = anchors(raw, offsets)
        some = repeated.anchors.has(grams)
        places, grams = places[some], grams[some]
        text = np.searchsorted(offsets, places, side="right") - 1
        low = np.maximum(places - BEFORE, offsets[text])
        high = np.minimum(places + MATCH, offsets[text + 1])
        self.raw, self.offsets = raw, offsets
        self.text, self.low, self.high, self.anchor = text, low, high, grams
        lead = places - low
        sums, inverse = prefix_sums(raw), powers(INVERSE, len(raw) + 1)
        if len(repeated.hot) and len(places):
            lead = self._by_window(repeated.hot, lead, sums, inverse)
        low, high = self.low, self.high
        self.place = mix64(
            mix64((sums[high] - sums[low]) * inverse[low])
            + mix64(((high - low) * 64 + lead).astype(np.uint64))
            + self.anchor.view(np.uint64)
        ).view(np.int64)

    def _by_window(self, hot, lead, sums, inverse) -> np.ndarray:
        """Replace the surroundings of hot anchors by their strings of MATCH bytes, each with its
        own hash as anchor, so that different strings go to different tasks."""
        is_hot = hot[np.minimum(np.searchsorted(hot, self.anchor), len(hot) - 1)] == self.anchor
        cold = ~is_hot
        count = (self.high - self.low - MATCH + 1)[is_hot]
        skipped = np.repeat(np.cumsum(count) - count, count)
        begin = np.repeat(self.low[is_hot], count) + np.arange(count.sum()) - skipped
        own = mix64((sums[begin + MATCH] - sums[begin]) * inverse[begin] + np.uint64(1))
        self.text = np.concatenate([self.text[cold], np.repeat(self.text[is_hot], count)])
        self.low = np.concatenate([self.low[cold], begin])
        self.high = np.concatenate([self.high[cold], begin + MATCH])
        self.anchor = np.concatenate([self.anchor[cold], own.view(np.int64)])
        return np.concatenate([lead[cold], np.zeros(len(begin), np.int64)])


_PLACES = "doc bigint, print bigint, low int, high int, anchor bigint, place bigint"


def _place_rows(sent):
    """A row for each surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", ANCHOR_BYTES):
                found = Surroundings(part.column(1), sent.value)
                docs, prints = (np.asarray(part.column(i), dtype=np.int64) for i in (0, 2))
                begin = found.offsets[found.text]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs[found.text]),
                        pa.array(prints[found.text]),
                        pa.array(found.low - begin, pa.int32()),
                        pa.array(found.high - begin, pa.int32()),
                        pa.array(found.anchor),
                        pa.array(found.place),
                    ],
                    names=[field.split(" ")[0] for field in _PLACES.split(", ")],
                )

    return run


_BODIES = "anchor bigint, place bigint, doc bigint, body binary"


def _body_rows(sent):
    """The bytes of the surroundings whose anchor has others too, with the least doc of a batch. A
    task sends one again only where a later batch has a smaller doc."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, mixed = sent.value
        least: dict[int, int] = {}
        for batch in batches:
            parts, bodies = [], []
            for part in text_slices(batch, "text", ANCHOR_BYTES):
                found = Surroundings(part.column(1), repeated)
                docs = np.asarray(part.column(0), dtype=np.int64)[found.text]
                some = np.flatnonzero(mixed.has(found.anchor))
                some = some[np.lexsort((docs[some], found.place[some]))]
                place = found.place[some]
                some = some[np.append(True, place[1:] != place[:-1])[: len(some)]]
                blob = found.raw.tobytes()
                bodies += [blob[a:b] for a, b in zip(found.low[some].tolist(), found.high[some].tolist())]
                parts.append(np.stack([found.anchor[some], found.place[some], docs[some]]))
            if not bodies:
                continue
            anchor, place, doc = np.concatenate(parts, axis=1)
            order = np.lexsort((doc, place))
            order = order[np.append(True, place[order][1:] != place[order][:-1])[: len(order)]]
            new = []
            for at, name, own in zip(order.tolist(), place[order].tolist(), doc[order].tolist()):
                known = least.get(name)
                if known is None or own < known:
                    least[name] = own
                    new.append(at)
            order = np.array(new, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor[order]),
                    pa.array(place[order]),
                    pa.array(doc[order]),
                    pa.array([bodies[i] for i in order.tolist()], pa.binary()),
                ],
                names=["anchor", "place", "doc", "body"],
            )

    return run


def suffix_order(texts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes of padded texts (one per row) that begin at ``starts`` (row,
    column), by their first MATCH bytes, and the length of the common prefix of each with the one
    before in order, up to MATCH."""
    row, column = starts
    width = -(-MATCH // 8) * 8
    window = np.lib.stride_tricks.sliding_window_view(texts, width, axis=1)[row, column]
    window = window.copy()
    window[:, MATCH:] = 0
    keys = window.view(">u8").astype(np.uint64)
    order = np.lexsort(keys.T[::-1])
    same = window[order][1:] == window[order][:-1]
    differs = ~same
    common = np.zeros(len(order), np.int64)
    common[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), MATCH)
    return order, np.minimum(common, MATCH)


def previous_factors(value: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For suffixes in order, the longest common prefix with any suffix of a smaller value: that
    of the nearest smaller one before or after. Matches below MATCH are not followed up."""
    best = np.zeros(len(value), np.int64)
    for flip in (False, True):
        v = value[::-1] if flip else value
        # The common prefix with the neighbour on the side looked at.
        c = np.append(common[1:], 0)[::-1] if flip else common
        near, length = np.arange(len(v)) - 1, c.copy()
        while True:
            open_ = np.flatnonzero((near >= 0) & (length >= MATCH) & (v[near] >= v))
            if not len(open_):
                break
            over = near[open_]
            # What lies between a place and its nearest smaller one is not smaller than either.
            length[open_] = np.minimum(length[open_], length[over])
            near[open_] = near[over]
        found = np.where(near >= 0, length, 0)
        best = np.maximum(best, found[::-1] if flip else found)
    return best


def _covered(doc, bodies):
    """For each distinct surroundings of a block of whole anchor groups, the first and last string
    that a smaller document has; rows without one are left out."""
    sizes = np.array([len(body) for body in bodies])
    width = int(sizes.max()) + 8
    texts = np.zeros((len(bodies), width), np.uint8)
    flat = np.frombuffer(b"".join(bodies), np.uint8)
    inside = np.arange(width)[None, :] < sizes[:, None]
    texts[inside] = flat
    count = np.maximum(sizes - MATCH + 1, 0)
    row = np.repeat(np.arange(len(bodies)), count)
    column = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    # A string that occurs once here has no earlier copy and needs no place in the order.
    sums, inverse = prefix_sums(flat), powers(INVERSE, len(flat) + 1)
    begin = (np.cumsum(sizes) - sizes)[row] + column
    _, again, times = np.unique(
        (sums[begin + MATCH] - sums[begin]) * inverse[begin], return_inverse=True, return_counts=True
    )
    some = times[again.reshape(-1)] > 1
    row, column = row[some], column[some]
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    order, common = suffix_order(texts, (row, column))
    # Equal strings of different anchor groups may meet in a block; they match all the same.
    factor = np.zeros(len(order), np.int64)
    factor[order] = previous_factors(doc[row[order]], common)
    hit = factor >= MATCH
    if not hit.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = row[hit]
    begin = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    end = np.append(begin[1:], len(rows)) - 1
    return rows[begin], column[hit][begin], column[hit][end]


_FOUND = "place bigint, first int, last int"


def _factor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor and place. Rows of one place become one with the least doc as they
    stream by; blocks of whole anchor groups are then indexed."""

    def done(rows: list[tuple]) -> pa.RecordBatch:
        place, doc = (np.array([row[i] for row in rows], dtype=np.int64) for i in (1, 2))
        hit, first, last = _covered(doc, [row[3] for row in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array(place[hit]), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
            names=["place", "first", "last"],
        )

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if held and held[-1][:2] == row[:2]:
                if row[2] < held[-1][2]:
                    held[-1] = row
                continue
            if len(held) >= BLOCK_ROWS and held[-1][0] != row[0]:
                yield done(held)
                held = []
            held.append(row)
    if held:
        yield done(held)


def repeated_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, print, spans): for each document with something to remove its byte spans
    (low, high), which may overlap. ``documents`` has doc_id, text and print, a hash of the text.

    The surroundings of repeated anchors are numbered first, and each has a least document.
    Where all surroundings of an anchor are equal nothing more is needed; the bytes of the others
    go to the tasks that compare them.
    """
    spark = documents.sparkSession
    context = spark.sparkContext
    texts = documents.filter("doc_id is not null and text is not null")
    texts = texts.select("doc_id", "text", "print")
    repeated = repeated_anchors(texts)
    sent = context.broadcast(repeated)
    # Worked out again where needed: storing a row per place would take more than the texts do.
    places = texts.mapInArrow(_place_rows(sent), _PLACES)
    least = stored(
        places.groupBy("anchor", "place").agg(F.min("doc").alias("least")), "least-documents"
    )
    mixed = least.groupBy("anchor").count().filter("count > 1").select("anchor")
    both = context.broadcast((repeated, hash_filter(mixed, mixed.count())))
    found = stored(
        texts.mapInArrow(_body_rows(both), _BODIES)
        .repartition("anchor")
        .sortWithinPartitions("anchor", "place")
        .mapInArrow(_factor_rows, _FOUND),
        "matches",
    )
    both.destroy()
    known = least.select("place", "least").join(found, "place", "left")
    earlier = F.col("doc") > F.col("least")
    covered = (
        places.select("doc", "print", "low", "high", "place")
        .join(known, "place")
        .filter(earlier | F.col("first").isNotNull())
        .select(
            F.col("doc").alias("doc_id"),
            "print",
            F.when(earlier, F.col("low")).otherwise(F.col("low") + F.col("first")).alias("low"),
            F.when(earlier, F.col("high"))
            .otherwise(F.col("low") + F.col("last") + MATCH)
            .alias("high"),
        )
    )
    spans = stored(
        covered.groupBy("doc_id", "print").agg(F.collect_set(F.struct("low", "high")).alias("spans")),
        "spans",
    )
    sent.destroy()
    discard(least, found)
    return spans


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            rows = []
            for doc_id, text, spans in zip(*(part.column(i).to_pylist() for i in range(3))):
                raw = (text or "").encode("utf-8", "surrogatepass")
                merged: list[list[int]] = []
                for low, high in sorted((s["low"], s["high"]) for s in spans or ()):
                    if merged and low <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], high)
                    else:
                        merged.append([low, high])
                parts, at = [], 0
                for low, high in merged:
                    parts.append(raw[at:low])
                    at = high
                kept = b"".join([*parts, raw[at:]])
                rows.append((doc_id, len(raw), [{"low": a, "high": b} for a, b in merged], kept))
            ids, sizes, spans, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "spans", "kept_sha256", "kept"],
            )


_RESULT = "doc_id bigint, n_bytes bigint, spans array<struct<low:int,high:int>>, kept_sha256 string, kept binary"


def remove_repeats(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text; other columns are ignored): n_bytes, the
    removed spans in bytes, the remaining bytes and their digest.

    A byte goes if a string of MATCH bytes that covers it also starts in a document with a smaller
    doc_id. A null text is empty. A row without doc_id is kept whole and removes nothing; rows of
    one doc_id do not remove from each other. Texts shorter than MATCH are kept whole.
    """
    rows = require(documents, ["doc_id", "text"]).withColumn("print", F.xxhash64("text"))
    spans = repeated_spans(rows)
    return (
        rows.join(spans, ["doc_id", "print"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_cut, _RESULT)
    )


def repeat_digest(removed: DataFrame) -> DataFrame:
    count = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["high"] - s["low"])
    return removed.select(
        "doc_id",
        "n_bytes",
        count.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        "kept_sha256",
    )
