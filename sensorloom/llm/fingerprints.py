"""Document fingerprints by consistent weighted sampling.

A text is a set of weighted terms: its shingles of five words, by how often they occur, and its
words, by a quarter of that. For each of a fingerprint's samples a term draws, from its own hash,
r and c from Gamma(2, 1) and b from [0, 1). With weight S it has the level t = floor(ln S / r + b)
and the value ln c - r (t - b) - r; the sample is the term of least value with its level. Two
fingerprints then agree in a sample with a probability that is the generalised Jaccard similarity
of the weights, the sum of the lesser over the sum of the greater weights.

For the query every text is also compared with the next document and with an edited text that ends
like it. Rows are sorted over all partitions, so the next document is the next row; only the last
row of a partition and the first of the next are brought together in a second step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.common import lower_ascii, mix64, require, span_hashes, stored, text_bytes, text_slices

SAMPLES, WORDS, WORD_WEIGHT = 64, 5, 0.25
# Terms whose draws are held at a time, and texts of a slice.
TERMS, TEXTS = 1024, 1 << 15
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_SPACE = np.isin(np.arange(256), SPACES)
# A term is 47 bits of a hash and one that tells words from shingles; above them stands the number
# of its text, so that one sort brings the terms of each text together.
_BITS = np.uint64(48)
_TERM = (np.uint64(1) << _BITS) - np.uint64(1)


@dataclass(frozen=True)
class Terms:
    """The distinct terms of texts as sorted keys, the text's number above the term, with their
    weights."""

    keys: np.ndarray
    weights: np.ndarray


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, A-Z in lower case, and where each text's begin."""
    raw, offsets = text_bytes(column)
    inside = np.concatenate([[False], ~_IS_SPACE[raw], [False]])
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    edge = (inside[1:] != inside[:-1]) | (border & inside[1:] & inside[:-1])
    starts, ends = np.flatnonzero(edge & inside[1:]), np.flatnonzero(edge & inside[:-1])
    return span_hashes(lower_ascii(raw), starts, ends), np.searchsorted(starts, offsets)


def weighted_terms(column: pa.Array, words: int = WORDS, word_weight: float = WORD_WEIGHT) -> Terms:
    """The terms of a column of at most ``TEXTS`` texts. A text of fewer words than a shingle has the
    whole sequence as its shingle; one without words, and a null, has no terms."""
    hashes, first = _words(column)
    counts = np.diff(first)
    sizes = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
    text = np.repeat(np.arange(len(counts)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[text]
    end = first[text + 1]
    shingle = np.zeros(len(at), np.uint64)
    padded = np.append(hashes + np.uint64(1), np.zeros(words, np.uint64))
    for step in range(words):
        # Behind the last word of a short text stands nothing.
        word = padded[at + step]
        word[at + step >= end] = 0
        shingle *= _FACTOR
        shingle += word
    both = np.append(mix64(shingle) >> np.uint64(16) & ~np.uint64(1), mix64(hashes) >> np.uint64(16) | np.uint64(1))
    text = np.append(text, np.repeat(np.arange(len(counts)), counts)).astype(np.uint64)
    keys = np.sort(text << _BITS | both)
    fresh = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    keys, times = keys[fresh], np.diff(fresh, append=len(keys))
    return Terms(keys, np.where(keys & np.uint64(1) == 1, word_weight, 1.0) * times)


class Draws:
    """r, b and ln c for blocks of terms and all samples, in buffers that are used again.

    A term and the number of a sample make 32 bits, which are mixed anew for c and for b. Sixteen
    bits make an exponential draw, and two of those a draw from Gamma(2, 1)."""

    _UNIT = np.float32(-32 * np.log(2))

    def __init__(self, samples: int, terms: int) -> None:
        rng = mix64(np.arange(1, 2 * samples + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
        self.low, self.high = rng[:samples, None], rng[samples:, None]
        self.bits, self.more, self.half = (np.empty((samples, terms), np.uint32) for _ in range(3))
        self.r, self.b, self.log_c, self.other = (np.empty((samples, terms), np.float32) for _ in range(4))

    @staticmethod
    def _mix(x: np.ndarray, spare: np.ndarray, factor: int) -> None:
        for shift, by in ((16, factor), (15, 0x846CA68B)):
            np.right_shift(x, np.uint32(shift), out=spare)
            np.bitwise_xor(x, spare, out=x)
            np.multiply(x, np.uint32(by), out=x)
        np.right_shift(x, np.uint32(16), out=spare)
        np.bitwise_xor(x, spare, out=x)

    @staticmethod
    def _centred(half: np.ndarray, out: np.ndarray) -> None:
        """Numbers of 16 bits plus a half, exactly: as the last bits of a float from 2 ** 23 on, which
        takes no conversion."""
        np.bitwise_or(half, np.uint32(0x4B000000), out=half)
        np.subtract(half.view(np.float32), np.float32(2**23 - 0.5), out=out)

    def _gamma(self, bits: np.ndarray, half: np.ndarray, out: np.ndarray, other: np.ndarray) -> None:
        """-ln(u v) for the two halves u and v of the bits."""
        np.bitwise_and(bits, np.uint32(0xFFFF), out=half)
        self._centred(half, out)
        np.right_shift(bits, np.uint32(16), out=half)
        self._centred(half, other)
        np.multiply(out, other, out=out)
        np.log(out, out=out)
        np.add(out, self._UNIT, out=out)
        np.negative(out, out=out)

    def draw(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ln c, r and b. ``low`` and ``high`` are the halves of the hashes of terms, a row of terms
        for all samples or a row for each sample."""
        n = low.shape[-1]
        bits, more, half = self.bits[:, :n], self.more[:, :n], self.half[:, :n]
        r, b, log_c, other = self.r[:, :n], self.b[:, :n], self.log_c[:, :n], self.other[:, :n]
        np.multiply(low, self.low, out=bits)
        np.multiply(high, self.high, out=more)
        np.add(bits, more, out=bits)
        self._mix(bits, more, 0x7FEB352D)
        self._gamma(bits, half, r, other)
        self._mix(bits, more, 0x2C1B3C6D)
        self._gamma(bits, half, log_c, other)
        np.log(log_c, out=log_c)
        np.multiply(bits, np.uint32(0x9E3779B1), out=bits)
        np.right_shift(bits, np.uint32(8), out=bits)
        np.copyto(b, bits.view(np.int32), casting="same_kind")
        np.multiply(b, np.float32(2.0**-24), out=b)
        return log_c, r, b


def _values(log_c: np.ndarray, r: np.ndarray, b: np.ndarray, log_weight: np.ndarray) -> np.ndarray:
    """ln c - r (t - b) - r with the level t of the weight."""
    out = log_weight / r
    out += b
    np.floor(out, out=out)
    out -= b
    out += np.float32(1)
    out *= r
    return np.subtract(log_c, out, out=out)


_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.iinfo(np.int64).max


def _ordered(values: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Values as integers of the same order, with the numbers of their terms behind."""
    bits = values.view(np.int32)
    bits ^= (bits >> 31) & np.int32(0x7FFFFFFF)
    keys = bits.astype(np.int64)
    keys <<= 32
    keys |= terms
    return keys


def signatures(keys: np.ndarray, texts: int, *weightings: np.ndarray, samples: int = SAMPLES) -> list[np.ndarray]:
    """For each weighting of the same terms, given as the keys of ``Terms``, the samples of each text
    as 16-bit numbers, a row per text. Terms of weight 0 take no part; a text without terms has
    zeros. Terms are worked on in blocks of bounded size, however long a text is."""
    best = [np.full((samples, texts), _NONE) for _ in weightings]
    usual = np.max(weightings, axis=0)
    starts = np.searchsorted(keys, np.arange(texts + 1, dtype=np.uint64) << _BITS)
    hashes = mix64(keys & _TERM)
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    log = [np.log(np.where(w > 0, w, 1)).astype(np.float32) for w in (usual, *weightings)]
    away = [np.where(w > 0, -_NONE, _NONE) for w in weightings]
    other = [(w > 0) & (w != usual) for w in weightings]
    draws = Draws(samples, TERMS)
    for start in range(0, len(keys), TERMS):
        part = slice(start, min(start + TERMS, len(keys)))
        drawn = draws.draw(low[part], high[part])
        first, last = np.searchsorted(starts, [start, part.stop - 1], side="right") - 1
        filled = np.flatnonzero(starts[first : last + 1] < starts[first + 1 : last + 2]) + first
        begins = np.maximum(starts[filled], start) - start
        # Most texts have terms: those of a block mostly follow each other.
        there = slice(filled[0], filled[-1] + 1) if filled[-1] - filled[0] < len(filled) else filled
        # Most terms have one weight in all weightings that have them.
        ordered = _ordered(_values(*drawn, log[0][part]), np.arange(start, part.stop))
        for least, log_weight, gone, differs in zip(best, log[1:], away, other):
            mine = np.maximum(ordered, gone[part])
            at = np.flatnonzero(differs[part])
            if len(at):
                own = _values(*(each[:, at] for each in drawn), log_weight[part][at])
                mine[:, at] = _ordered(own, at + start)
            found = np.minimum.reduceat(mine, begins, axis=1)
            least[:, there] = np.minimum(least[:, there], found, out=found)
    return [_codes(hashes, least, log_weight) for least, log_weight in zip(best, log[1:])]


def _codes(hashes: np.ndarray, least: np.ndarray, log_weight: np.ndarray) -> np.ndarray:
    """The terms of least value with their levels as 16-bit numbers."""
    samples, texts = least.shape
    if not len(hashes):
        return np.zeros((texts, samples), np.uint16)
    there = least != _NONE
    term = np.where(there, least & 0xFFFFFFFF, 0)
    own, draws = hashes[term], Draws(samples, texts)
    _, r, b = draws.draw(own.astype(np.uint32), (own >> np.uint64(32)).astype(np.uint32))
    level = np.floor(log_weight[term] / r + b).astype(np.int64).view(np.uint64)
    codes = mix64(own ^ (level * _FACTOR)) >> np.uint64(48)
    return np.ascontiguousarray(np.where(there, codes, 0).astype(np.uint16).T)


def _both(one: Terms, other: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms that either of two lists of texts has, text by text, with both weights."""
    keys = np.sort(np.append(one.keys, other.keys))
    keys = keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]
    weights = np.zeros((2, len(keys)))
    for each, row in zip((one, other), weights):
        row[np.searchsorted(keys, each.keys)] = each.weights
    return keys, weights[0], weights[1]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of samples in which the fingerprints of two lists of texts agree."""
    return (a == b).mean(axis=-1)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of a bounded number of bytes and of texts."""
    for part in text_slices(batch, "text"):
        for start in range(0, part.num_rows, TEXTS):
            yield part.slice(start, TEXTS)


def _pack(codes: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in codes.astype(">u2")]


def fingerprint_documents(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint): the samples of every whole text, two bytes each.

    Equal texts have equal fingerprints; null, empty and blank texts have one of zeros. Repeated
    rows and null ids give a row each; columns besides doc_id and text are ignored. Nothing is
    shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                terms = weighted_terms(part.column(1))
                (codes,) = signatures(terms.keys, part.num_rows, terms.weights, samples=samples)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(_pack(codes), pa.binary())],
                    names=["doc_id", "fingerprint"],
                )

    return require(documents, ["doc_id", "text"]).mapInArrow(run, "doc_id bigint, fingerprint binary")


@dataclass
class Row:
    """A text on its way to a result: what is known before its successor's fingerprint is."""

    doc_id: int | None
    text: str
    edited_sha256: str = ""
    own: np.ndarray | None = None
    edited: np.ndarray | None = None


def edited_text(text: str, following: str) -> str:
    """The text with its last third of code points replaced by as many first ones of another."""
    changed = len(text) // 3
    return text[: len(text) - changed] + following[:changed]


def _sample(rows: list[Row], following: list[str], samples: int) -> None:
    """Fill in the fingerprints of texts and of the texts edited with what follows."""
    others = [edited_text(row.text, text) for row, text in zip(rows, following)]
    one, other = (weighted_terms(pa.array(t, pa.large_string())) for t in ([r.text for r in rows], others))
    keys, *weights = _both(one, other)
    own, edited = signatures(keys, len(rows), *weights, samples=samples)
    for i, row in enumerate(rows):
        row.edited_sha256 = hashlib.sha256(others[i].encode()).hexdigest()
        row.own, row.edited = own[i], edited[i]


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
_EDGES = "part int, first boolean, text string"
_NAMES = [field.split(" ")[0] for field in RESULT.split(", ")]


def _results(rows: list[Row], after: list[np.ndarray]) -> dict[str, pa.Array]:
    own, edited = np.array([row.own for row in rows]), np.array([row.edited for row in rows])
    return {
        "doc_id": pa.array([row.doc_id for row in rows], pa.int64()),
        "n_chars": pa.array([len(row.text) for row in rows], pa.int64()),
        "edited_sha256": pa.array([row.edited_sha256 for row in rows], pa.string()),
        "fingerprint": pa.array(_pack(own), pa.binary()),
        "edited_fingerprint": pa.array(_pack(edited), pa.binary()),
        "near_edited": pa.array(likeness(own, edited)),
        "near_next": pa.array(likeness(own, np.array(after))),
    }


def _walk(batches: Iterator[pa.RecordBatch], samples: int) -> Iterator[pa.RecordBatch]:
    """Results for the sorted rows of a partition but the last, and its first and last as they
    are. ``held`` has no text after it yet, ``open_`` no fingerprint."""
    part = TaskContext.get().partitionId()
    types = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string())]
        + [("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary())]
        + [("near_edited", pa.float64()), ("near_next", pa.float64())]
        + [("part", pa.int32()), ("first", pa.bool_()), ("text", pa.string())]
    )

    def batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
        rows = len(columns["doc_id"])
        return pa.RecordBatch.from_arrays(
            [columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in types], schema=types
        )

    def edge(row: Row, first: bool) -> pa.RecordBatch:
        values = {"doc_id": row.doc_id, "part": part, "first": first, "text": row.text}
        return batch({name: pa.array([value], types.field(name).type) for name, value in values.items()})

    held: Row | None = None
    open_: Row | None = None
    for given in batches:
        for piece in slices(given):
            rows = [Row(i, t or "") for i, t in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist())]
            if held is None:
                yield edge(rows[0], True)
            rows = rows if held is None else [held, *rows]
            held = rows.pop()
            if rows:
                _sample(rows, [row.text for row in [*rows[1:], held]], samples)
                ready = rows if open_ is None else [open_, *rows]
                open_ = ready[-1]
                if len(ready) > 1:
                    yield batch(_results(ready[:-1], [row.own for row in ready[1:]]))
    if open_ is not None:
        terms = weighted_terms(pa.array([held.text], pa.large_string()))
        after = signatures(terms.keys, 1, terms.weights, samples=samples)[0]
        yield batch(_results([open_], list(after)))
    if held is not None:
        yield edge(held, False)


def edit_and_compare(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text; other columns are ignored): its fingerprint,
    that of the text edited with the next document, and how much both are like the own one.

    The next document is that of the next smaller doc_id; after the last comes the first. Rows
    without an id come last; of equal ids the order is that of a hash of the text, and rows that
    are alike follow each other. A null text is empty. A table of one row has itself as the next.
    Two texts without words are alike; a text without words is like no other.
    """
    keyed = require(documents, ["doc_id", "text"]).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.desc_nulls_last("doc_id"), F.asc("hash"), F.asc("row")]
    in_order = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    walked = stored(in_order.mapInArrow(lambda b: _walk(b, samples), f"{RESULT}, {_EDGES}"), "fingerprints")

    # A list of the partitions that have rows; their numbers are in the order of the ids.
    edges = walked.filter("part is not null")
    parts = sorted(row["part"] for row in edges.select("part").distinct().collect())
    follows = documents.sparkSession.createDataFrame(
        list(zip(parts, [*parts[1:], *parts[:1]])), "part int, next_part int"
    )
    heads = edges.filter("first").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    last = edges.filter("not first").select("doc_id", "text", "part")
    pairs = last.join(follows, "part").join(heads, "next_part").select("doc_id", "text", "next_text")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text, following in zip(*(column.to_pylist() for column in batch.columns)):
                row, after = Row(doc_id, text), Row(None, following)
                _sample([row], [following], samples)
                _sample([after], [""], samples)
                columns = _results([row], [after.own])
                yield pa.RecordBatch.from_arrays([columns[name] for name in _NAMES], names=_NAMES)

    closed = pairs.mapInArrow(close, RESULT)
    return walked.filter("part is null").select(*_NAMES).unionByName(closed)


def fingerprint_digest(compared: DataFrame) -> DataFrame:
    """The same rows with fingerprints in lowercase hexadecimal."""
    written = {name: F.lower(F.hex(name)) for name in ("fingerprint", "edited_fingerprint")}
    return compared.withColumns(written)
