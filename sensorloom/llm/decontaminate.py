"""Benchmark decontamination by an FM-index per shard of training documents.

A shard is a run of documents inside a task. Its words become symbols, and words that no benchmark
item holds become one symbol that no phrase contains. The shard is indexed (suffix order,
Burrows-Wheeler transform, wavelet matrix, sampled suffix positions), all phrases are searched
backward at once, and the places found are merged to spans of words.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from sensorloom.llm.common import (
    BASE,
    lower_ascii,
    mix64,
    require,
    span_hashes,
    stored,
    text_bytes,
    text_slices,
)

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 13
# A shard closes at so many symbols or rows; so many bytes of benchmark text are searched for at a time.
SHARD_SYMBOLS, SHARD_ROWS = 1 << 20, 20_000
BLOCK_BYTES = 20 << 20
SAMPLE = 4
END, OTHER = 0, 1


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


IS_WORD = np.array([c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A for c in range(256)])
ONE_END, NO_WORD = np.zeros(1, np.int64), np.full(1, -1)


def _text_edges(inside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Borders between two texts that both have a word character there."""
    border = np.zeros(len(inside) - 1, bool)
    border[offsets] = True
    return border & inside[1:] & inside[:-1]


class Phrases:
    """The distinct windows of a block of benchmark items, shortest first, with the items that hold
    each. The words of all items are one array of symbols, a window is a place in it, and owners are
    numbers behind offsets, so that a block takes a few times the bytes of its texts. Windows are
    told apart by 64-bit hashes."""

    def __init__(self, items: Iterable[tuple[int, str | None]], window: int = WINDOW) -> None:
        self.symbols: dict[bytes, int] = {}
        parts, names = [], []
        for item_id, text in items:
            row = [self.symbols.setdefault(w, len(self.symbols) + 2) for w in words_of(text)]
            parts.append(np.array(row, np.int32))
            names.append(str(item_id))
        self.words = np.concatenate([np.zeros(0, np.int32), *parts])
        counts = np.array([len(part) for part in parts], np.int64)
        self.names = sorted(set(names))
        number = {name: i for i, name in enumerate(self.names)}
        self._windows(counts, np.array([number[name] for name in names], np.int32), window)

        words = list(self.symbols)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(word) for word in words], dtype=np.int64)
        starts = ends - np.array([len(word) for word in words], np.int64)
        hashes = span_hashes(raw, starts, ends)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order + 2

    def _windows(self, counts: np.ndarray, owner_of: np.ndarray, window: int) -> None:
        sizes = np.minimum(counts, window)
        windows = np.where(counts > 0, counts - sizes + 1, 0)
        item = np.repeat(np.arange(len(counts), dtype=np.int32), windows)
        first = (np.cumsum(counts) - counts)[item]
        start = (first + np.arange(len(item)) - (np.cumsum(windows) - windows)[item]).astype(np.int32)
        size = sizes[item].astype(np.int32)
        value = size.astype(np.uint64)
        for step in range(int(size.max(initial=0))):
            inside = step < size
            word = self.words[np.where(inside, start + step, 0)].astype(np.uint64) * inside.astype(np.uint64)
            value *= np.uint64(BASE)
            value += word
        value = mix64(value)
        order = np.lexsort((owner_of[item], value, size))
        value, size, start, owner = value[order], size[order], start[order], owner_of[item][order]
        new = np.append(True, (value[1:] != value[:-1]) | (size[1:] != size[:-1]))[: len(value)]
        fresh = new | np.append(True, owner[1:] != owner[:-1])[: len(value)]
        self.starts, self.lengths = start[new], size[new].astype(np.int64)
        # The owners of phrase i are those from offsets[i] to offsets[i + 1].
        self.owned = owner[fresh].astype(np.int32)
        self.offsets = np.append(np.flatnonzero(new[fresh]), len(self.owned))

    def __len__(self) -> int:
        return len(self.lengths)

    def owners(self, phrase: int) -> list[str]:
        """The items that hold a phrase."""
        return [self.names[i] for i in self.owned[self.offsets[phrase] : self.offsets[phrase + 1]]]

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The symbols of words given by their hashes; OTHER where no item has the word."""
        if not len(self.hashes):
            return np.full(len(hashes), OTHER)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], OTHER)

    def groups(self, most: int = 1 << 16) -> Iterator[tuple[int, np.ndarray]]:
        """(index of the first phrase, symbols of phrases of one length, at most ``most``)."""
        for size in np.unique(self.lengths).tolist():
            low, high = np.searchsorted(self.lengths, [size, size + 1])
            for first in range(low, high, most):
                starts = self.starts[first : min(first + most, high), None]
                yield first, self.words[starts + np.arange(size)].astype(np.int64)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``text`` in order, by doubling the sorted length. The
    first keys hold as many symbols as fit into 62 bits; later steps sort only what is tied."""
    size = len(text)
    bits = int(text.max() + 1).bit_length() if size else 1
    packed = max(1, min(62 // bits, size))
    key = np.zeros(size, np.int64)
    for at in range(packed):
        key <<= bits
        key[: size - at] |= text[at:] + 1  # 0 is behind the end
    order = np.argsort(key)
    sorted_key = key[order]
    fresh = np.ones(size, bool)
    fresh[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(size, np.int64)
    heads = np.maximum.accumulate(np.where(fresh, np.arange(size), 0))
    rank[order] = heads
    length = packed
    while True:
        tied = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))
        if not len(tied) or length >= size:
            return order
        suffix = order[tied]
        behind = suffix + length
        second = np.where(behind < size, rank[np.minimum(behind, size - 1)] + 1, 0)
        both = heads[tied] * (size + 1) + second
        again = np.argsort(both)
        both = both[again]
        order[tied] = suffix[again]
        new = np.ones(len(tied), bool)
        new[1:] = both[1:] != both[:-1]
        fresh[tied] = new
        heads[tied] = np.maximum.accumulate(np.where(new, tied, 0))
        rank[order[tied]] = heads[tied]
        length *= 2


class FMIndex:
    """Backward search over a text of symbols whose last symbol is END."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        order = suffix_order(text)
        self.size = len(text)
        transform = text[order - 1]
        self.less = np.zeros(symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols), out=self.less[1:])
        # Wavelet matrix: for each bit from the highest, how many zeros stand before each place.
        self.bits = max(1, int(symbols - 1).bit_length())
        self.zeros = np.zeros((self.bits, self.size + 1), np.int32)
        current = transform
        for level in range(self.bits):
            is_zero = (current >> (self.bits - 1 - level)) & 1 == 0
            np.cumsum(is_zero, out=self.zeros[level, 1:])
            current = np.concatenate([current[is_zero], current[~is_zero]])
        # Positions kept: every SAMPLE-th of the text, found by how many stand before a row.
        # The first symbol of a document is one of them, so that no step crosses an END.
        self.kept = (order % SAMPLE == 0) | (transform == END)
        self.kept_before = np.zeros(self.size + 1, np.int32)
        np.cumsum(self.kept, out=self.kept_before[1:])
        self.positions = order[self.kept]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each place."""
        low, high = np.zeros_like(at), at
        for level in range(self.bits):
            zeros = self.zeros[level]
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            low_zeros, high_zeros, all_zeros = zeros[low], zeros[high], zeros[-1]
            low = np.where(one, all_zeros + low - low_zeros, low_zeros)
            high = np.where(one, all_zeros + high - high_zeros, high_zeros)
        return high - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase (a row of symbols) the interval of suffixes that begin with it."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            base = self.less[symbol]
            low[alive] = base + self.rank(symbol, low[alive])
            high[alive] = base + self.rank(symbol, high[alive])
            gone = low[alive] >= high[alive]
            alive = alive[~gone]
            if not len(alive):
                break
        return low, np.maximum(low, high)

    def step_back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one symbol earlier."""
        at, low, symbol = row, np.zeros_like(row), np.zeros_like(row)
        for level in range(self.bits):
            zeros = self.zeros[level]
            zero = zeros[at + 1] > zeros[at]
            symbol = symbol * 2 + ~zero
            all_zeros = zeros[-1]
            at, low = (
                np.where(zero, zeros[at], all_zeros + at - zeros[at]),
                np.where(zero, zeros[low], all_zeros + low - zeros[low]),
            )
        return self.less[symbol] + at - low

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps back until a sampled one is met."""
        position = np.zeros(len(rows), np.int64)
        open_, row, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(open_):
            found = self.kept[row]
            position[open_[found]] = self.positions[self.kept_before[row[found]]] + steps
            open_, row = open_[~found], self.step_back(row[~found])
            steps += 1
        return position


class Shard:
    """Documents gathered for one index. A document longer than a shard is indexed in pieces that
    share all but one word of a window, so that every window lies in some piece."""

    def __init__(self, phrases: Phrases) -> None:
        self.phrases = phrases
        self.texts: list[np.ndarray] = []
        self.word_at: list[np.ndarray] = []
        self.owner: list[tuple[int, int]] = []  # document, symbols
        self.counts: list[int] = []
        self.size = 0

    def add(self, column: pa.Array) -> None:
        """Take in the texts of a column."""
        raw, offsets = text_bytes(column)
        raw = lower_ascii(raw)
        inside = np.concatenate([[False], IS_WORD[raw], [False]])
        edges = inside[1:] != inside[:-1]
        # A word ends where its text does.
        edges = edges | _text_edges(inside, offsets)
        starts = np.flatnonzero(edges & inside[1:])
        ends = np.flatnonzero(edges & inside[:-1])
        symbols = self.phrases.lookup(span_hashes(raw, starts, ends))
        word_at = np.searchsorted(starts, offsets)
        self._add_words(symbols, word_at)

    def _add_words(self, symbols: np.ndarray, word_at: np.ndarray) -> None:
        first = np.zeros(len(symbols) + 1, bool)
        first[word_at] = True
        first = first[:-1]
        # Only runs of item words as long as the shortest phrase can hold one. The rest of the
        # words is one symbol between such runs.
        known = symbols != OTHER
        change = np.flatnonzero(first | np.append(True, known[1:] != known[:-1])[: len(symbols)])
        length = np.diff(np.append(change, len(symbols)))
        shortest = int(self.phrases.lengths.min(initial=WINDOW))
        known &= np.repeat(length >= shortest, length)
        symbols = np.where(known, symbols, OTHER)
        keep = known | np.append(False, known[:-1])
        places = np.flatnonzero(keep)
        symbols = symbols[places]
        bounds = np.searchsorted(places, word_at)
        longest = int(self.phrases.lengths.max(initial=1))
        counts = np.diff(word_at).tolist()
        for at, count in enumerate(counts):
            document = len(self.counts)
            self.counts.append(count)
            low, high = bounds[at], bounds[at + 1]
            while low < high:
                end = min(low + SHARD_SYMBOLS, high)
                self.texts += [symbols[low:end], ONE_END]
                self.word_at += [places[low:end] - word_at[at], NO_WORD]
                self.owner.append((document, end - low + 1))
                self.size += end - low + 1
                low = end if end == high else end - (longest - 1)

    def results(self) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """For each document: its words, the merged spans of hit words, the items found."""
        spans: list[list[tuple[int, int]]] = [[] for _ in self.counts]
        items: list[set[str]] = [set() for _ in self.counts]
        if self.size and len(self.phrases):
            text = np.concatenate(self.texts)
            word_at = np.concatenate(self.word_at)
            ends = np.cumsum([n for _, n in self.owner])
            documents = np.array([d for d, _ in self.owner])
            index = FMIndex(text, len(self.phrases.symbols) + 2)
            hits = []
            for first, group in self.phrases.groups():
                low, high = index.search(group)
                some = np.flatnonzero(high > low)
                if not len(some):
                    continue
                count = (high - low)[some]
                rows = np.repeat(low[some] - np.cumsum(count) + count, count) + np.arange(count.sum())
                position = index.locate(rows)
                phrase = np.repeat(some + first, count)
                document = documents[np.searchsorted(ends, position, side="right")]
                start = word_at[position]
                hits.append(np.stack([document, start, start + group.shape[1], phrase]))
            if hits:
                found = np.concatenate(hits, axis=1)
                found = found[:, np.lexsort((found[1], found[0]))]
                for document, start, end in zip(*found[:3].tolist()):
                    own = spans[document]
                    if own and start <= own[-1][1]:
                        own[-1] = (own[-1][0], max(end, own[-1][1]))
                    else:
                        own.append((start, end))
                pairs = np.unique(found[0] * len(self.phrases) + found[3])
                for pair in pairs.tolist():
                    document, phrase = divmod(pair, len(self.phrases))
                    items[document].update(self.phrases.owners(phrase))
        return [(n, s, sorted(i)) for n, s, i in zip(self.counts, spans, items)]


SCHEMA = "doc_id bigint, row bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row", pa.int64()),
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def _search(phrases_of: Callable[[], Phrases]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = phrases_of()

        def closed(shard: Shard, ids: list, numbers: list) -> pa.RecordBatch:
            rows = [
                {"doc_id": i, "row": r, "n_words": n, "spans": [{"start": a, "end": b} for a, b in s], "items": t}
                for i, r, (n, s, t) in zip(ids, numbers, shard.results())
            ]
            return pa.RecordBatch.from_pylist(rows, schema=_ARROW)

        shard, ids, numbers = Shard(phrases), [], []
        for batch in batches:
            for part in text_slices(batch, "text"):
                shard.add(part.column(1))
                ids += part.column(0).to_pylist()
                numbers += part.column(2).to_pylist()
                if shard.size >= SHARD_SYMBOLS or len(ids) >= SHARD_ROWS:
                    yield closed(shard, ids, numbers)
                    shard, ids, numbers = Shard(phrases), [], []
        if ids:
            yield closed(shard, ids, numbers)

    return run


def benchmark_blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list]:
    """The items in blocks of about ``most`` bytes, read one partition at a time; usually one."""
    block, size = [], 0
    for row in require(benchmark, ["item_id", "text"]).toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"] or "")
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_benchmark(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_words, the merged spans (array of start and end
    word) that the windows of benchmark items cover, and the items found.

    Both tables need doc_id or item_id, and text; other columns are ignored. A null or empty text
    has no words. An item of fewer words than a window is one window; an item without words is
    never found. Null ids and repeated rows give a row each. The benchmark is a query set: it is
    sent to the tasks in blocks of bounded size, and every block is searched for in all documents.
    One block needs no shuffle; the results of several are merged by row.
    """
    spark = documents.sparkSession
    rows = require(documents, ["doc_id", "text"])
    blocks = benchmark_blocks(benchmark, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        sent = spark.sparkContext.broadcast(first)
        return (
            rows.withColumn("row", F.lit(0).cast(LongType()))
            .mapInArrow(_search(_cached(sent, window)), SCHEMA)
            .drop("row")
        )
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "documents")
    parts = None
    for block in chain((first, second), blocks):
        sent = spark.sparkContext.broadcast(block)
        part = stored(rows.mapInArrow(_search(_cached(sent, window)), SCHEMA), "found")
        sent.unpersist()
        parts = part if parts is None else parts.union(part)
    merged = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("found"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.select("doc_id", "n_words", _merged(F.col("found")).alias("spans"), "items")


def _merged(spans):
    """Sorted spans with those that touch or overlap made one."""

    def step(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end")
        )
        shorter = F.slice(done, 1, F.size(done) - 1)
        touches = (F.size(done) > 0) & (span["start"] <= F.get(done, F.size(done) - 1)["end"])
        return F.when(touches, F.concat(shorter, F.array(joined))).otherwise(
            F.concat(done, F.array(span))
        )

    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    safe = lambda done, span: F.when(F.size(done) == 0, F.array(span)).otherwise(step(done, span))
    return F.aggregate(spans, empty, safe)


_PHRASES: dict[tuple[str, int], Phrases] = {}


def _cached(sent, window: int):
    """Phrases of a broadcast block, prepared once per worker. Its digest is made once, here."""
    key = hashlib.sha256(repr(sent.value).encode()).hexdigest(), window

    def get() -> Phrases:
        if key not in _PHRASES:
            _PHRASES.clear()
            _PHRASES[key] = Phrases(sent.value, window)
        return _PHRASES[key]

    return get


def contamination(found: DataFrame) -> DataFrame:
    """Counts, the digest of the item ids and the verdict: at least a twentieth of the words."""
    hit = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]
    )
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
