"""Spelling variants: words that are one edit apart, and the common form behind a rare one.

Two words are one inserted, deleted or replaced character apart exactly if their common prefix and
common suffix together reach the length of the longer one less one. The length of the common prefix
is then the place of the edit. Words are put into buckets by the range that the edit may lie in: two
words whose edit lies in [head, size - tail) share ``head`` leading and ``tail`` trailing characters.
A bucket of too many words is replaced by two of half the range each, and so on down to ranges of one
place, whose buckets hold no more words than the alphabet has letters. So every pair is looked at in
one bucket, and none has to be left out for the sake of a large group.

Inside a bucket words are compared without a loop over pairs: sorted rows are cut into blocks, the
words of a block become a padded matrix of code points from the left and one from the right, and
every pair of blocks that share a bucket is one dense tile of prefix and suffix lengths.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.llm.common import stored

# Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 whose ASCII letters are in lower case.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
# A bucket of more words than this is split; rows of a block.
MOST, BLOCK = 512, 64
BUCKET = ("size", "head", "tail", "key")


def spoiled(run: bytes, number: int) -> bytes:
    """The run without its code point at ``number`` modulo its length."""
    letters = run.decode()
    at = number % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(documents: DataFrame, shortest: int = 6, every: int | None = 199) -> DataFrame:
    """(word, n): the runs of letters of all whole texts in lower case and their numbers.

    ``documents`` has doc_id and text; other columns are ignored. With ``every``, a run loses a code
    point in documents where that number divides the crc32 of ``doc_id:run``, which plants errors;
    a null doc_id stands there as the empty string. Results of fewer than ``shortest`` code points
    are left out. A null text has no words. Every repeated row counts. Words are counted per batch
    before they are shuffled, so one that all texts have is no burden.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter[bytes] = Counter()
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = RUN.findall(text.as_py().lower()) if text.is_valid else []
                total.update(found)
                start = crc32(name + b":")
                for word in set(found) if every else ():
                    number = crc32(word, start)
                    if number % every == 0:
                        times = found.count(word)
                        total[word] -= times
                        total[spoiled(word, number)] += times
            long = [(w, n) for w, n in total.items() if n and len(w) - w.count(b"\xc3") >= shortest]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w for w, _ in long], pa.binary()).cast(pa.string()),
                    pa.array([n for _, n in long], pa.int64()),
                ],
                names=["word", "n"],
            )

    rows = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary").alias("name"),
        F.col("text").cast("binary").alias("text"),
    )
    found = rows.mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _bucket(size: Column, head: Column, tail: Column) -> Column:
    """The bucket of a word for edits in [head, size - tail): what it has before and behind them."""
    key = F.concat(
        F.substring("word", F.lit(1), head),
        F.substring("word", F.char_length("word") - tail + 1, tail),
    )
    return F.struct(size.alias("size"), head.alias("head"), tail.alias("tail"), key.alias("key"))


def _halves(size: Column, head: Column, tail: Column) -> Column:
    """The buckets of both halves of a range."""
    middle = head + F.ceil((size - head - tail) / 2).cast("int")
    return F.array(_bucket(size, middle, tail), _bucket(size, head, size - middle))


def _members(rows: DataFrame, *sizes: tuple[Column, Column, Column]) -> DataFrame:
    """A row per word and bucket for the halves of each range of (size, head, tail)."""
    buckets = F.explode(F.flatten(F.array(*[_halves(*each) for each in sizes]))).alias("bucket")
    return rows.select("word", "n", buckets).select("word", "n", *[f"bucket.{name}" for name in BUCKET])


def _bucketed(words: DataFrame, most: int) -> DataFrame:
    """All words in buckets of at most ``most`` words, or of a range of one place."""
    length, none = F.char_length("word"), F.lit(0)
    members = _members(words, (length, none, none), (length + 1, none, none))
    parts = []
    while True:
        sizes = members.filter("size - head - tail > 1").groupBy(*BUCKET).count()
        large = stored(sizes.filter(F.col("count") > most).drop("count"), "large-buckets")
        if large.isEmpty():
            return reduce(DataFrame.union, [*parts, members])
        parts.append(members.join(large, list(BUCKET), "left_anti").select("word", "n", *BUCKET))
        within = members.join(large, list(BUCKET), "left_semi")
        members = stored(_members(within, tuple(F.col(name) for name in BUCKET[:3])), "members")


class Words:
    """Rows of words in buckets, with padded matrices of their code points."""

    def __init__(self, batch: pa.Table) -> None:
        text = batch["word"].to_pylist()
        self.letters = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32)
        self.lengths = np.array([len(w) for w in text], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.size, self.head, self.tail = (np.asarray(batch[name]) for name in BUCKET[:3])

    def matrices(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code points of some rows from the left and from the right, 0 behind the end."""
        column = np.arange(self.lengths[rows].max() + 1)
        inside = column < self.lengths[rows, None]
        left = self.starts[rows, None] + column
        right = (self.starts + self.lengths - 1)[rows, None] - column
        return tuple(np.where(inside, self.letters[np.where(inside, at, 0)], 0) for at in (left, right))


def _common(left: np.ndarray, right: np.ndarray, within: np.ndarray) -> np.ndarray:
    """How many leading entries the rows of two matrices share, for the pairs in ``within``."""
    alive, length = within.copy(), np.zeros(within.shape, np.int64)
    for column in range(min(left.shape[1], right.shape[1])):
        alive &= left[:, column, None] == right[None, :, column]
        if not alive.any():
            break
        length += alive
    return length


def _tile(words: Words, a: np.ndarray, b: np.ndarray, group: np.ndarray, same: bool) -> tuple:
    """The near pairs of two blocks of rows; ``same`` says that the blocks are one."""
    within = group[a, None] == group[None, b]
    if same:
        within &= np.arange(len(a))[:, None] < np.arange(len(b))
    size = words.size[a, None]
    within &= np.maximum(words.lengths[a, None], words.lengths[None, b]) == size
    if not within.any():
        return a[:0], b[:0]
    (la, ra), (lb, rb) = words.matrices(a), words.matrices(b)
    place = _common(la, lb, within)
    within &= (place + _common(ra, rb, within) >= size - 1)
    place = np.minimum(place, size - 1)
    within &= (place >= words.head[a, None]) & (place < size - words.tail[a, None])
    i, j = np.nonzero(within)
    return a[i], b[j]


def _near_rows(batch: pa.Table, group: np.ndarray) -> pa.RecordBatch:
    """Both directions of every near pair among rows sorted by bucket. ``group`` numbers buckets."""
    alike = group[1:] == group[:-1]
    many = np.append(alike, False) | np.append(False, alike)
    batch, group = batch.filter(pa.array(many)), group[many]
    found: list[tuple] = []
    if batch.num_rows:
        words = Words(batch)
        blocks = [np.arange(s, min(s + BLOCK, len(group))) for s in range(0, len(group), BLOCK)]
        for i, block in enumerate(blocks):
            found.append(_tile(words, block, block, group, True))
            for other in blocks[i + 1 :]:
                if group[other[0]] != group[block[-1]]:
                    break
                # Only the block's last bucket goes on behind it.
                rest = block[group[block] == group[other[0]]]
                found.append(_tile(words, rest, other[group[other] == group[other[0]]], group, False))
    a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
    b = np.concatenate([y for _, y in found]) if found else np.zeros(0, np.int64)
    one, two = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
    word, n = batch["word"].combine_chunks(), batch["n"].combine_chunks()
    return pa.RecordBatch.from_arrays(
        [word.take(one), word.take(two), n.take(two)], names=["word", "near", "near_n"]
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The near pairs of a partition that is sorted by bucket. The last bucket of a batch waits for
    the next batch."""
    waiting: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if waiting is None else pa.concat_tables([waiting, rows])
        group = _groups(rows)
        last = int(np.searchsorted(group, group[-1])) if len(group) else 0
        waiting = rows.slice(last)
        if last:
            yield _near_rows(rows.slice(0, last).combine_chunks(), group[:last])
    if waiting is not None and waiting.num_rows:
        yield _near_rows(waiting.combine_chunks(), _groups(waiting))


def _groups(rows: pa.Table) -> np.ndarray:
    """A number for each row that grows by one where the bucket changes."""
    new = np.zeros(rows.num_rows, bool)
    for name in BUCKET[:3]:
        values = np.asarray(rows[name])
        new[1:] |= values[1:] != values[:-1]
    key = np.array(rows["key"].to_pylist(), object)
    new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, near, near_n): every ordered pair of words that one edit tells apart, once.

    ``words`` has distinct words and their numbers n (other columns are ignored); null and empty
    words have no partners. Buckets hold at most ``most`` words or the letters of an alphabet, and
    only near pairs leave a task.
    """
    rows = words.select("word", F.col("n").cast("bigint").alias("n")).filter("word != ''")
    members = _bucketed(rows, most)
    sorted_rows = members.repartition(*BUCKET).sortWithinPartitions(*BUCKET)
    return sorted_rows.mapInArrow(_compare, "word string, near string, near_n bigint")


def spelling_groups(words: DataFrame, ratio: int = 5, most: int = MOST) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    A word's form is its near word of largest n (of several the smallest in code-point order) if
    that n is at least ``ratio`` times the word's own, else null. Forms followed to the last give
    the root; a word without a form is its own. An empty table gives no rows.
    """
    best = F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("best")
    near = near_words(words, most).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    enough = -F.col("best.least") >= ratio * F.col("n")
    forms = stored(
        words.select("word", "n").join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.least")).alias("form_n"),
        ),
        "forms",
    )
    # From form to form n grows by the ratio, so its largest value bounds the steps to a root; each
    # round of looking up the root of the root doubles the steps taken.
    most_n = forms.agg(F.max("form_n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most_n, max(ratio, 2))) + 1)
    roots = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = stored(
            roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
            "roots",
        )
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(documents: DataFrame, least: int = 5, shortest: int = 6, every: int | None = 199) -> DataFrame:
    """The words of whole texts that occur ``least`` times, grouped: see ``word_counts`` and
    ``spelling_groups``, whose columns it returns. Null and empty texts add nothing."""
    counts = word_counts(documents, shortest, every).filter(F.col("n") >= least)
    return spelling_groups(stored(counts, "words"))
