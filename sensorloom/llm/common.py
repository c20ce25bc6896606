"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows of about this many bytes of text are worked on at a time inside a task.
SLICE_BYTES = 1 << 20
# A task that counts hashes gathers about so many, and sends their counts on by so many rows.
HELD_HASHES, SENT_HASHES = 1 << 22, 1 << 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, or under the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, purpose: str, batch_bytes: int | None = None) -> DataFrame:
    """The rows written once to the shared folder and read back, so that lost executors cost no
    recomputation and no lineage grows. Shuffle files of the write are of no use afterwards and
    are dropped with it. Where ``batch_bytes`` is given, Arrow batches of the write are cut at about
    so many bytes, whatever the number of their rows."""
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    wanted = {CLEANUP: "true"} | ({BATCH: str(batch_bytes)} if batch_bytes else {})
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(folder)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(folder)


def discard(*tables: DataFrame) -> None:
    """Delete the files of stored tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_slices(
    batch: pa.RecordBatch, name: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch of about ``most`` bytes of the text column; a longer text is
    a slice of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_pylist()
    start, size = 0, 0
    for row, length in enumerate(lengths):
        if size and size + length > most:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += length
    if start < batch.num_rows:
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column, end to end, and where each begins (one more
    entry than texts). Nulls are empty."""
    column = pa.concat_arrays([column.cast(pa.large_string()).fill_null("")])
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# Powers that a worker keeps for the next slice, at most so many of each base.
_POWERS: dict[int, np.ndarray] = {}
KEPT_POWERS = 1 << 21


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 ... base ** (count - 1) modulo 2 ** 64, not to be changed."""
    if count > KEPT_POWERS:
        return _powers(base, count)
    if len(_POWERS.get(base, ())) < count:
        _POWERS[base] = _powers(base, 1 << count.bit_length())
    return _POWERS[base][:count]


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(max(count, 1), dtype=np.uint64)
    done = 1
    while done < count:
        step = min(done, count - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out[:count]


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * BASE ** position over each prefix, one more entry than bytes."""
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=sums[1:])
    return sums


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, whatever stands around it."""
    sums = prefix_sums(raw)
    inverse = powers(INVERSE, len(raw) + 1)
    with np.errstate(over="ignore"):
        return mix64((sums[ends] - sums[starts]) * inverse[starts] + mix64(ends - starts))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns; others, whatever their names, are left out."""
    return df.select(*[F.col(f"`{name}`") for name in columns])


def _slots(values: np.ndarray, bits: int) -> np.ndarray:
    return (values.view(np.uint64) * np.uint64(BASE)) >> np.uint64(64 - bits)


class HashFilter:
    """A set of 64-bit hashes as a table of bits: false alarms are possible, misses are not."""

    def __init__(self, bits: int, words: np.ndarray) -> None:
        self.bits, self.words = bits, words

    def __contains__(self, value: int) -> bool:
        return bool(self.has(np.array([value]))[0])

    def has(self, values: np.ndarray) -> np.ndarray:
        slot = _slots(values, self.bits)
        word = self.words[(slot >> np.uint64(6)).astype(np.int64)]
        return (word >> (slot & np.uint64(63))) & np.uint64(1) == 1


def hash_filter(hashes: DataFrame, known: int, least: int = 20, most: int = 30) -> HashFilter:
    """A filter of a column of about ``known`` hashes: eight bits for each, at least 2 ** least
    and at most 2 ** most in all. Beyond that there are more false alarms, never misses. Tasks
    send words of bits, which combine before they are gathered."""
    bits = min(max(least, int(known * 8).bit_length()), most)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.unique(_slots(np.asarray(batch.column(0)), bits))
            if len(slot):
                word = (slot >> np.uint64(6)).astype(np.int64)
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                merged = np.bitwise_or.reduceat(np.uint64(1) << (slot & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word[first]), pa.array(merged.view(np.int64))], names=["word", "bits"]
                )

    filled = (
        hashes.mapInArrow(words, "word bigint, bits bigint")
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (bits - 6), np.uint64)
    for part in filled.to_batches():
        table[np.asarray(part.column("word"))] = np.asarray(part.column("bits")).view(np.uint64)
    return HashFilter(bits, table)


def _counted(held: list[np.ndarray], name: str) -> Iterator[pa.RecordBatch]:
    """The distinct hashes of a list of arrays, which is emptied, with their counts, in batches of
    SENT_HASHES rows."""
    values = np.concatenate(held) if held else np.zeros(0, np.int64)
    held.clear()
    values.sort()
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    first = np.append(np.flatnonzero(fresh), len(values))
    for start in range(0, len(first) - 1, SENT_HASHES):
        own = first[start : start + SENT_HASHES + 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[own[:-1]]), pa.array(np.diff(own))], names=[name, "count"]
        )


def counted_hashes(texts: DataFrame, hashes_of, name: str, most: int = SLICE_BYTES) -> DataFrame:
    """(name, count): in how many texts each hash of ``hashes_of`` occurs. ``hashes_of`` gives the
    hashes of a column of texts of about ``most`` bytes, each once per text. Equal hashes of
    about HELD_HASHES are counted before the shuffle, so that one that all texts have is no burden. A
    task holds no more, however long the texts are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in text_slices(batch, "text", most):
                held.append(hashes_of(part.column(0)))
                size += len(held[-1])
                if size >= HELD_HASHES:
                    yield from _counted(held, name)
                    size = 0
        yield from _counted(held, name)

    rows = texts.select("text").mapInArrow(run, f"{name} bigint, count bigint")
    return rows.repartition(name).groupBy(name).agg(F.sum("count").alias("count"))
