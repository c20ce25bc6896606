"""Token counts kept as rollups by source, language and tokenizer version.

A change of the corpus is a batch of signed deltas: an insert adds a document and its tokens, a
delete takes both away, a revision takes the old count away and adds the new one. A batch is summed
per key and committed under its id; committing the same id again changes nothing. Totals are the
sums over all committed batches, so they never need the documents again.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorloom.llm.common import stored, text_slices

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_inserted", "n_deleted", "n_revised")
_ENCODERS: dict[str, object] = {}


def encoder(path: str, pattern: str):
    """A byte-level BPE encoder from a file of ranks, read once per worker."""
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as file:
            lines = [line.split() for line in file.read().splitlines() if line]
        ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        _ENCODERS[path] = tiktoken.Encoding(
            path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
    return _ENCODERS[path]


def token_counts(documents: DataFrame, path: str, pattern: str, version: str) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens, print): the tokens of every whole text and its
    SHA-256. ``documents`` has doc_id, text, source and lang, and row_id, which is kept, where its
    rows are to be told apart though doc_id is null or repeated. A null text is empty. Nothing is
    shuffled."""
    own_id = [name for name in ("row_id",) if name in documents.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column("text").to_pylist()
                counts = [len(own.encode_ordinary(text)) if text else 0 for text in texts]
                names = [*own_id, "doc_id", "source", "lang", "print"]
                columns = [part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts, pa.int64())],
                    names=[*names, "n_tokens"],
                )

    rows = documents.select(
        *own_id,
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("print"),
        "text",
    )
    types = [f"{name} {documents.schema[name].dataType.simpleString()}" for name in own_id]
    types += ["doc_id bigint, source string, lang string, print string, n_tokens bigint"]
    counted = rows.mapInArrow(run, ", ".join(types))
    return counted.withColumn("tokenizer", F.lit(version))


def _deltas(counts: DataFrame, docs: int, tokens: Column, kind: str) -> DataFrame:
    return counts.select(
        *KEYS,
        F.lit(docs).cast("bigint").alias("n_docs"),
        tokens.cast("bigint").alias("n_tokens"),
        *[F.lit(int(name == kind)).cast("bigint").alias(name) for name in SUMS[2:]],
    )


def inserts(counts: DataFrame) -> DataFrame:
    return _deltas(counts, 1, F.col("n_tokens"), "n_inserted")


def deletes(counts: DataFrame) -> DataFrame:
    return _deltas(counts, -1, -F.col("n_tokens"), "n_deleted")


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Deltas for documents counted again; a document that changed source or language leaves its
    old key and enters the new one.

    Rows belong together by row_id where both tables have it, else by doc_id, and by tokenizer. All
    old rows of an id that has new ones are taken away once each, and all its new rows are added
    once each, whatever their numbers; a null id is an id like any other."""
    key = "row_id" if "row_id" in old.columns and "row_id" in new.columns else "doc_id"

    def within(rows: DataFrame, others: DataFrame) -> DataFrame:
        ids = others.select(F.col(key).alias("other_id"), F.col("tokenizer").alias("other_tokenizer"))
        same = F.col(key).eqNullSafe(F.col("other_id")) & (F.col("tokenizer") == F.col("other_tokenizer"))
        return rows.join(ids.distinct(), same, "left_semi")

    return _deltas(within(old, new), -1, -F.col("n_tokens"), "").unionByName(
        _deltas(within(new, old), 1, F.col("n_tokens"), "n_revised")
    )


class Rollup:
    """Committed batches in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self, batch: int) -> bool:
        path, files = self._path(f"batch={batch}/_SUCCESS")
        return files.exists(path)

    def commit(self, batch: int, deltas: DataFrame) -> bool:
        """Add a batch; False if its id is there already. A batch is written under a name of its own
        and counts once it is renamed, so of two writers of one id only one adds it; what a broken
        attempt has left is no batch."""
        if self.committed(batch):
            return False
        summed = deltas.groupBy(*KEYS).agg(*[F.sum(name).alias(name) for name in SUMS])
        attempt, target = f"_attempt-{uuid.uuid4().hex}", f"batch={batch}"
        summed.write.parquet(f"{self.folder}/{attempt}")
        written, files = self._path(attempt)
        final, _ = self._path(target)
        if files.exists(final) and not self.committed(batch):
            files.delete(final, True)
        # A folder that another writer has put there meanwhile takes this one in or refuses it.
        inside, _ = self._path(f"{target}/{attempt}")
        added = not files.exists(final) and files.rename(written, final) and not files.exists(inside)
        files.delete(written, True)
        files.delete(inside, True)
        return added

    def batches(self) -> list[int]:
        path, files = self._path("")
        if not files.exists(path):
            return []
        found = [status.getPath().getName() for status in files.listStatus(path)]
        ids = [int(name.removeprefix("batch=")) for name in found if name.startswith("batch=")]
        return sorted(batch for batch in ids if self.committed(batch))

    def totals(self) -> DataFrame:
        """One row per key with the sums of all committed batches; a key without documents stays
        as long as its batches do. No batch gives no rows."""
        types = ", ".join([*(f"{k} string" for k in KEYS), *(f"{s} bigint" for s in SUMS)])
        paths = [f"{self.folder}/batch={batch}" for batch in self.batches()]
        if not paths:
            return self.spark.createDataFrame([], types)
        return (
            self.spark.read.schema(types)
            .parquet(*paths)
            .groupBy(*KEYS)
            .agg(*[F.sum(name).alias(name) for name in SUMS])
        )


def copies(counts: DataFrame) -> DataFrame:
    """The counts of rows whose text another row has that stays, per tokenizer. The row of the
    smallest doc_id stays, one without an id only where none has one, and of several the first by
    row_id; without that column the rows are stored with a number. The row of a text that stays
    combines before the shuffle, and Spark splits the join at a text of very many copies."""
    rows = counts
    if "row_id" not in counts.columns:
        rows = stored(counts.withColumn("row_id", F.monotonically_increasing_id()), "rows")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_id")
    first = rows.groupBy("print", "tokenizer").agg(F.min(order).alias("first"))
    gone = rows.join(first, ["print", "tokenizer"]).filter("row_id != first.row_id")
    return gone.select(counts.columns)


def squeezed(documents: DataFrame) -> DataFrame:
    """The documents that a normalisation of white space changes, with their new text."""
    new = F.trim(F.regexp_replace("text", r"[ \t\r\n]+", " "))
    return documents.filter(new != F.col("text")).withColumn("text", new)
