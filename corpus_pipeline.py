"""A corpus pipeline of five stages over the table of documents.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and returns a
DataFrame; all but the last return the columns of documents. ``run`` stores every stage's rows as
Parquet in the shared folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.llm import decontaminate, jaccard, pieces, quality, secrets
from sensorloom.llm.common import stored, table
from sensorloom.llm.queries import PIECE_MODEL, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the documents it is given."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows stored with a number of their own, and the name of its column. Decisions are
    applied by it, as a doc_id may be null or stand on several rows."""
    name = "row_id"
    while name in [column.lower() for column in docs.columns]:
        name += "_"
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest doc_id, and one without an id
    only where none has one. Rows are compared one by one, so that copies under one doc_id or
    without any are near duplicates too, and different texts under one doc_id are not."""
    rows, own = _numbered(docs)
    members = jaccard.similar_documents(rows.select(F.col(own).alias("doc_id"), "text"))
    named = members.select(F.col("doc_id").alias(own), "component_id").join(rows.select(own, "doc_id"), own)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col(own).alias("row"))
    kept = named.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.row").alias(own))
    return rows.join(kept, own, "left_semi").select(docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no more than a trace of a benchmark item. Each row is judged by its own text,
    whatever its doc_id, null or on several rows."""
    rows, own = _numbered(docs)
    found = decontaminate.find_benchmark(
        rows.select(F.col(own).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")
    )
    gone = decontaminate.contamination(found).filter("contaminated").select(F.col("doc_id").alias(own))
    return rows.join(gone, own, "left_anti").select(docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and the number of characters brought up to
    date where a text has changed."""
    found = secrets.find_secrets(docs, keep=docs.columns)
    clean = secrets.redact(F.col("row.text"), F.col("secrets"))
    rows = found.select("row", F.size("secrets").alias("n"), clean.alias("clean"))
    new = {
        "text": F.col("clean"),
        "n_chars": F.when(F.col("n") > 0, F.length("clean")).otherwise(F.col("row.n_chars")),
    }
    return rows.select(
        *[
            new.get(field.name, F.col(f"row.`{field.name}`")).cast(field.dataType).alias(field.name)
            for field in docs.schema.fields
        ]
    )


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text: their number and the digests of the ids and of the decoded text."""
    return pieces.encode_documents(docs, tokenizer_path(PIECE_MODEL), digest=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("secret scan", secret_stage),
    ("SentencePiece encoding", token_stage),
]

# The classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
