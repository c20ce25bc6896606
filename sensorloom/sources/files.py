"""CSV and parquet files, and the shared folder for intermediate tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sensorloom.functions.columns import column


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, header: bool = True
) -> DataFrame:
    """Read CSV files. Without a schema (or with an empty one) types are inferred, which reads
    the files twice; give a schema for large data."""
    reader = spark.read.option("header", header)
    if schema is None or not schema.fields:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def header_schema(spark: SparkSession, path: str) -> StructType:
    """A schema of nullable strings named by the header line of a CSV file."""
    names = spark.read.option("header", True).csv(path).columns
    if not names:
        raise ValueError(f"no header row in {path}")
    return StructType([StructField(n.removeprefix("\ufeff").strip(), StringType()) for n in names])


def read_csv_lines(
    spark: SparkSession, path: str, schema: StructType | None = None, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The rows of CSV files, and the lines (``Line``) that do not have the right number of fields.

    Fields are read as text, named by the header or by ``schema``, so that a value of a wrong type
    makes no line malformed; ``recast`` gives them their types. Both tables come from one parse and
    together hold every line once.
    """
    names = (schema or header_schema(spark, path)).names
    line = "_line"
    while line in names:
        line += "_"
    text = StructType([StructField(name, StringType()) for name in [*names, line]])
    # Fields that a query does not need count as well, so none is pruned before the lines are split.
    reader = spark.read.option("header", header).option("columnPruning", False)
    reader = reader.option("columnNameOfCorruptRecord", line)
    lines = reader.schema(text).csv(path)
    # A condition that is always met, as Spark reads no malformed lines without their fields.
    parsed = F.length(F.coalesce(column(names[0]), F.lit(""))) >= 0
    rows = lines.filter(F.col(line).isNull() & parsed).drop(line)
    return rows, lines.filter(F.col(line).isNotNull() & parsed).select(F.col(line).alias("Line"))


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Replace ``path`` by CSV files with a header.

    By default Spark balances the file sizes, splitting large partitions and merging small ones;
    ``files`` asks for a fixed number of files instead.
    """
    spread = df.hint("rebalance") if files is None else df.repartition(files)
    spread.write.mode("overwrite").option("header", True).csv(path)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the one that ``spark.checkpoint.dir`` names.

    Where that is unset the session's warehouse folder takes its place; either must be storage
    that all executors see.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
