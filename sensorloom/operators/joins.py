"""Left joins to lookup tables that hold up at any table size and key skew."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from sensorloom.functions.columns import column

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key of fewer rows, or of a smaller share of all rows, is no burden for one task.
HOT_ROWS = 1_000_000
HOT_SHARE = 1e-4
# Into how many parts the rows of a hot key are dealt.
SALTS = 64
# A sketch tracks so many items for one of the least share, and at least so many; tasks are merged in
# so many parts first.
SKETCH_FACTOR, LEAST_TRACKED, SKETCH_PARTS = 5, 1000, 64


def fits_broadcast(
    *tables: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> list[bool]:
    """Measure tables in one job: true for each whose row count and bytes are within the bounds.

    Each table sends one line per partition, so measuring is safe at any size.
    """
    sizes = None
    for position, table in enumerate(tables):
        width = F.lit(16 * len(table.columns))
        for field in table.schema.fields:
            value = column(field.name)
            if isinstance(field.dataType, (ArrayType, MapType, StructType)):
                value = F.to_json(F.struct(value))
            elif not isinstance(field.dataType, (StringType, BinaryType)):
                continue
            width = width + F.coalesce(F.octet_length(value), F.lit(0))
        size = table.agg(
            F.lit(position).alias("position"),
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes"),
        )
        sizes = size if sizes is None else sizes.union(size)
    fits = {
        line["position"]: line["rows"] <= max_rows and line["bytes"] <= max_bytes
        for line in sizes.collect()
    }
    return [fits[position] for position in range(len(tables))]


def frequent_values(
    df: DataFrame, key: str, hot_rows: int = HOT_ROWS, share: float = HOT_SHARE
) -> list:
    """The values with at least ``hot_rows`` rows and at least ``share`` of all rows.

    Found by mergeable sketches of frequent items in one pass over the key column: a task sends one
    sketch of a size that depends on ``share`` alone, however many keys there are, and the sketches
    of some tasks are merged before those of all. There cannot be more than 1 / share values. Counts
    are exact while the keys fit a sketch; beyond that they may be off by less than the share, so the
    list may miss or add a value near it. It decides how rows travel in a join, never which rows come
    out.
    """
    tracked = max(int(SKETCH_FACTOR / share), LEAST_TRACKED)
    part = F.pmod(F.spark_partition_id(), F.lit(SKETCH_PARTS)).alias("part")
    sketches = (
        df.select(column(key).alias("value"), part)
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(value, {tracked})").alias("sketch"))
    )
    merged = f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {tracked})"
    # Grouped, as an empty table has no sketch to estimate from.
    total = sketches.groupBy((F.col("part") < 0).alias("all")).agg(F.sum("rows").alias("rows"), F.expr(merged).alias("top"))
    found = total.first()
    if found is None:
        return []
    least = max(hot_rows, share * found["rows"])
    return sorted(each["item"] for each in found["top"] if each["item"] is not None and each["count"] >= least)


def _salted_join(
    fact: DataFrame, lookup: DataFrame, key: str, hot: list, salts: int = SALTS
) -> DataFrame:
    """Left join in one pass over both tables, with the rows of hot and NULL keys dealt out.

    The lookup rows of a hot key, one per key and so few, are repeated for every salt. The salt of
    a fact row comes from its partition and its content, so exact copies spread as well and a task
    that is run again deals its rows alike.
    """
    salt = "_salt"
    while salt in fact.columns or salt in lookup.columns:
        salt += "_"
    others = [column(c) for c in fact.columns if c != key]
    dealt = F.pmod(F.xxhash64(F.spark_partition_id(), *others), F.lit(salts)).cast("int")
    spread, one = column(key).isNull(), F.array(F.lit(0))
    copies = one
    if hot:
        spread = spread | column(key).isin(hot)
        every = F.array(*[F.lit(i) for i in range(salts)])
        copies = F.when(column(key).isin(hot), every).otherwise(one)
    left = fact.withColumn(salt, F.when(spread, dealt).otherwise(F.lit(0)))
    right = lookup.withColumn(salt, F.explode(copies))
    return left.join(right, [key, salt], "left").drop(salt)


def join_lookups(
    fact: DataFrame,
    lookups: Mapping[str, DataFrame],
    hot_from: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left outer join of a fact table to a lookup table per key column.

    A lookup table measured to be small is broadcast. Beyond that bound both sides are shuffled by
    key, and the rows of hot keys and of NULL keys are dealt out to many tasks. The fact is read
    once, whatever is hot.

    ``hot_from`` is a cheaper table to find the hot keys in, such as the raw scan of the fact.
    ``hot_rows`` None looks for none, for a fact that has few rows per key. A stream looks for none
    either: no key can hold more rows than its micro-batch does; its NULL keys are dealt out.
    """
    small = fits_broadcast(*lookups.values(), max_rows=max_rows, max_bytes=max_bytes)
    joined = fact
    for (key, lookup), is_small in zip(lookups.items(), small):
        if is_small:
            joined = joined.join(F.broadcast(lookup), key, "left")
            continue
        source = fact if hot_from is None else hot_from
        look = hot_rows is not None and not source.isStreaming and not fact.isStreaming
        hot = frequent_values(source, key, hot_rows) if look else []
        joined = _salted_join(joined, lookup, key, hot)
    return joined


def join_small(fact: DataFrame, lookups: Mapping[str, DataFrame]) -> DataFrame:
    """The same join for a fact that is already aggregated to a few rows per key: nothing is
    measured, and adaptive execution broadcasts what turns out small."""
    for key, lookup in lookups.items():
        fact = fact.join(lookup, key, "left")
    return fact
