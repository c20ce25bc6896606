"""One row per key, chosen by an explicit order."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions.columns import column


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), last: bool = False
) -> DataFrame:
    """Keep the first row of each key (the last one with ``last``).

    Rows are ranked by ``order`` and then by all other columns, so the survivor depends on the
    data alone and not on file or partition order. The pick is a min/max over a struct: it
    combines before the shuffle, so a key holding a large share of the rows sends one row per
    input partition and never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = [*order, *(c for c in rest if c not in order)]
    pick = F.max if last else F.min
    picked = df.groupBy(*[column(k) for k in keys]).agg(
        pick(F.struct(*[column(c) for c in ranked])).alias("_picked")
    )
    return picked.select(
        *[
            column(c) if c in keys else F.col("_picked").getField(c).alias(c)
            for c in df.columns
        ]
    )
