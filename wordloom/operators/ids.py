"""Dense ids, batches and running totals without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.session import durable

_PART = "_part"


def running_total(
    df: DataFrame,
    value: str,
    order: list[str],
    groups: list[str] | None = None,
    out: str = "before",
    total: str | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Sum of ``value`` over the rows of the same group that come earlier in ``order``.

    ``total`` and ``rows`` name columns for the group's whole sum and row count.
    ``groups + order`` must identify a row. Rows are range-partitioned on them and the partition
    numbers are frozen in a written table. Each partition is then summed on its own; the totals of
    earlier partitions, at most one row per group and partition, are added as offsets. A group of
    any size is thus spread over as many tasks as its rows need.
    """
    groups = groups or []
    # Without a number of partitions, adaptive execution may join neighbouring small ones.
    ranged = df.repartitionByRange(*groups, *order).withColumn(_PART, F.spark_partition_id())
    frozen = durable(ranged, "ranged")
    within = Window.partitionBy(_PART, *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*groups)
    earlier = across.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    extras = []
    if total:
        extras.append(F.sum("_sum").over(across).alias(total))
    if rows:
        extras.append(F.sum("_rows").over(across).alias(rows))
    offsets = (
        frozen.groupBy(_PART, *groups)
        .agg(F.sum(value).alias("_sum"), F.count("*").alias("_rows"))
        .select(_PART, *groups, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"), *extras)
    )
    return (
        frozen.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(offsets, [_PART, *groups])
        .withColumn(out, F.col("_offset") + F.col("_within"))
        .select(*df.columns, out, *[c for c in (total, rows) if c])
    )


def dense_id(df: DataFrame, order: list[str], out: str = "id") -> DataFrame:
    """Ids 0, 1, 2, ... in the given order, which must identify a row."""
    return running_total(df.withColumn("_one", F.lit(1).cast("bigint")), "_one", order, out=out).drop("_one")


def batches(df: DataFrame, size: int, id: str = "id", out: str = "batch_id") -> DataFrame:
    """Batch number of each row; every row is in exactly one batch."""
    return df.withColumn(out, F.expr(f"`{id}` div {int(size)}"))
