"""Look up every position of a short token list in a table with unique keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(table: DataFrame, columns: list[str], limit: int = BROADCAST_BYTES) -> bool:
    """Whether the columns of ``table``, measured as text and not guessed, stay below ``limit`` bytes."""
    width = F.octet_length(F.to_json(F.struct(*columns)))
    return (table.agg(F.sum(width)).first()[0] or 0) <= limit


def lookup_positions(
    df: DataFrame,
    positions: Column,
    n: int,
    table: DataFrame,
    key: str,
    value: str,
    default: Column,
    out: str,
    row_key: list[str],
    limit: int | None = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``out``: for each of the first ``n`` positions the table's value, or ``default``.

    A table of a checked small size is broadcast and probed once per position, with no shuffle of
    ``df`` at all. Beyond that size the positions are exploded, joined by shuffle (the table's keys
    are unique, so a frequent key is split by the adaptive skew join) and put together again per
    row, at most ``n`` values each; ``row_key`` must identify a row. NULL has no positions, like an
    empty list. Without ``limit`` the caller has measured that the table fits.
    """
    columns = df.columns
    positions = F.coalesce(positions, F.array().cast("array<string>"))
    if limit is None or fits_broadcast(table, [key, value], limit):
        slim = F.broadcast(table.select(key, value))
        found = df.withColumn("_pos", positions)
        for i in range(n):
            side = slim.select(F.col(key).alias(f"_k{i}"), F.col(value).alias(f"_v{i}"))
            found = found.join(side, F.get("_pos", F.lit(i)) == F.col(f"_k{i}"), "left")
        values = [
            F.when(F.size("_pos") > i, F.coalesce(F.col(f"_v{i}"), default)) for i in range(n)
        ]
        return found.select(
            *columns, F.slice(F.array(*values), 1, F.least(F.size("_pos"), F.lit(n))).alias(out)
        )
    exploded = df.select(*row_key, F.posexplode(F.slice(positions, 1, n)).alias("_i", "_k"))
    joined = exploded.join(table.select(F.col(key).alias("_k"), F.col(value).alias("_v")), "_k", "left")
    gathered = joined.groupBy(*row_key).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_i", F.coalesce("_v", default).alias("_v")))),
            lambda x: x["_v"],
        ).alias(out)
    )
    empty = F.array().cast(gathered.schema[out].dataType)
    return df.join(gathered, row_key, "left").select(
        *columns, F.coalesce(F.col(out), empty).alias(out)
    )
