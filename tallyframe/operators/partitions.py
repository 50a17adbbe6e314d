"""Partitions by the number of rows, where the session's shuffle width is too small for them."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows that one task sorts or groups at once.
ROWS_A_TASK = 250_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by hash of the keys, so that a task gets some ``ROWS_A_TASK`` of its ``rows`` rows.

    Left as it is where Spark's own shuffles have enough partitions for that: those are coalesced and split at
    run time. What follows on the same keys needs no other shuffle.
    """
    need = -(-rows // ROWS_A_TASK)
    return df.repartition(need, *keys) if need > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
