"""Joins of a large table with a much smaller one, and rows dealt out by what they cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST, SALTS = 200_000, 32


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], most: int = MOST, salts: int = SALTS) -> DataFrame:
    """Inner join in which a key may hold a large share of `big`.

    `small` is broadcast where a count says that it has at most `most` rows. Else a key's rows of `big` are dealt to
    `salts` partitions by a hash of the row, and `small` goes to each of these.
    """
    if small.limit(most + 1).count() <= most:
        return big.join(F.broadcast(small), keys)
    dealt = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)))
    return dealt.join(small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))), [*keys, "_salt"]).drop("_salt")


def spread(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows that cost far more to compute with than to move, dealt to as many tasks as shuffles have: by their few
    bytes, adaptive execution would leave them to one."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
