"""Column counts of alignment rows that keep arriving: the counts of operators.profile, kept as streaming state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import profile
from ..params import STRICT, Params


def start_counts(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Count a stream msa(gene, seq_idx, aligned) by column into an in-memory table, complete after each batch.

    The state is one row for each gene and column, whatever the number of alignment rows.
    """
    return profile.column_counts(rows).writeStream.outputMode("complete").format("memory").queryName(table).option("checkpointLocation", checkpoint).start()


def start_counts_to(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """As start_counts, into Parquet under `out`: a folder for each batch with the counts up to it. A batch that runs
    again replaces its own folder, so a restart from the checkpoint leaves no row twice."""
    write = lambda counts, batch: counts.write.mode("overwrite").parquet(f"{out}/batch={batch}")
    return profile.column_counts(rows).writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).start()


def counts_so_far(spark: SparkSession, out: str) -> DataFrame:
    """The counts of the last batch that start_counts_to has written."""
    every = spark.read.parquet(out)
    last = every.agg(F.max("batch")).first()[0]
    return every.filter(F.col("batch") == last).drop("batch")


def profile_of(counts: DataFrame, params: Params = STRICT) -> DataFrame:
    """The column profile of the counts so far."""
    return profile.from_counts(counts, params)
