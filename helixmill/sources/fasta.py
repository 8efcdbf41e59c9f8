"""FASTA and aligned-FASTA scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import require


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """file, seq_idx, id, description and seq of every record under `path`.

    Records are split by the reader at a line that begins with `>`, so a `>` inside a header is kept. seq_idx is
    unique and rises with the position in a file. Empty sequences are kept (records.non_empty drops them).
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("seq_idx"), F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", "").alias("value"))
    header = F.substring_index("value", "\n", 1)
    body = F.when(F.instr("value", "\n") > 0, F.expr("substring(value, instr(value, '\n') + 1)")).otherwise(F.lit(""))
    return raw.filter(F.trim("value") != "").select("file", "seq_idx", F.split(header, r"\s", 2)[0].alias("id"), header.alias("description"), F.regexp_replace(body, r"\s", "").alias("seq"))


def read_alignment(spark: SparkSession, path: str) -> DataFrame:
    """As read_fasta with the sequence, upper-cased, as `aligned`."""
    return read_fasta(spark, path).withColumn("aligned", F.upper("seq")).drop("seq")


def check_alignment(msa: DataFrame) -> None:
    """Raise unless there are rows and all rows of a gene have one length above 0."""
    bad = msa.groupBy("gene").agg(F.min(F.length("aligned")).alias("lo"), F.max(F.length("aligned")).alias("hi")).agg(F.count("*").alias("n"), F.count_if((F.col("lo") != F.col("hi")) | (F.col("lo") == 0)).alias("bad")).first()
    require(bad.n > 0, "check_alignment: no alignment rows")
    require(bad.bad == 0, f"check_alignment: {bad.bad} genes with rows of unequal or no length; align the sequences first")


def write_fasta(records: DataFrame, path: str, seq: str = "seq") -> None:
    """Write description and sequence of each record, replacing what is there."""
    records.select(F.concat(F.lit(">"), F.col("description"), F.lit("\n"), F.col(seq)).alias("value")).write.mode("overwrite").text(path)
