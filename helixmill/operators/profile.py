"""Alignment column profiles on msa(gene, seq_idx, aligned)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import BASES
from ..params import STRICT, Params


def unpivot(msa: DataFrame) -> DataFrame:
    """gene, seq_idx, col (from 0) and base (upper case), a row for each aligned character."""
    return msa.select("gene", "seq_idx", F.posexplode(F.split(F.upper("aligned"), "")).alias("col", "base"))


def sanitize(msa: DataFrame) -> DataFrame:
    """Everything but A, C, G and T becomes a gap."""
    return msa.withColumn("aligned", F.regexp_replace(F.upper("aligned"), "[^ACGT]", "-"))


COUNTS = [*(f"count_{b.lower()}" for b in BASES), "gap_count", "n_rows"]


def _block_counts(batches):
    """Counts of each column over the rows of a block, gene by gene: a block of rows is a matrix of letters."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        genes = batch.column(0).dictionary_encode()
        names, code = genes.dictionary.to_pylist(), genes.indices.to_numpy(zero_copy_only=False)
        texts = [t.upper().encode("ascii", "replace") for t in batch.column(1).to_pylist()]
        for g, name in enumerate(names):
            own = [texts[i] for i in np.flatnonzero(code == g)]
            size = np.array([len(t) for t in own])
            width = int(size.max(initial=0))
            letters = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in own), np.uint8).reshape(len(own), width)
            counts = [(letters == ord(b)).sum(axis=0) for b in (*BASES, "-")] + [(letters != 0).sum(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array([name] * width, pa.string()), pa.array(np.arange(width, dtype=np.int32)), *(pa.array(c.astype(np.int64)) for c in counts)], names=["gene", "col", *COUNTS])


def column_counts(msa: DataFrame) -> DataFrame:
    """Mergeable counts by column: the four bases, gaps and rows. Blocks of rows are counted column by column; what is
    shuffled is a row for each column, gene and block."""
    rows = msa.filter("gene IS NOT NULL AND aligned IS NOT NULL").select(F.col("gene").cast("string").alias("gene"), "aligned")
    blocks = rows.mapInArrow(_block_counts, "gene string, col int, " + ", ".join(f"{c} long" for c in COUNTS))
    return blocks.groupBy("gene", "col").agg(*(F.sum(c).alias(c) for c in COUNTS))


def sanitized_counts(counts: DataFrame) -> DataFrame:
    """Column counts of the sanitised alignment from those of the alignment: what is no base becomes a gap."""
    return counts.withColumn("gap_count", F.col("n_rows") - sum(F.col(f"count_{b.lower()}") for b in BASES))


def _entropy(counts: list[Column], total: Column) -> Column:
    part = lambda c: F.when((c > 0) & (total > 0), -(c / total) * F.log2(c / total)).otherwise(0.0)
    return sum((part(c) for c in counts[1:]), part(counts[0]))


def from_counts(counts: DataFrame, params: Params = STRICT) -> DataFrame:
    """Column profile from counts; ties between bases go to A, C, G, T in that order."""
    c = [F.col(f"count_{b.lower()}") for b in BASES]
    total, top = c[0] + c[1] + c[2] + c[3], F.greatest(*c)
    base = F.coalesce(*(F.when(x == top, F.lit(b)) for x, b in zip(c, BASES)))
    suitable = (total >= params.min_non_gap_count) & (top > 0)
    return counts.select(
        "gene", "col", *c, "gap_count", total.alias("non_gap_count"), (F.col("gap_count") / F.col("n_rows")).alias("gap_fraction"),
        F.when(total > 0, top / total).otherwise(0.0).alias("identity"), _entropy(c, total).alias("entropy"), suitable.alias("suitable"),
        F.when(suitable, base).otherwise(F.lit(params.unsuitable_char)).alias("consensus_base"),
    )


def column_profile(msa: DataFrame, params: Params = STRICT) -> DataFrame:
    return from_counts(column_counts(msa), params)


def consensus(profile: DataFrame) -> DataFrame:
    """gene and consensus: the consensus bases in column order (a gene's alignment length bounds the list)."""
    parts = F.array_sort(F.collect_list(F.struct("col", "consensus_base")))
    return profile.groupBy("gene").agg(F.array_join(F.transform(parts, lambda p: p["consensus_base"]), "").alias("consensus"))


def _symbols(msa: DataFrame, gaps: str) -> DataFrame:
    rows = unpivot(msa)
    counted = rows.filter(~F.col("base").isin(*gaps)).groupBy("gene", "col", "base").agg(F.count("*").alias("n"), F.min("seq_idx").alias("first"))
    return rows.select("gene", "col").distinct().join(counted, ["gene", "col"], "left")


def generic_column_metrics(msa: DataFrame) -> DataFrame:
    """Identity, entropy and consensus over any symbols but `-` and `.`; ties go to the symbol seen first."""
    s = _symbols(msa, "-.")
    total = s.groupBy("gene", "col").agg(F.sum("n").alias("total"))
    s = s.join(total, ["gene", "col"])
    p = F.col("n") / F.col("total")
    return s.groupBy("gene", "col").agg(
        F.coalesce(F.max(p), F.lit(0.0)).alias("identity"), F.coalesce(F.sum(-p * F.log2(p)), F.lit(0.0)).alias("entropy"),
        F.max_by("base", F.struct("n", -F.col("first"))).alias("consensus_base"),
    )


def aligned_consensus(msa: DataFrame) -> DataFrame:
    """gene and consensus_aligned: the majority of all symbols but `-`, `-` where there is none."""
    best = _symbols(msa, "-").groupBy("gene", "col").agg(F.coalesce(F.max_by("base", F.struct("n", -F.col("first"))), F.lit("-")).alias("consensus_base"))
    return consensus(best).withColumnRenamed("consensus", "consensus_aligned")


def conservation(profile: DataFrame, params: Params = STRICT) -> DataFrame:
    """Inverse entropy, normalised to four bases; all-gap columns get a score of their own."""
    score = F.when(F.col("non_gap_count") == 0, F.lit(params.all_gap_score)).otherwise(1.0 - F.col("entropy") / 2.0)
    return profile.select("gene", "col", score.alias("score"), (F.col("non_gap_count") == 0).alias("all_gap"))
