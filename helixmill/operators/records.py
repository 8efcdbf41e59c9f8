"""Record-level filters and robust statistics on sequences(gene, seq_idx, id, description, seq)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import ambiguous_fraction
from ..storage import stored
from .places import EACH, summed

SIGMA = 1.4826


def non_empty(records: DataFrame) -> DataFrame:
    return records.filter(F.length("seq") > 0)


def _header() -> Column:
    return F.concat_ws(" ", "id", "description")


def gene_header(records: DataFrame, gene: str | None = None) -> DataFrame:
    """Records whose header names the gene (`gene = NAME`, any case); without `gene`, that of their own column."""
    if gene is not None:
        return records.filter(F.lit(bool(gene)) & _header().rlike(rf"(?i)\bgene\s*=\s*\Q{gene}\E\b"))
    pattern = F.concat(F.lit(r"(?i)\bgene\s*=\s*\Q"), F.col("gene"), F.lit(r"\E\b"))
    return records.filter((F.col("gene") != "") & F.regexp_like(_header(), pattern))


def is_partial() -> Column:
    return F.contains("description", F.lit("partial=True"))


def exact_percentile(rows: DataFrame, key: str | list[str], value: str, share: float | Column, out: str, each: int = EACH) -> DataFrame:
    """key and out: the percentile of `value` by linear interpolation at (n - 1) share, null values aside.

    Equal values are counted, the counts are summed along ranges of (key, value), and the two rows that hold the
    places in question are taken; so one key may have any number of values. `share` may depend on the key.
    """
    by = [key] if isinstance(key, str) else key
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    s = summed(stored(counts, "counts"), by, [F.col(value)], ("_n",), each)
    at = (F.col("_n_all") - 1) * (F.lit(share) if isinstance(share, float) else share)
    holds = lambda x: (F.col("_n_before") <= x) & (x < F.col("_n_before") + F.col("_n"))
    s = s.withColumn("_at", at).filter(holds(F.floor("_at")) | holds(F.ceil("_at")))
    low, high = F.min(value), F.max(value)
    return s.groupBy(*by).agg((low + (high - low) * F.first(F.col("_at") - F.floor("_at"))).alias(out))


def length_statistics(records: DataFrame) -> DataFrame:
    """Per gene: median length, MAD, robust limits and the 90th percentile of the ambiguous fraction."""
    return _statistics(_measured(records))


def _measured(records: DataFrame) -> DataFrame:
    """What statistics and filters need of each record, a few bytes, stored: texts are read and cleaned once."""
    own = records.select("gene", "seq_idx", F.length("seq").cast("double").alias("n"), ambiguous_fraction("seq").alias("amb"), is_partial().alias("partial"), F.sha2(F.upper("seq"), 256).alias("text"))
    return stored(own, "measured")


def _statistics(measured: DataFrame) -> DataFrame:
    both = measured.select("gene", F.inline(F.array(F.struct(F.lit("n").alias("kind"), F.col("n").alias("v")), F.struct(F.lit("amb").alias("kind"), F.col("amb").alias("v")))))
    found = exact_percentile(both, ["gene", "kind"], "v", F.when(F.col("kind") == "n", 0.5).otherwise(0.9), "p")
    first = stored(found.groupBy("gene").agg(F.max(F.when(F.col("kind") == "n", F.col("p"))).alias("median_len"), F.max(F.when(F.col("kind") == "amb", F.col("p"))).alias("amb_p90")), "medians")
    spread = exact_percentile(measured.join(first, "gene").select("gene", F.abs(F.col("n") - F.col("median_len")).alias("away")), "gene", "away", 0.5, "mad")
    sigma = F.col("mad") * SIGMA
    low = F.greatest(F.lit(1), (F.col("median_len") - 4 * sigma).cast("bigint"))
    high = F.when(sigma > 0, (F.col("median_len") + 4 * sigma).cast("bigint")).otherwise(F.col("median_len").cast("bigint"))
    return first.join(spread, "gene").select("gene", "median_len", "mad", low.alias("min_len"), high.alias("max_len"), "amb_p90")


def exact_dedupe(records: DataFrame) -> DataFrame:
    """The first record of each upper-cased sequence."""
    first = records.groupBy("gene", F.upper("seq").alias("s")).agg(F.min("seq_idx").alias("seq_idx")).select("gene", "seq_idx")
    return records.join(first, ["gene", "seq_idx"], "left_semi")


def auto_filter(records: DataFrame) -> DataFrame:
    """Drop partial records, lengths outside the robust limits, ambiguous ones, then repeats.

    Statistics come from all records, before any filter; they, the filters and the search for repeats read what
    `_measured` has stored, and the records themselves meet only the list of those that stay.
    """
    measured = _measured(records)
    stats = _statistics(measured)
    kept = measured.join(stats, "gene").filter(~F.col("partial") & F.col("n").between(F.col("min_len"), F.col("max_len")) & (F.col("amb") <= F.col("amb_p90")))
    first = kept.groupBy("gene", "text").agg(F.min("seq_idx").alias("seq_idx"))
    return records.join(stored(first.select("gene", "seq_idx"), "first"), ["gene", "seq_idx"], "left_semi")
