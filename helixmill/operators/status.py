"""Gene lists, partition names and the stage funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import Params, require


def gene_list(spark: SparkSession, genes: str) -> DataFrame:
    """gene: the items of a comma-separated list; an empty item is an error."""
    out = spark.createDataFrame([(genes,)], "genes string").select(F.posexplode(F.split("genes", ",")).alias("ord", "gene")).withColumn("gene", F.trim("gene"))
    require(not out.filter("gene = ''").head(1), f"gene_list: an empty gene in {genes!r}; separate names by single commas")
    return out


def genes_of(lists: DataFrame, column: str = "genes") -> DataFrame:
    """gene: the distinct items of many comma-separated lists; an empty item fails the job."""
    item = F.explode(F.split(F.col(column), ",")).alias("item")
    gene = F.trim("item")
    bad = F.raise_error(F.lit("genes_of: an empty gene; separate gene names by single commas")).cast("string")
    return lists.select(item).select(F.when(gene != "", gene).otherwise(bad).alias("gene")).distinct()


def partition_name(column: str = "gene"):
    """A folder name: letters, digits and -_. are kept, others become _ ; two genes may share one."""
    return F.regexp_replace(F.trim(F.col(column)), r"[^\p{L}\p{N}\-_.]", "_")


def funnel(genes: DataFrame, stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """gene, a count for each stage, and status: the first empty stage, or `ok`.

    The stages' genes are one union, counted in one aggregation, whatever the number of stages.
    """
    rows = genes.select("gene", F.lit(-1).alias("stage"))
    for i, (_, df) in enumerate(stages):
        rows = rows.unionByName(df.select("gene", F.lit(i).alias("stage")))
    counts = (F.count_if(F.col("stage") == i).alias(name) for i, (name, _) in enumerate(stages))
    out = rows.groupBy("gene").agg(F.count_if(F.col("stage") == -1).alias("_own"), *counts).filter("_own > 0").drop("_own")
    status = F.coalesce(*(F.when(F.col(n) == 0, F.lit(n)) for n, _ in stages), F.lit("ok"))
    return out.withColumn("status", status)


#: What an empty stage means.
WHY = {
    "rows": "no alignment rows", "regions": "no conserved region left", "windows": "no candidate window in the regions", "primers": "no primer of A, C, G and T in the windows",
    "filtered": "no primer passed the filters", "pairs": "no primer pair passed the filters", "covered": "no pair that doesn't overlap itself", "top": "no pair ranked",
}


def with_reasons(funnel_: DataFrame, scores: DataFrame, params: Params) -> DataFrame:
    """Add `reason`, why a gene was skipped (null where it wasn't): an alignment shorter than the window and regions
    that were all too short are told apart from other empty stages."""
    length = scores.groupBy("gene").agg(F.count("*").alias("_length"))
    status = F.col("status")
    why = F.coalesce(*(F.when(status == k, F.lit(v)) for k, v in WHY.items()), F.when(status != "ok", status))
    short = F.concat(F.lit("alignment of "), F.col("_length"), F.lit(f" columns, shorter than the window of {params.window_size}"))
    least = F.lit(f"no conserved region of at least {params.min_region_len} columns")
    reason = F.when((status == "regions") & (F.col("_length") < params.window_size), short).when((status == "regions") & F.lit(params.min_region_len is not None), least).otherwise(why)
    return funnel_.join(length, "gene", "left").withColumn("reason", reason).drop("_length")


def _reasons(funnel_: DataFrame) -> str:
    """The first genes with their reasons, for a message."""
    column = "reason" if "reason" in funnel_.columns else "status"
    return "; ".join(f"{r.gene}: {r[column]}" for r in funnel_.orderBy("gene").select("gene", column).head(5)) or "there is none"


def require_any(funnel_: DataFrame) -> None:
    """Raise if every gene was skipped, and say why."""
    require(bool(funnel_.filter("status = 'ok'").head(1)), f"every gene was skipped: {_reasons(funnel_)}")
