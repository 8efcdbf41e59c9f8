"""Region, hit and result tables: JSON, tabular hits, CSV, TSV, text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import require

REGIONS = "gene string, region_index int, start_col int, end_col int, mean_score double"
HITS = ["query_id", "subject_id", "sstrand", "pident", "align_len", "mismatch", "gaps", "qstart", "qend", "sstart", "send", "evalue", "bitscore", "qlen", "qseq", "sseq"]
_TYPES = {"pident": "double", "evalue": "double", "bitscore": "double"} | {c: "int" for c in ("align_len", "mismatch", "gaps", "qstart", "qend", "sstart", "send", "qlen")}


def read_regions_json(spark: SparkSession, path: str) -> DataFrame:
    """Regions from files of one JSON array each, or lines (.jsonl); a bad item fails the scan, an empty table is an error."""
    out = spark.read.schema(REGIONS).option("mode", "FAILFAST").option("multiLine", not path.endswith(".jsonl")).json(path)
    out = out.select("gene", "region_index", "start_col", "end_col", "mean_score")
    require(bool(out.head(1)), f"no regions in {path}")
    bad = out.filter("start_col IS NULL OR end_col IS NULL OR mean_score IS NULL").head(1)
    require(not bad, f"a region in {path} needs start_col, end_col and mean_score: {bad[:1]}")
    return out


def write_regions_json(regions: DataFrame, path: str) -> None:
    """JSON lines, a folder for each gene."""
    regions.withColumn("part", F.col("gene")).write.mode("overwrite").partitionBy("part").json(path)


def read_regions_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGIONS).option("mode", "FAILFAST").json(path).select("gene", "region_index", "start_col", "end_col", "mean_score")


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Tabular hits of 16 fields; lines of another number are dropped, bad numbers fail."""
    parts = spark.read.text(path).select(F.split("value", "\t", -1).alias("p")).filter(F.size("p") == 16)
    cols = [F.col("p")[i].cast(_TYPES[c]).alias(c) if c in _TYPES else F.col("p")[i].alias(c) for i, c in enumerate(HITS)]
    return parts.select(*cols).withColumn("sstrand", F.lower("sstrand"))


def write_hits(hits: DataFrame, path: str) -> None:
    hits.select(F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in HITS)).alias("value")).write.mode("overwrite").text(path)


def write_csv(rows: DataFrame, path: str, sep: str = ",") -> None:
    """CSV or TSV with a header in every part file."""
    rows.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def _whole(texts: DataFrame, path: str) -> None:
    """One file for each gene with its whole text(gene, text); the writer adds the last line feed.

    A gene is one row, so it is one file; a text is as long as its pairs, of which there are top_n at most.
    """
    texts.select("gene", F.regexp_replace("text", "\n$", "").alias("text")).write.mode("overwrite").partitionBy("gene").text(path)


def _lists(genes: DataFrame, top: DataFrame) -> DataFrame:
    """gene and rows: the ranked pairs of every gene in order, none for those without."""
    rows = top.groupBy("gene").agg(F.sort_array(F.collect_list(F.struct("rank", *(c for c in top.columns if c not in ("gene", "rank"))))).alias("rows"))
    return genes.select("gene").distinct().join(rows, "gene", "left")


def delimited(genes: DataFrame, top: DataFrame, sep: str = ",") -> DataFrame:
    """gene and text: a header and the ranked pairs in order; the text is empty for genes without pairs."""
    names = [c for c in top.columns if c not in ("gene", "rank")]
    cell = lambda r, c: F.coalesce(r[c].cast("string"), F.lit(""))
    quoted = lambda x: F.when(x.rlike(f'["\r\n{sep}]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x)
    lines = F.transform("rows", lambda r: F.concat_ws(sep, *(quoted(cell(r, c)) for c in names)))
    text = F.concat(F.lit(sep.join(names) + "\n"), F.array_join(lines, "\n"), F.lit("\n"))
    return _lists(genes, top).select("gene", F.coalesce(F.when(F.size("rows") > 0, text), F.lit("")).alias("text"))


def write_delimited(genes: DataFrame, top: DataFrame, path: str, sep: str = ",") -> None:
    """One CSV or TSV file for each gene, in rank order; a gene without pairs has an empty line alone."""
    _whole(delimited(genes, top, sep), path)


def write_json_arrays(genes: DataFrame, top: DataFrame, path: str) -> None:
    """One JSON array for each gene, in rank order, `[]` for those without pairs; NaN becomes "NaN"."""
    text = F.coalesce(F.to_json(F.transform("rows", lambda r: r.dropFields("rank"))), F.lit("[]"))
    _whole(_lists(genes, top).select("gene", text.alias("text")), path)


def write_report(texts: DataFrame, path: str) -> None:
    """One text file for each gene of report.report: title, pairs in order and empty lines, as rendered."""
    _whole(texts, path)


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """gene and text of the files that these sinks write."""
    return spark.read.schema("value string, gene string").text(path, wholetext=True).select("gene", F.col("value").alias("text"))
