"""Inputs of the registered queries, derived by Spark from the whole `documents` table: a gene is a language, an
alignment row a document whose bases follow from arithmetic on its id, a raw record the DNA letters of its text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import spread
from ..params import Scoring

COLUMNS = 240
#: Other weights and scales than the defaults.
WEIGHTED = Scoring(coverage=0.3, prime3=0.25, specificity=0.15, thermo=0.2, amplicon=0.1, tm_balance=0.4, gc=0.1, tm_diff_bad=3.0, gc_target=45.0, hairpin_good=20.0, hairpin_bad=50.0, preferred_min=60, preferred_max=100, allowed_max=180)


def _gene():
    """A document's language; those without one are a gene of their own."""
    return F.coalesce("lang", F.lit("none")).alias("gene")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def msa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene, seq_idx, id, aligned."""
    # a row is a few bytes here and 240 bases to compute
    docs = spread(documents(spark, sf_dir).select(_gene(), F.col("doc_id").cast("long").alias("seq_idx")), "seq_idx")
    rows = docs.mapInArrow(_align, "gene string, seq_idx long, aligned string")
    return rows.select("gene", "seq_idx", F.concat(F.lit("subj"), F.col("seq_idx")).alias("id"), "aligned")


def _template(gene: str) -> list[int]:
    return [int(hashlib.md5(f"{gene}:{c}".encode()).hexdigest()[0], 16) % 4 for c in range(COLUMNS)]


def _bases(ids: list[int | None], templates: np.ndarray) -> list[str]:
    """The template of each document with the changes that follow from its id; remainders have the sign of what is
    divided, as in SQL, and without an id nothing changes."""
    none = np.array([i is None for i in ids])
    few = all(i is None or abs(i) < 1 << 48 for i in ids)  # else the products need more than 64 bits
    doc = np.array([i or 0 for i in ids], np.int64 if few else object)[:, None]
    c = np.arange(COLUMNS)
    x = doc * (7919 + 31 * (c if few else c.astype(object))) + 104729 * c
    r = (np.where(x < 0, -1, 1) * (abs(x) % 997)).astype(np.int64)
    r[none] = 50  # a remainder that changes nothing
    low = np.fmod(r, 100)
    base = np.fmod(templates + np.where((c % 40 >= 30) & (low < 40) | (low < 3), 1 + np.fmod(r, 3), 0), 4)
    out = np.frombuffer(b"ACGT", "S1")[np.maximum(base, 0)]
    out[np.fmod(r, 503) == 2] = b"N"
    out[np.fmod(r, 211) == 1] = b"-"
    return [s.decode() for s in out.view(f"S{COLUMNS}").ravel().tolist()]


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list[int]] = {}
    for given in batches:
        for lo in range(0, len(given), 1000):
            batch = given.slice(lo, 1000)
            genes = batch.column("gene").to_pylist()
            for g in set(genes) - known.keys():
                known[g] = _template(g)
            aligned = _bases(batch.column("seq_idx").to_pylist(), np.array([known[g] for g in genes]))
            yield pa.RecordBatch.from_arrays([batch.column("gene"), batch.column("seq_idx"), pa.array(aligned)], names=["gene", "seq_idx", "aligned"])


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene, seq_idx, id, description, seq."""
    d = documents(spark, sf_dir).withColumn("gene", _gene())
    i = F.concat(F.lit("doc"), F.col("doc_id"))
    description = F.concat(i, F.lit(" [gene="), F.col("gene"), F.lit("] "), F.col("source"), F.when(F.col("doc_id") % 17 == 0, F.lit(" partial=True")).otherwise(F.lit("")))
    return d.select("gene", F.col("doc_id").alias("seq_idx"), i.alias("id"), description.alias("description"), F.regexp_replace(F.upper("text"), "[^ACGTN]", "").alias("seq"))
