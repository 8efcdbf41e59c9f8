"""Exact top-k inner products by a three-phase uniform threshold.

Vectors are cut into SLICES runs of components; a list is the partial scores of one slice in one block of
candidates.
1. Every list gives its local top k; their whole scores are resolved in place, and the k-th best of them over all
   lists is a safe cutoff for the query, since k candidates reach it.
2. The cutoff goes with the queries to every block. A candidate that reaches it has a partial score of at least
   cutoff / SLICES in some list; those entries are collected.
3. Their whole scores are resolved exactly, those under the cutoff go, the rest are ranked.

Queries and candidates meet in blocks (a stated query set against all rows); rows leave a block only as its best k. The
queries go to groups of blocks by a shuffle, never by a broadcast, and vectors travel in as few bytes as their components need.
Components become floor(256 x) as whole numbers. Vectors that are null, or hold a null or non-finite component, and
rows without vec_id take no part; vectors of unequal length are compared as if the shorter ended in zeros; an empty
vector scores 0. Scores are whole numbers of 64 bits: a component of which a vector's length times its square
doesn't fit fails the job that meets it. An empty table gives no rows. A repeated query id asks once, with the least of its vectors (component by component, in order);
repeated candidates are candidates of their own; a row with the query's own id is not its candidate. Ties go to the smaller vec_id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_batches

SLICES = 4
_NONE = np.iinfo(np.int64).min


def quantise(rows: DataFrame) -> DataFrame:
    """vec_id and v (array of long); rows that take no part are dropped."""
    x = F.col("embedding")
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull()).filter(ok)
    # 2^62 / size bounds a square of which `size` fit, with room for the floor
    fits = F.forall(x, lambda c: F.abs(c.cast("double") * 256) < F.sqrt(F.lit(2.0**62) / F.greatest(F.lit(1), F.size(x))))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fits, whole).otherwise(F.raise_error(F.concat(F.lit("top_k: a component is too large for whole scores in vec_id "), F.col("vec_id"))).cast("array<bigint>")).alias("v"))


def _matrix(table: pa.Table, name: str = "v") -> np.ndarray:
    col = table.column(name).combine_chunks()
    size = col.value_lengths().to_numpy(zero_copy_only=False)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    if len(size) and (size == size[0]).all():
        return flat.reshape(len(size), size[0])
    out = np.zeros((len(size), size.max(initial=0)), np.int64)
    at = 0
    for i, n in enumerate(size):
        out[i, :n], at = flat[at : at + n], at + n
    return out


def _pack(table: pa.Table) -> pa.Table:
    """The vectors of one block in one row."""
    m = _matrix(table)
    cut = table.column("cut").to_numpy() if "cut" in table.column_names else np.full(len(m), _NONE)
    kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if not m.size or np.iinfo(k).min <= m.min() and m.max() <= np.iinfo(k).max)
    return pa.table({"block": table.column("block")[:1], "ids": pa.array([table.column("vec_id").to_numpy().astype("<i8").tobytes()], pa.binary()), "cuts": pa.array([cut.astype("<i8").tobytes()], pa.binary()), "dim": pa.array([m.shape[1]], pa.int32()), "data": pa.array([m.astype(kind).tobytes()], pa.binary())})


def _unpack(data: bytes, n: int, dim: int) -> np.ndarray:
    """The vectors of a block as whole numbers of 64 bits."""
    return np.frombuffer(data, f"<i{len(data) // max(1, n * dim) or 8}").astype(np.int64).reshape(n, dim)


_PACKED = "block long, ids binary, cuts binary, dim int, data binary"


def blocks(vectors: DataFrame, n: int) -> DataFrame:
    return vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n))).groupBy("block").applyInArrow(_pack, _PACKED)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of whole numbers as whole numbers: by floating point where that is exact."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] >= 2**52:
        return a @ b.T
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)


def _best(q: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best entries of each query."""
    order = np.lexsort((vec, -score, q))
    q = q[order]
    first = np.concatenate(([True], q[1:] != q[:-1])) if len(q) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    place = np.arange(len(q)) - np.repeat(at, np.diff(np.concatenate((at, [len(q)]))))
    return order[place < k]


def _phase(k: int, collect: bool, at_once: int = 128):
    """Phase 1 (local top k of each list, resolved) or, with `collect`, phases 2 and 3, for a pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                qid, cid, cut = (np.frombuffer(row[c], "<i8") for c in ("q_ids", "ids", "q_cuts"))
                q, c = _unpack(row["q_data"], len(qid), row["q_dim"]), _unpack(row["data"], len(cid), row["dim"])
                dim = max(1, q.shape[1], c.shape[1])
                q, c = (np.pad(x, ((0, 0), (0, dim - x.shape[1]))) for x in (q, c))
                parts = np.array_split(np.arange(dim), min(SLICES, dim))
                out = []
                for lo in range(0, len(qid), at_once):
                    qs, ids, cuts = q[lo : lo + at_once], qid[lo : lo + at_once], cut[lo : lo + at_once]
                    own = ids[:, None] == cid[None, :]
                    chosen = np.zeros(own.shape, bool)
                    for p in parts:
                        partial = _exact(qs[:, p], c[:, p])
                        if collect:
                            # a whole score of at least `cut` has a partial one of at least cut / lists
                            chosen |= partial >= -((-cuts[:, None]) // len(parts))
                        else:
                            partial[own] = _NONE
                            n = min(k, len(cid))
                            top = np.argpartition(-partial, n - 1, axis=1)[:, :n]
                            np.put_along_axis(chosen, top, True, axis=1)
                    i, j = np.nonzero(chosen & ~own)
                    score = np.einsum("ij,ij->i", qs[i], c[j])
                    if collect:
                        ok = score >= cuts[i]
                        i, j, score = i[ok], j[ok], score[ok]
                    keep = _best(i, cid[j], score, k)
                    out.append((ids[i[keep]], cid[j[keep]], score[keep]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["query_id", "vec_id", "score"])

    return run


def _meet(queries: DataFrame, candidates: DataFrame, n: int, alone: int = 64, together: int = 8) -> DataFrame:
    """Every block of queries at every block of candidates. Queries go once to each group of candidate blocks: single ones
    up to `alone`, then up to `together`. A broadcast would hold them on the driver, once for each group: its estimate is
    made before they are repeated."""
    groups = min(n, max(alone, -(-n // together)))
    group = lambda df: df.repartition(groups, "group")
    q = queries.select(F.col("ids").alias("q_ids"), F.col("cuts").alias("q_cuts"), F.col("dim").alias("q_dim"), F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")).alias("group"))
    c = candidates.withColumn("group", F.col("block") % groups)
    return group(q).hint("merge").join(group(c), "group").select("q_ids", "q_cuts", "q_dim", "q_data", "ids", "dim", "data")


def top_k(rows: DataFrame, is_query, k: int = 5, query_block: int = 1024, block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each row for which `is_query` holds."""
    small_batches(rows.sparkSession)
    vectors = materialize(quantise(rows), "op10-vectors")
    asked = materialize(vectors.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), "op10-asked")
    n, n_q = -(-vectors.count() // block) or 1, -(-asked.count() // query_block) or 1
    candidates = materialize(blocks(vectors, n), "op10-blocks")
    out = "query_id long, vec_id long, score long"
    local = _meet(blocks(asked, n_q), candidates, n).mapInArrow(_phase(k, False), out)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    cutoff = local.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("cut"))
    cut = asked.join(cutoff, "vec_id", "left").withColumn("cut", F.coalesce("cut", F.lit(-(1 << 62))))
    found = _meet(blocks(cut, n_q), candidates, n).mapInArrow(_phase(k, True), out)
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM (SELECT vec_id, min(q) AS q FROM v GROUP BY vec_id) a JOIN v b ON a.vec_id != b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
