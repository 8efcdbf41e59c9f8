"""Exact dedup by a tree-merge of sorted digest runs.

Every block of rows makes one run: its distinct digests in order, each with the best row, the count and the size
of the normalised text. In each round 2^BITS blocks exchange slices of their runs (the next BITS bits of the digest
say who gets which) and each merges the slices it received, keeping the best row of every verified text; so the
number of runs stays, a run's share of the digests shrinks as fast as the blocks it covers grow, and after
log(blocks) rounds each run holds a range of digests, complete. The answers go back by (block, digest): a text that
a third of all rows share is one entry in each run and a bounded number of rows in each block.

Two rows count as equal if SHA-256 and byte length of their normalised texts agree, checked at every level. Null
texts count as empty; repeated rows are rows of their own. The row that stays has the most code points, then the
smallest doc_id, null last; `kept` marks the rows of that id (or without one, if such a row has the most) and of that
many code points, so of rows that share the id only the longest stay, and rows equal in both all do; rows without
doc_id are left out or, as in the query and the pipeline, count as
rows whose id sorts last; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions_for, small_batches

BITS = 3  # 8 runs meet in a merge
SPACE = "[ \\t-\\r]+"
RUN = "node long, prefix long, keys binary, chars binary, ids binary, counts binary"
_RUN = pa.schema([("node", pa.int64()), ("prefix", pa.int64()), *((c, pa.binary()) for c in ("keys", "chars", "ids", "counts"))])


def _merge_runs(keys: np.ndarray, chars: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """One entry for each key of the runs that follow each other, in order: most characters, then the smallest id,
    null last; counts are summed.

    The stable sort finds the sorted runs and merges them. chars is twice the number of characters, and one more
    where there is an id.
    """
    order = np.argsort(keys, kind="stable")
    keys, chars, ids = keys[order], chars[order], ids[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    if not len(at):
        return keys, chars, ids, counts
    most = np.maximum.reduceat(chars, at)
    best = np.repeat(most, np.diff(np.append(at, len(keys)))) == chars
    return keys[at], most, np.minimum.reduceat(np.where(best, ids, np.iinfo(np.int64).max), at), np.add.reduceat(counts[order], at)


def _row(node: int, prefix: int, run: tuple[np.ndarray, ...]) -> list:
    return [node, prefix, *(x.tobytes() for x in run)]


def _arrays(row: dict) -> tuple[np.ndarray, ...]:
    return np.frombuffer(row["keys"], "S40"), *(np.frombuffer(row[c], "<i8") for c in ("chars", "ids", "counts"))


def _batch(rows: list[list]) -> list[pa.Array]:
    return [pa.array(c, f.type) for c, f in zip(zip(*rows), _RUN)] if rows else [pa.array([], f.type) for f in _RUN]


def _cut(node: int, prefix: int, run: tuple[np.ndarray, ...], done: int) -> pa.Table:
    """A run cut by the digest's bits done .. done + BITS, each slice addressed to the merge that takes it."""
    head = np.ascontiguousarray(run[0]).view(np.uint8).reshape(-1, 40)[:, :8].copy().view(">u8").ravel()
    which = (head >> np.uint64(64 - done - BITS)) & np.uint64((1 << BITS) - 1)
    cuts = np.searchsorted(which, np.arange((1 << BITS) + 1, dtype=np.uint64))
    rows = [_row(node >> BITS, prefix << BITS | i, tuple(x[a:b] for x in run)) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
    return pa.Table.from_arrays(_batch(rows), schema=_RUN)


def _make_run(table: pa.Table) -> pa.Table:
    """The sorted run of one block, cut for the first round."""
    keys = np.array(table.column("key").to_pylist(), "S40")
    chars, ids = (table.column(c).fill_null(0).to_numpy().astype("<i8") for c in ("chars", "doc_id"))
    return _cut(table.column("block")[0].as_py(), 0, _merge_runs(keys, chars, ids, np.ones(len(keys), "<i8")), 0)


def _merged(table: pa.Table) -> tuple[np.ndarray, ...]:
    return _merge_runs(*(np.concatenate(x) for x in zip(*map(_arrays, table.to_pylist()))))


def _merge(done: int):
    """Merge the slices of one range and cut the run for the next round."""

    def run(table: pa.Table) -> pa.Table:
        return _cut(table.column("node")[0].as_py(), table.column("prefix")[0].as_py(), _merged(table), done)

    return run


def _finish(table: pa.Table) -> pa.Table:
    """The last round: the entries of a complete range."""
    keys, chars, ids, counts = _merged(table)
    data = keys.tobytes()
    return pa.table({"key": pa.array([data[i : i + 40] for i in range(0, len(data), 40)], pa.binary()), "keep_id": pa.array(ids, mask=chars % 2 == 0), "most": pa.array(chars), "group_size": pa.array(counts)})


def dedup(docs: DataFrame, block_bytes: int = 1 << 20, least_blocks: int = 64, null_ids: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of `docs` (doc_id, text).

    With `null_ids` rows without doc_id count and are returned, else they are left out.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    own = F.regexp_replace(text, SPACE, "")
    rows = (docs if null_ids else docs.filter("doc_id IS NOT NULL")).select(F.col("doc_id").cast("long").alias("doc_id"), (2 * F.char_length(text).cast("long") + F.col("doc_id").isNotNull().cast("long")).alias("chars"), own.alias("own"))
    # sha2 gives hex; the key is the digest and the size, 40 bytes that order as numbers do
    key = F.concat(F.unhex(F.sha2("own", 256)), F.unhex(F.lpad(F.hex(F.octet_length("own").cast("long")), 16, "0")))
    rows = materialize(rows.select("doc_id", "chars", key.alias("key")), "op7-digests")
    wanted, bits = max(least_blocks, partitions_for(rows, block_bytes)), 0
    while 1 << bits < wanted:
        bits += BITS
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "key"), F.lit(1 << bits)))
    runs = rows.groupBy("block").applyInArrow(_make_run, RUN)
    for done in range(BITS, bits, BITS):
        runs = runs.groupBy("node", "prefix").applyInArrow(_merge(done), RUN)
    best = runs.groupBy("node", "prefix").applyInArrow(_finish, "key binary, keep_id long, most long, group_size long")
    answers = rows.select("block", "key").distinct().join(best, "key")
    out = rows.join(answers, ["block", "key"])
    return out.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("most"))).alias("kept"), F.lower(F.hex(F.substring("key", 1, 32))).alias("text_sha256"))


def keep(docs: DataFrame) -> DataFrame:
    """One row of `docs` for each text, with all columns: most characters, then the smallest doc_id, null last.

    Null and empty texts, and those of white space only, are one text. Of rows that repeat that doc_id and text one
    stays (by hashes of text and row). Columns may have any names; an empty table stays empty. The choice is made on
    digests and hashes; then each row meets it by its own hashes, so texts are shuffled once and a text that many
    rows share is spread.
    """
    found = dedup(docs.select("doc_id", "text"), null_ids=True).filter("doc_id <=> keep_id").select("text_sha256", F.col("keep_id").alias("__keep_id")).distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]  # Spark hashes no maps
    rows = docs.select(row.alias("row"), F.sha2(F.regexp_replace(text, SPACE, ""), 256).alias("sha"), F.xxhash64(text).alias("h"), F.xxhash64(*hashed).alias("r"))
    light = rows.select("sha", "h", "r", F.col("row.doc_id").cast("long").alias("id"), F.char_length(F.coalesce("row.text", F.lit(""))).alias("n"))
    own = light.join(found, (F.col("sha") == F.col("text_sha256")) & F.col("id").eqNullSafe(F.col("__keep_id")))
    best = materialize(own.groupBy("sha").agg(F.max(F.struct("n", "h", "r")).alias("best")).select("sha", "best.h", "best.r"), "op7-best")
    return rows.join(best, ["sha", "h", "r"]).groupBy("sha", "h", "r").agg(F.first("row").alias("row")).select("row.*")


SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS h FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST) AS keep_id, max(n) OVER (PARTITION BY h) AS most, count(*) OVER (PARTITION BY h) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND n = most AS kept, h AS text_sha256 FROM g
"""
