"""Places and running sums over an order, by ranges of it: no task holds more than a range, whatever the groups."""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

#: Rows of a range.
EACH = 250_000


def ranges(rows: DataFrame, by: list[str], order: list, each: int = EACH, most: int = 100_000) -> DataFrame:
    """`rows`, stored, with `_part` (a range of the order within the groups) and `_pos` (the place within the range).

    `rows` must be a stored table, or one that gives the same rows whenever it is read: it is counted, sampled for
    the limits of the ranges, and dealt. Equal rows may have any order among themselves, and may be dealt to several
    ranges, so a value that very many rows share makes no large range.
    """
    n = min(most, 1 + rows.count() // each)
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    keys = [*(F.col(c) for c in by), *order, F.col("_salt")]
    dealt = salted.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_salt")
    pos = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return stored(dealt.select("*", F.spark_partition_id().alias("_part"), pos.alias("_pos")), "ranges")


def offsets(ranged: DataFrame, by: list[str], sums: tuple[str, ...] = ()) -> DataFrame:
    """For each range and group of `ranges`: `_first` (the group's first `_pos` there), `_rows` (rows of the group in
    earlier ranges), `_all` (in all), and for each column of `sums` its totals `_rows_c` and `_all_c` likewise.

    As many rows as ranges and groups together; one group has at most as many as there are ranges.
    """
    names = ["", *(f"_{c}" for c in sums)]
    totals = ranged.groupBy("_part", *by).agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"), *(F.sum(c).alias(f"_n_{c}") for c in sums))
    if not by:
        return _overall(totals, names)
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    for c in names:
        totals = totals.withColumns({f"_rows{c}": F.coalesce(F.sum(f"_n{c}").over(before), F.lit(0)), f"_all{c}": F.sum(f"_n{c}").over(whole)})
    return totals.drop(*(f"_n{c}" for c in names))


def _overall(totals: DataFrame, names: list[str]) -> DataFrame:
    """The offsets of one group: its few totals, a row for each range, are added up on the driver."""
    rows = sorted(totals.collect(), key=lambda r: r["_part"])
    add = lambda c: list(accumulate((r[f"_n{c}"] or 0 for r in rows), initial=0))
    columns = {"_part": [r["_part"] for r in rows], "_first": [r["_first"] for r in rows]}
    kinds = {"_part": "int", "_first": "bigint"}
    for c in names:
        up = add(c)
        columns |= {f"_rows{c}": up[:-1], f"_all{c}": up[-1:] * len(rows)}
        kinds |= dict.fromkeys((f"_rows{c}", f"_all{c}"), totals.schema[f"_n{c}"].dataType.simpleString())
    text = json.dumps([dict(zip(columns, values)) for values in zip(*columns.values())])
    schema = "array<struct<" + ", ".join(f"{c}: {k}" for c, k in kinds.items()) + ">>"
    return totals.sparkSession.range(1).select(F.inline(F.from_json(F.lit(text), schema)))


def same(a: str, b: str, columns: list[str]) -> Column:
    """Null-safe equality of columns of two aliased tables."""
    out = F.lit(True)
    for c in columns:
        out &= F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def placed(rows: DataFrame, by: list[str], order: list, out: str = "place", each: int = EACH, total: str | None = None) -> DataFrame:
    """Add the place of each row, from 0, in the given order within `by` (or overall), and as `total` the group's rows."""
    ranged = ranges(rows, by, order, each)
    starts = offsets(ranged, by)
    found = ranged.alias("a").join(starts.alias("b"), (F.col("a._part") == F.col("b._part")) & same("a", "b", by))
    return found.select("a.*", (F.col("_pos") - F.col("_first") + F.col("_rows")).alias(out), *([F.col("_all").alias(total)] if total else [])).drop("_part", "_pos")


def summed(rows: DataFrame, by: list[str], order: list, sums: tuple[str, ...], each: int = EACH) -> DataFrame:
    """As placed, with `total`, and for each whole-number column c of `sums` its sum over the rows before (`c_before`)
    and over the group (`c_all`). Sums within a range are made range by range."""
    ranged = ranges(rows, by, order, each)
    starts = offsets(ranged, by, sums)
    found = ranged.alias("a").join(starts.alias("b"), (F.col("a._part") == F.col("b._part")) & same("a", "b", by)).select("a.*", *(F.col(f"b.{c}") for c in starts.columns if c != "_part" and c not in by))
    before = Window.partitionBy("_part", *by).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    out = found.withColumns({f"{c}_before": (F.coalesce(F.sum(c).over(before), F.lit(0)) + F.col(f"_rows_{c}")).cast("long") for c in sums})
    out = out.withColumns({"place": F.col("_pos") - F.col("_first") + F.col("_rows"), "total": F.col("_all")} | {f"{c}_all": F.col(f"_all_{c}").cast("long") for c in sums})
    return out.drop("_part", "_pos", *(c for c in starts.columns if c not in by))
