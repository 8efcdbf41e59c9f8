"""URL filters as a sort-merge range join.

A rule (host, path) becomes the interval of keys that begin with `reversed host \\0 path`. A url has one key for
its host and each parent domain of it. Urls and rules are range-partitioned and sorted by key together; in each
partition a sweep keeps a stack of the active nested rules, whose top is the longest rule that holds the key.
Rules that began in an earlier partition are found by an equi-join of the prefixes of each partition's first key.
Only distinct urls are swept, so a url that many pages share costs one sweep; keys of a hot host spread by path. The
verdicts of urls that stand often are broadcast (at most OFTEN of them), so pages of one url, or without one, need no
one task.

A null url or one without `://` has empty host and path and no rule. The verdict without a rule is the method's:
allow. A null page_id stays null. Of several fitting rules the one with the longest text wins; of equal rules, block. Repeated pages give
repeated rows; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions_for

#: (verdict, host/path)
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
OFTEN = 1000
_SWEPT = "url string, rule string, verdict string"


def with_host_path(pages: DataFrame) -> DataFrame:
    """Add host and path to a table with a url column."""
    rest = F.when(F.expr("instr(url, '://') > 0"), F.expr("substring_index(substring_index(substring(url, instr(url, '://') + 3), '#', 1), '?', 1)")).otherwise(F.lit(""))
    slash = F.expr("instr(rest, '/')")
    host = F.when(slash > 0, F.expr("left(rest, instr(rest, '/') - 1)")).otherwise(F.col("rest"))
    path = F.when(slash > 0, F.expr("substring(rest, instr(rest, '/'))")).otherwise(F.lit(""))
    return pages.withColumn("rest", rest).withColumn("host", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn("path", path).drop("rest")


def _key(labels, path):
    return F.concat(F.translate(F.array_join(F.reverse(labels), "."), "\0", "\x01"), F.lit("\0"), path)


def _sweep(table: pa.Table) -> pa.Table:
    """One partition in key order: rules (kind 0) enter before urls (kind 1) of the same key."""
    keys = [k.encode() for k in table.column("key").to_pylist()]
    kind, url = table.column("kind").to_pylist(), table.column("url").to_pylist()
    rule, verdict = table.column("rule").to_pylist(), table.column("verdict").to_pylist()
    stack: list[int] = []
    out = []
    for i in sorted(range(len(keys)), key=lambda i: (keys[i], kind[i], verdict[i] == "block")):
        while stack and not keys[i].startswith(keys[stack[-1]]):
            stack.pop()
        if kind[i] == 0:
            stack.append(i)
        elif stack:
            out.append((url[i], rule[stack[-1]], verdict[stack[-1]]))
    cols = list(zip(*out)) if out else [[], [], []]
    return pa.table([pa.array(c, pa.string()) for c in cols], names=["url", "rule", "verdict"])


def judge(pages: DataFrame, rules: DataFrame, partition_bytes: int = 4 << 20) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of `pages` (page_id, url); `rules` has rule and verdict."""
    pages = with_host_path(pages.select("page_id", "url"))
    named = "url IS NOT NULL AND host != ''"
    counted = pages.filter(named).groupBy("url", "host", "path").agg(F.count("*").alias("n"))
    urls = counted.select("url", "host", "path")
    labels = F.split("host", "\\.")
    own = urls.withColumn("labels", labels).select("url", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.slice("labels", -i, i))).alias("part_of"))
    none = F.lit(None).cast("string")
    own = own.select(_key(F.col("part_of"), F.col("path")).alias("key"), F.lit(1).alias("kind"), "url", none.alias("rule"), none.alias("verdict"))
    starts = rules.withColumn("h", F.substring_index("rule", "/", 1)).select(_key(F.split(F.lower("h"), "\\."), F.expr("substring(rule, length(h) + 1)")).alias("key"), F.lit(0).alias("kind"), none.alias("url"), "rule", "verdict")
    events = own.unionByName(starts)
    ranged = events.repartitionByRange(partitions_for(pages, partition_bytes, 8), "key", "url").withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "op4-events")
    first = ranged.groupBy("part").agg(F.min("key").alias("first"))
    inside = first.select("part", F.explode(F.expr("transform(sequence(1, length(first)), i -> left(first, i))")).alias("key"))
    # a rule of the partition itself may come twice so; the stack then holds it twice, which changes nothing
    carried = inside.join(starts, "key").select(ranged.columns)
    swept = ranged.unionByName(carried).groupBy("part").applyInArrow(_sweep, _SWEPT)
    best = swept.groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), (F.col("verdict") == "block").alias("b"), "rule", "verdict")).alias("best"))
    best = materialize(best, "op4-best")
    # urls of more than one in OFTEN of all rows, of which there are at most OFTEN, are broadcast
    often = materialize(counted.filter(F.col("n") * OFTEN > pages.count()).select("url"), "op4-often")
    named, rest = pages.filter(named), pages.filter(f"NOT ({named})")
    out = named.join(F.broadcast(often.join(best, "url", "left")), "url")
    out = out.unionByName(named.join(F.broadcast(often), "url", "left_anti").join(best, "url", "left"))
    out = out.unionByName(rest.withColumn("best", F.lit(None).cast(best.schema["best"].dataType)))
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))


SQL = """
WITH cut AS (SELECT page_id, CASE WHEN url IS NOT NULL AND strpos(url, '://') > 0
                                  THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, translate(CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, 1, strpos(rest, '/') - 1) ELSE rest END,
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM cut),
rules(verdict, rule, rh, rp) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
                                        ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
hit AS (SELECT hp.page_id, hp.host, hp.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
        FROM (SELECT DISTINCT * FROM hp) hp JOIN rules r ON (hp.host = r.rh OR ends_with(hp.host, '.' || r.rh)) AND starts_with(hp.path, r.rp)
        GROUP BY ALL)
SELECT hp.page_id, hp.host, hp.path, hit.rule, coalesce(hit.verdict, 'allow') AS verdict
FROM hp LEFT JOIN hit ON hp.page_id IS NOT DISTINCT FROM hit.page_id AND hp.host = hit.host AND hp.path = hit.path
"""
