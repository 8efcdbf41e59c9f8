"""Mixing sources to target weights, in DataFrame functions only.

The documents of a source stand in the order of doc_id and make one stream of words, cut into blocks of BLOCK words
(the last may be shorter). A source's target is a share of all words by its weight, at most TIMES its own size; what
lies above is shared again by weight (filling to one level). Targets become quotas of blocks, and their sum is the
number of slots of the mix, SHARD slots to an output shard.

Each shard draws a multinomial count of its slots for each source: every slot falls, by a hash of its number, into one
of the intervals that the quotas cut from 0 to the number of slots. Running counts over the shards give each source's
slots numbers from 0. What a source was drawn beyond its quota goes to the sources that were drawn too rarely, number
by number, so all quotas are met exactly. Slot j of a source of n blocks is its pass j div n (at most TIMES) and takes
block p(j mod n), where p is a pseudorandom permutation of 0 .. n - 1 of that pass: four rounds of a Feistel network
over a x b >= n cells, walked on while it leads out of the range. Slots meet the blocks by (source, block).

Running sums are made by ranges of the order, so a source that holds most rows is spread; rows that repeat are rows of
their own. Everything follows from the rows' values, so reruns agree. Null and empty texts have size 0 and take nothing; null
source is a source of its own, the last one; a null doc_id comes first and stays null; sources without words have
target 0; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..operators.places import placed, summed
from .common import materialize

WEIGHTS = (5, 2, 1)
TIMES = 3
BLOCK = 64  # words
SHARD = 4096  # slots
SLOTS = 500_000  # of a task
SEED = "mix"
SPACE = "\\x20\\x09-\\x0D"
FEW = 50_000  # sources that are broadcast
_STEPS = 64  # half rounds of a walk, after the first four


def word_count(text: Column) -> Column:
    """Runs without ASCII white space: each is replaced, with the space around it, by one letter."""
    one = F.char_length(F.regexp_replace(text, f"[{SPACE}]*+[^{SPACE}]++[{SPACE}]*+", "w"))
    return F.coalesce(F.when(text.rlike(f"[^{SPACE}]"), one), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """A name that is never null."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))


def stream(docs: DataFrame, text: bool = False) -> DataFrame:
    """doc_id, key, size, and of each row its place in its source and the words before it (size_before), stored."""
    own = [F.col("text")] if text else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", _key(F.col("source")).alias("key"), word_count(F.col("text")).alias("size"), *own)
    return materialize(summed(materialize(rows, "op13-sizes"), ["key"], [F.col("doc_id"), F.col("size")], ("size",)), "op13-stream")


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """Of each source of `stream`: key, number, source_size, target, blocks and quota (of blocks), stored.

    By rising ratio of the most a source may give to its weight, a source is full if the level that the others would
    have without those before it reaches its ratio; the level is that of the first source that isn't.
    """
    sources = materialize(rows.groupBy("key", "source").agg(F.max("size_all").alias("source_size")), "op13-sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    s = placed(sources, [], [F.col("source").asc_nulls_last()], out="number").withColumns({"weight": weight.cast("long"), "most": F.col("source_size") * times})
    s = summed(materialize(s, "op13-weights"), [], [F.col("most") / F.col("weight"), F.col("number")], ("most", "weight", "source_size"))
    level = (F.col("source_size_all") - F.col("most_before")) / (F.col("weight_all") - F.col("weight_before"))
    s = materialize(s.withColumns({"level": level, "full": level >= F.col("most") / F.col("weight")}), "op13-levels")
    found = s.filter(~F.col("full")).agg(F.max("level")).first()[0] or 0.0
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.least(F.col("most").cast("double"), F.lit(found) * F.col("weight")))
    s = s.withColumns({"target": target, "blocks": F.ceil(F.col("source_size") / F.lit(block)).cast("long")})
    quota = F.when(F.col("source_size") == 0, 0).otherwise(F.least(F.col("blocks") * times, F.floor(F.col("target") / F.col("source_size") * F.col("blocks") + 0.5)))
    return materialize(s.select("key", "number", "source_size", "target", "blocks", quota.cast("long").alias("quota")), "op13-targets")


def draws(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """shard, key, number, blocks, quota, n: each shard's multinomial counts of its slots, stored."""
    cut = materialize(summed(sources.filter("quota > 0"), [], [F.col("number")], ("quota",)), "op13-intervals")
    last = cut.agg(F.max("quota_all").alias("slots"), F.count("*").alias("sources")).first()
    slots, width = last.slots or 0, max(1, -(-(last.slots or 0) // max(4096, 4 * last.sources)))
    bins = cut.withColumn("bin", F.explode(F.expr(f"sequence(quota_before div {width}, (quota_before + quota - 1) div {width})")))
    bins = materialize(bins.select("bin", "key", "number", "blocks", "quota", "quota_before"), "op13-bins")
    slot = sources.sparkSession.range(slots).select(F.expr(f"id div {shard}").alias("shard"), F.pmod(F.xxhash64(F.lit(SEED), F.col("id")), F.lit(max(1, slots))).alias("u"))
    met = slot.withColumn("bin", F.expr(f"u div {width}")).join(bins, "bin").filter("u >= quota_before AND u < quota_before + quota")
    return materialize(met.groupBy("shard", "key", "number", "blocks", "quota").agg(F.count("*").alias("n")), "op13-draws")


def slots(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """shard, key, number, blocks, j: all slots of the mix, those of a source numbered from 0 to its quota."""
    drawn = materialize(summed(draws(sources, shard), ["key"], [F.col("shard")], ("n",)), "op13-counts")
    kept = F.greatest(F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("n_before")))
    # a row here stands for up to `shard` slots
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, (sources.agg(F.sum("quota")).first()[0] or 0) // SLOTS)
    drawn = drawn.withColumn("kept", kept).repartition(parts, "shard", "key")
    own = drawn.filter("kept > 0").select("shard", "key", "number", "blocks", F.explode(F.expr("sequence(n_before, n_before + kept - 1)")).alias("j"))
    over = drawn.filter("n > kept").select("shard", "key", F.explode(F.expr("sequence(1L, n - kept)")).alias("i"))
    had = drawn.groupBy("key").agg(F.sum("kept").alias("had"))
    short = sources.join(had, "key", "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("quota > had")
    short = short.select("key", "number", "blocks", F.explode(F.expr("sequence(had, quota - 1)")).alias("j"))
    given = placed(materialize(over, "op13-over"), [], [F.col("shard"), F.col("key"), F.col("i")]).select("shard", "place")
    taken = placed(materialize(short, "op13-short"), [], [F.col("number"), F.col("j")])
    return own.unionByName(given.join(taken, "place").select(own.columns))


def _cell(number: str, lap: str, step: str, value: str) -> str:
    """A pseudorandom whole number of 32 bits."""
    return f"cast(conv(substr(md5(concat_ws(':', '{SEED}', {number}, {lap}, {step}, {value})), 1, 8), 16, 10) as bigint)"


def permuted(rows: DataFrame) -> DataFrame:
    """Add `block` to rows (number, blocks, j): the place of j mod blocks in the permutation of its pass."""
    p = rows.withColumns({"lap": F.expr("j div blocks"), "_x": F.expr("j % blocks"), "_a": F.ceil(F.sqrt("blocks")).cast("long")})
    p = p.withColumn("_b", F.expr("(blocks + _a - 1) div _a")).withColumns({"_l": F.expr("_x div _b"), "_r": F.expr("_x % _b")})
    for i, (to, by, size) in enumerate((("_l", "_r", "_a"), ("_r", "_l", "_b")) * 2):
        p = p.withColumn(to, F.expr(f"({to} + {_cell('number', 'lap', str(i), by)}) % {size}"))
    p = p.withColumn("_y", F.expr("_l * _b + _r"))
    left = f"(s.l + {_cell('number', 'lap', 'i % 4', 's.r')}) % _a"
    right = f"(s.r + {_cell('number', 'lap', 'i % 4', 's.l')}) % _b"
    step = f"""CASE WHEN s.done THEN s
        WHEN i % 4 = 0 AND s.l * _b + s.r < blocks THEN named_struct('l', s.l, 'r', s.r, 'done', true)
        WHEN i % 2 = 0 THEN named_struct('l', {left}, 'r', s.r, 'done', false) ELSE named_struct('l', s.l, 'r', {right}, 'done', false) END"""
    walk = f"aggregate(sequence(0, {_STEPS}), named_struct('l', _l, 'r', _r, 'done', false), (s, i) -> {step}, s -> CASE WHEN s.done THEN s.l * _b + s.r ELSE cast(raise_error('permuted: a walk did not end') as bigint) END)"
    return p.withColumn("block", F.expr(f"CASE WHEN _y < blocks THEN _y ELSE {walk} END")).drop("_a", "_b", "_l", "_r", "_x", "_y")


def pieces(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Of each row of `stream` with words: the blocks that hold some of them, the first word (from 0) and how many."""
    p = rows.filter("size > 0").withColumn("block", F.explode(F.expr(f"sequence(size_before div {block}, (size_before + size - 1) div {block})")))
    return p.withColumn("first", F.expr(f"greatest(0L, block * {block} - size_before)")).withColumn("words", F.expr(f"least(size, (block + 1) * {block} - size_before) - first"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, times: int = TIMES, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """doc_id, size, source_size, target and taken (words of the document in the mix, repeats counted) of every row."""
    rows = stream(docs)
    sources = targets(rows, weights, times, block)
    taken = permuted(slots(sources, shard)).groupBy("key", "block").agg(F.count("*").alias("uses"))
    own = ["key", "place", "doc_id", "size"]
    parts = pieces(rows, block).join(taken, ["key", "block"], "left").groupBy(own).agg(F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken"))
    all_rows = parts.unionByName(rows.filter("size = 0").select(*own, F.lit(0).cast("long").alias("taken")))
    out = spread_join(all_rows, sources.select("key", "source_size", "target"), ["key"], most=FEW)
    return out.select("doc_id", "size", "source_size", "target", "taken")


def mixed_texts(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, times: int = TIMES, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The mix itself: shard, source (a key, `=` and its name, empty for null), pass, block, doc_ids and text of every
    slot; the words of a block stand apart by one space."""
    rows = stream(docs, text=True)
    found = permuted(slots(targets(rows, weights, times, block), shard))
    words = F.split(F.regexp_replace("text", f"^[{SPACE}]+", ""), f"[{SPACE}]+")
    cut = F.array_join(F.slice(words, (F.col("first") + 1).cast("int"), F.col("words").cast("int")), " ")
    parts = pieces(rows, block).select("key", "block", F.struct("place", "doc_id", cut.alias("text")).alias("part"))
    whole = parts.groupBy("key", "block").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    out = found.join(whole, ["key", "block"])
    return out.select("shard", F.col("key").alias("source"), F.col("lap").alias("pass"), "block", F.col("parts.doc_id").alias("doc_ids"), F.array_join("parts.text", " ").alias("text"))


def _sql_cell(step: int, value: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(':', '{SEED}', number, lap, {step}, {value})), 1, 8) AS BIGINT)"


def _sql_rounds() -> str:
    """The four half rounds as tables c1 .. c4 of c0(l, r, a, b)."""
    out = []
    for i, (to, by, size) in enumerate((("l", "r", "a"), ("r", "l", "b")) * 2):
        out.append(f"c{i + 1} AS (SELECT * REPLACE (({to} + {_sql_cell(i, by)}) % {size} AS {to}) FROM c{i})")
    return ", ".join(out)


#: The same targets, blocks and permutations. The shards' draws don't show in it: they settle where a slot lies, not
#: how many a source has.
SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+')) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS number FROM s0),
s2 AS (SELECT *, {list(WEIGHTS)}[number % {len(WEIGHTS)} + 1] AS weight, {TIMES} * source_size AS most FROM s1),
s3 AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER w, 0) AS DOUBLE) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS level
       FROM s2 WINDOW w AS (ORDER BY most / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, CASE WHEN level >= most / weight THEN CAST(most AS DOUBLE) ELSE least(CAST(most AS DOUBLE), (SELECT max(level) FROM s3 WHERE level < most / weight) * weight) END AS target, CAST(ceil(source_size / {BLOCK}) AS BIGINT) AS blocks FROM s3),
s AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(least(blocks * {TIMES}, floor(target / source_size * blocks + 0.5)) AS BIGINT) END AS quota, CAST(ceil(sqrt(blocks)) AS BIGINT) AS a FROM s4),
c00 AS (SELECT number, blocks, quota, a, (blocks + a - 1) // a AS b FROM s WHERE blocks > 0),
c01 AS (SELECT *, unnest(range({TIMES})) AS lap FROM c00),
c02 AS (SELECT *, unnest(range(a * b)) AS x FROM c01 WHERE quota > lap * blocks),
c0 AS (SELECT *, x // b AS l, x % b AS r FROM c02),
{_sql_rounds()},
cells AS (SELECT number, lap, blocks, quota, x, l * b + r AS y FROM c4),
walk AS (SELECT * FROM cells WHERE x < blocks UNION ALL SELECT w.number, w.lap, w.blocks, w.quota, w.x, c.y FROM walk w JOIN cells c ON c.number = w.number AND c.lap = w.lap AND c.x = w.y WHERE w.y >= w.blocks),
uses AS (SELECT number, y AS block, count(*) AS uses FROM walk WHERE y < blocks AND lap * blocks + x < quota GROUP BY number, y),
p0 AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, size, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM d),
p1 AS (SELECT rid, number, start, size, unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) AS block FROM p0 JOIN s ON p0.source IS NOT DISTINCT FROM s.source WHERE size > 0),
taken AS (SELECT rid, sum((least(start + size, (block + 1) * {BLOCK}) - greatest(start, block * {BLOCK})) * uses) AS taken FROM p1 JOIN uses USING (number, block) GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source LEFT JOIN taken USING (rid)
"""
