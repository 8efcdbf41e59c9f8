"""Secret scans with multipart credential linking, in DataFrame functions only.

Base spans are the matches of three patterns. Java's split gives the gaps between matches and regexp_extract_all
the matches, so their running lengths are the code-point positions. Weak candidates (an unlabelled 40-character
secret, an endpoint) say little alone; an interval join by (row, bin of positions) keeps those that lie within the
scope of an access identifier, and an endpoint also within that of an assigned secret.

Null texts count as empty (no spans; the digest is that of the empty string); a null doc_id stays null; repeated rows give repeated results;
other columns are ignored; an empty table gives no rows. Running lengths are summed in runs of 128 matches, so a
very long text with very many matches does not cost the square of their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Kinds in their order: pattern, group whose length counts, least and most characters of it.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [("assign", ASSIGN, 2, 8, None), ("access", "AKIA[A-Z0-9]{12,}", 0, 16, None), ("hex", "[0-9a-f]{32,}", 0, 32, None)]
WEAK = [("secret", "[A-Za-z0-9+/=]{40,}", 0, 40, 40), ("endpoint", "https?://[A-Za-z0-9./:_-]+", 0, 12, None)]
ORDER = [k[0] for k in BASE + WEAK]
SCOPE = 256
SPANS = "array<struct<start:bigint,ord:int,stop:bigint>>"
_RUN = 128


def _running(df: DataFrame, sizes: str, out: str) -> DataFrame:
    """Add `out`, the running sums of the array column `sizes`, by runs of fixed length."""
    df = df.withColumn("_runs", F.expr(f"transform(sequence(0, (size({sizes}) - 1) div {_RUN}), b -> slice({sizes}, b * {_RUN} + 1, {_RUN}))"))
    df = df.withColumn("_sums", F.expr("transform(_runs, r -> aggregate(r, 0L, (a, x) -> a + x))"))
    df = df.withColumn("_base", F.expr("transform(_sums, (s, i) -> aggregate(slice(_sums, 1, i), 0L, (a, x) -> a + x))"))
    df = df.withColumn(out, F.expr("flatten(transform(_runs, (r, b) -> transform(r, (x, i) -> _base[b] + aggregate(slice(r, 1, i + 1), 0L, (a, y) -> a + y))))"))
    return df.drop("_runs", "_sums", "_base")


def find(df: DataFrame, kind: tuple) -> DataFrame:
    """Add a column named as the kind: the spans of its matches in `text`, leftmost and non-overlapping."""
    name, pattern, group, least, most = kind
    p = F.lit(pattern)
    some = F.col("text").rlike(pattern)
    lengths = lambda a: F.transform(a, lambda x: F.char_length(x).cast("long"))
    none = F.array().cast("array<bigint>")
    df = df.withColumn("_m", F.when(some, lengths(F.regexp_extract_all("text", p, F.lit(0)))).otherwise(none))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, lengths(F.split("text", pattern, -1))).otherwise(none))
    counted = F.col("_m") if not group else F.when(F.size("_m") > 0, lengths(F.regexp_extract_all("text", p, F.lit(group)))).otherwise(none)
    df = df.withColumn("_c", counted).withColumn("_s", F.expr("zip_with(_m, slice(_g, 1, size(_m)), (m, g) -> m + g)"))
    df = _running(df, "_s", "_e")
    keep = f"_c[i] >= {least}" + (f" AND _c[i] <= {most}" if most else "")
    spans = F.expr(f"transform(filter(sequence(0, size(_m) - 1), i -> {keep}), i -> named_struct('start', _e[i] - _m[i], 'ord', {ORDER.index(name)}, 'stop', _e[i]))")
    return df.withColumn(name, F.when(F.size("_m") > 0, spans).otherwise(F.array()).cast(SPANS)).drop("_m", "_g", "_c", "_s", "_e")


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in ORDER))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["ord"] + 1), s["start"], s["stop"])), ",")


def _found(docs: DataFrame, scope: int) -> DataFrame:
    """doc_id, key (equal for rows of one id and text), the spans of each kind and the linked weak spans."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    for kind in BASE + WEAK:
        found = find(found, kind)
    found = materialize(found.withColumn("key", _row_key()).drop("text"), "op8-spans")
    both = found.filter((F.size("secret") + F.size("endpoint") > 0) & (F.size("access") + F.size("assign") > 0))
    weak = both.select("key", F.explode(F.concat("secret", "endpoint")).alias("w")).distinct().withColumn("bin", F.expr(f"w.start div {scope}"))
    anchor = both.select("key", F.explode(F.concat("access", "assign")).alias("a")).distinct()
    anchor = anchor.withColumn("bin", F.explode(F.expr(f"sequence(greatest(0L, a.start - {scope}) div {scope}, (a.stop + {scope}) div {scope})"))).withColumnRenamed("key", "k").withColumnRenamed("bin", "b")
    complete = (F.col("a.ord") == ORDER.index("access")) | (F.col("w.ord") == ORDER.index("endpoint"))
    near = (F.col("w.start") >= F.col("a.start") - scope) & (F.col("w.stop") <= F.col("a.stop") + scope)
    linked = weak.join(anchor, (F.col("key") == F.col("k")) & (F.col("bin") == F.col("b")) & near & complete, "left_semi")
    linked = linked.groupBy("key").agg(F.collect_list("w").alias("linked"))
    out = found.join(linked, "key", "left").withColumn("linked", F.coalesce("linked", F.array().cast(SPANS)))
    return out.withColumn("base", F.concat("assign", "access", "hex"))


def _row_key() -> Column:
    return F.concat_ws(":", F.col("doc_id").cast("long"), F.hex(F.xxhash64(F.coalesce("text", F.lit("")))), F.hash(F.coalesce("text", F.lit(""))))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, the base counts, base_sha256 and all spans of every row of `docs` (doc_id, text)."""
    found = _found(docs, scope)
    counts = (F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex"))
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", "linked")).alias("spans"))


_PIECE = 1024


def _part(a: str, b: str) -> str:
    """Code points a .. b of the text whose pieces of _PIECE code points are `_cut`: only those in question are read."""
    i, j = f"cast({a} div {_PIECE} as int)", f"cast(({b} - 1) div {_PIECE} as int)"
    inside = f"substring(_cut[{i}], cast({a} % {_PIECE} as int) + 1, cast({b} - {a} as int))"
    across = f"concat(substring(_cut[{i}], cast({a} % {_PIECE} as int) + 1), array_join(slice(_cut, {i} + 2, {j} - {i} - 1), ''), substring(_cut[{j}], 1, cast({b} - {j} * {_PIECE} as int)))"
    return f"CASE WHEN {b} <= {a} THEN '' WHEN {i} = {j} THEN {inside} ELSE {across} END"


def redact(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """`docs` with every span in `text` replaced by its kind in brackets, and n_chars set to the new length.

    Spans that overlap count as one, under the kind of the first. Null texts stay null, empty ones empty; rows
    without spans, repeated rows and other columns, whatever their names, stay as they are; an empty table stays
    empty. The text is cut into pieces once and joined once, so a long text with many spans costs no more a span.
    """
    spans = _found(docs, scope).select(F.col("key").alias("_k"), F.array_sort(F.concat("base", "linked")).alias("_spans")).filter(F.size("_spans") > 0).dropDuplicates(["_k"])
    names = "array(" + ", ".join(f"'[{k}]'" for k in ORDER) + ")"
    # what overlaps an earlier span goes; `pos` is where those before end
    step = """CASE WHEN s.start >= acc.pos THEN named_struct('pos', s.stop, 'out', array_append(acc.out, named_struct('before', acc.pos, 'start', s.start, 'ord', s.ord)))
        ELSE named_struct('pos', greatest(acc.pos, s.stop), 'out', acc.out) END"""
    none = "cast(array() as array<struct<before:bigint,start:bigint,ord:int>>)"
    # the row travels as one struct, so that no column of it can clash with those added here
    out = docs.select(F.struct("*").alias("_d"), _row_key().alias("_k")).join(spans, "_k", "left")
    out = out.withColumn("_kept", F.expr(f"aggregate(_spans, named_struct('pos', 0L, 'out', {none}), (acc, s) -> {step})"))
    out = out.withColumn("_cut", F.when(F.col("_spans").isNotNull(), F.regexp_extract_all(F.col("_d.text"), F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))))
    out = out.withColumn("_size", F.char_length("_d.text").cast("bigint"))
    masked = f"concat(array_join(transform(_kept.out, s -> concat({_part('s.before', 's.start')}, {names}[s.ord])), ''), {_part('_kept.pos', '_size')})"
    out = out.withColumn("_text", F.when(F.col("_spans").isNull(), F.col("_d.text")).otherwise(F.expr(masked)))
    n_chars = F.when(F.col("_spans").isNull(), F.col("_d.n_chars")).otherwise(F.char_length("_text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else None
    new = {"text": F.col("_text"), "n_chars": n_chars}
    return out.select(*(new.get(c, F.col("_d")[c]).alias(c) for c in docs.columns))


def _sql_find(name: str, pattern: str, group: int, least: int, most: int | None) -> str:
    p = pattern.replace("'", "''")
    size = f"regexp_extract_all(text, '{p}', {group})"
    keep = f"len(c[i]) >= {least}" + (f" AND len(c[i]) <= {most}" if most else "")
    return f"""{name}0 AS (SELECT k, regexp_extract_all(text, '{p}') AS m, {size} AS c, string_split_regex(text, '{p}') AS g FROM d),
{name} AS (SELECT k, {ORDER.index(name)} AS ord, '{name}' AS kind, CAST(e - len(m[i]) AS BIGINT) AS start, CAST(e AS BIGINT) AS stop FROM (
  SELECT *, list_sum([len(x) FOR x IN g[1:i]]) + list_sum([len(x) FOR x IN m[1:i]]) AS e FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM {name}0)) WHERE {keep})"""


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
{", ".join(_sql_find(*k) for k in BASE + WEAK)},
base AS (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex),
weak AS (SELECT * FROM secret UNION ALL SELECT * FROM endpoint),
linked AS (SELECT DISTINCT w.* FROM weak w JOIN base a ON w.k = a.k AND w.start >= a.start - {SCOPE} AND w.stop <= a.stop + {SCOPE}
           AND (a.kind = 'access' OR (a.kind = 'assign' AND w.kind = 'endpoint'))),
b AS (SELECT k, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS s FROM base GROUP BY k),
a AS (SELECT k, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS s FROM (SELECT * FROM base UNION ALL SELECT * FROM linked) GROUP BY k)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(b.s, '')) AS base_sha256, coalesce(a.s, '') AS spans
FROM d LEFT JOIN b ON d.k = b.k LEFT JOIN a ON d.k = a.k
"""
