"""Merkle manifest of a dataset with nested-interval labels.

Leaves of a language are placed by (doc_id, leaf digest) through ranges of that order, so no task holds a whole
language. A node is labelled with the interval [lo, hi) of leaf places that it covers; its children are those nodes of
the level below whose intervals lie inside. Levels are built upwards by the bucket lo div 8^level, and ancestors are
attached downwards: each node meets, in its bucket of the level above, the parent whose interval contains its own,
takes over the parent's path to the root and adds to it the parent's children less its own interval, which are its
siblings. Subroots are the leaves of one more tree of the same kind, ordered by language.

A path is a list of (left, right): the digests of the siblings before and after, as one text each. The proof joins
them; folding puts the digest so far between them at each level.

Each row is a leaf of its own: rows that repeat have equal digests and stand side by side; rows with one doc_id are
ordered by digest; rows without doc_id come first. Null columns count as `-`, and an empty text as `0:`. Null lang is a
language of its own, which comes first. Columns other than doc_id, source, lang, n_chars and text are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.places import placed
from .common import materialize

FAN = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PATH = "array<struct<left:string,right:string>>"


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    """The digest of a row of documents, with the given text in place of its own."""
    return F.sha2(F.concat(*(_encoded(text if c == "text" else F.col(c)) for c in FIELDS)), 256)


def tampered() -> Column:
    """Whether a row is tampered with: a third of all doc_ids; rows without doc_id are not."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0, F.lit(False))


def lowered(text: Column) -> Column:
    """A-Z become a-z, no other letter does; texts of ASCII alone take the quicker way."""
    upper = "".join(map(chr, range(65, 91)))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def _tree(lang: Column) -> Column:
    """A key that is never null and sorts as languages do, null first, by their UTF-8 bytes."""
    return F.when(lang.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), lang))


def levels(leaves: DataFrame, name: str) -> list[DataFrame]:
    """All levels of the trees of leaves(tree, place, total, digest), from the leaves up, each stored.

    A node has tree, total, lo, hi, digest and, above the leaves, kids: lo, hi and digest of its children in order;
    leaves keep their other columns. A tree ends at the level where one node covers all its leaves.
    """
    out = [leaves.withColumnRenamed("place", "lo").withColumn("hi", F.col("lo") + 1)]
    most, size = leaves.agg(F.max("total")).first()[0] or 0, 1
    while size < most:
        below = out[-1].filter(F.col("total") > size)
        size *= FAN
        kid = F.struct("lo", "hi", "digest")
        up = below.groupBy("tree", "total", F.expr(f"lo div {size}").alias("bucket")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
        up = up.select("tree", "total", F.expr("kids[0].lo").alias("lo"), F.expr("element_at(kids, -1).hi").alias("hi"), F.expr("sha2(array_join(kids.digest, ''), 256)").alias("digest"), "kids")
        out.append(materialize(up, f"op11-{name}-{len(out)}"))
    return out


def attach(nodes: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves of `levels` with their path upwards and `kept`, what their tree's top gives to all below.

    tops(tree, kept, path): what stands above the root of each tree. Levels are met from the top: a node's parent is
    the node of its bucket in the level above whose interval contains the node's.
    """
    above = None
    for level in reversed(range(len(nodes))):
        size, own = FAN ** (level + 1), nodes[level]
        root = own.filter(F.col("hi") - F.col("lo") == F.col("total")).join(tops, "tree")
        if above is not None:
            parent = above.select(F.col("tree").alias("t"), F.col("lo").alias("plo"), F.col("hi").alias("phi"), F.col("kids").alias("family"), "path", "kept", F.expr(f"lo div {size}").alias("bucket"))
            inside = (F.col("tree") == F.col("t")) & (F.expr(f"lo div {size}") == F.col("bucket")) & (F.col("plo") <= F.col("lo")) & (F.col("hi") <= F.col("phi"))
            met = own.filter(F.col("hi") - F.col("lo") < F.col("total")).join(parent, inside)
            rest = lambda where: f"array_join(transform(filter(family, k -> {where}), k -> k.digest), '')"
            step = F.expr(f"named_struct('left', {rest('k.hi <= lo')}, 'right', {rest('k.lo >= hi')})")
            root = root.unionByName(met.withColumn("path", F.concat(F.array(step), "path")).select(root.columns))
        above = root
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of documents.

    The digests are those of the untampered rows but for folded_root, which folds the tampered leaf, where there is
    one, along the path; verified says that it equals the root.
    """
    other = F.when(tampered(), leaf_digest(lowered(F.col("text"))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tree(F.col("lang")).alias("tree"), leaf_digest(F.col("text")).alias("digest"), other.alias("other"))
    rows = materialize(rows, "op11-digests")
    leaves = materialize(placed(rows, ["tree"], [F.col("doc_id"), F.col("digest")], total="total"), "op11-leaves")
    trees = levels(leaves, "leaves")
    roots = None
    for level in trees:
        top = level.filter((F.col("lo") == 0) & (F.col("hi") == F.col("total"))).select(F.col("tree").alias("name"), "digest")
        roots = top if roots is None else roots.unionByName(top)
    roots = placed(materialize(roots, "op11-subroots"), [], [F.col("name")], total="total")
    roots = materialize(roots.withColumn("tree", F.lit("all")), "op11-roots")
    upper = levels(roots, "roots")
    top = upper[-1].select("tree", F.struct(F.col("digest").alias("root")).alias("kept"), F.array().cast(PATH).alias("path"))
    tops = attach(upper, top).select(F.col("name").alias("tree"), F.struct(F.col("digest").alias("subroot"), "kept.root").alias("kept"), "path")
    found = attach(trees, materialize(tops, "op11-tops"))
    folded = F.expr("aggregate(path, coalesce(other, digest), (so_far, p) -> sha2(concat(p.left, so_far, p.right), 256))")
    proof = F.expr("sha2(array_join(flatten(transform(path, p -> array(p.left, p.right))), ''), 256)")
    return found.select("doc_id", F.col("digest").alias("leaf"), "kept.subroot", "kept.root", proof.alias("proof_sha256"), folded.alias("folded_root"), (folded == F.col("kept.root")).alias("verified"))


def _crc_table() -> str:
    """The table of CRC-32 by its rule: eight steps of the reflected polynomial for each byte."""
    out = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ 0xEDB88320 * (byte & 1)
        out.append(byte)
    return "[" + ", ".join(map(str, out)) + "]::BIGINT[]"


def sql_crc32(digits: str) -> str:
    """DuckDB's form of crc32 of a decimal number's text."""
    step = f"xor(a >> 8, ({_crc_table()})[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({digits} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda a, b: {step}), 4294967295::BIGINT)"


#: Levels in the SQL: it holds for 8^7 leaves in a language and 8^3 languages.
_DEEP, _WIDE = 7, 3


def _sql_tree(name: str, depth: int) -> str:
    """Levels of a table `name`0(tree, total, lo, hi, digest), and of each leaf its siblings and the root above it."""
    parts = []
    for k in range(1, depth + 1):
        parts.append(f"{name}{k} AS (SELECT tree, total, min(lo) AS lo, max(hi) AS hi, sha256(string_agg(digest, '' ORDER BY lo)) AS digest FROM {name}{k - 1} WHERE total > {FAN ** (k - 1)} GROUP BY tree, total, lo // {FAN**k})")
    for k in range(depth):
        side = lambda where: f"coalesce(string_agg(b.digest, '' ORDER BY b.lo) FILTER ({where}), '')"
        parts.append(f"{name}s{k} AS (SELECT a.tree, a.lo, {side('b.hi <= a.lo')} AS l{k}, {side('b.lo > a.lo')} AS r{k} FROM {name}0 a JOIN {name}{k} b ON a.tree = b.tree AND a.lo // {FAN ** (k + 1)} = b.lo // {FAN ** (k + 1)} AND a.total > {FAN**k} GROUP BY a.tree, a.lo)")
    joins = " ".join(f"LEFT JOIN {name}s{k} USING (tree, lo)" for k in range(depth))
    parts.append(f"{name}path AS (SELECT * FROM {name}0 {joins})")
    tops = " UNION ALL ".join(f"SELECT tree, digest AS top FROM {name}{k} WHERE lo = 0 AND hi = total" for k in range(depth + 1))
    parts.append(f"{name}top AS ({tops})")
    return ", ".join(parts)


def _sql_fold(start: str, name: str, depth: int, table: str) -> str:
    """CTEs that fold a column along the path, one a level."""
    parts, last = [], start
    for k in range(depth):
        parts.append(f"{name}{k} AS (SELECT *, CASE WHEN l{k} IS NULL THEN {last} ELSE sha256(l{k} || {last} || r{k}) END AS {name}_{k} FROM {name if k else table}{k - 1 if k else ''})")
        last = f"{name}_{k}"
    return ", ".join(parts)


def _sql_digest(text: str) -> str:
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    return "sha256(" + " || ".join(part(text if c == "text" else c) for c in FIELDS) + ")"


_JOINED = "concat(" + ", ".join(f"l{k}, r{k}" for k in range(_DEEP)) + ")"
_ABOVE = "concat(" + ", ".join(f"l{k}, r{k}" for k in range(_WIDE)) + ")"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_sql_digest("text")} AS digest, CASE WHEN {sql_crc32("doc_id")} % 3 = 0 THEN {_sql_digest(_LOWER)} END AS other FROM documents),
n0 AS (SELECT doc_id, tree, count(*) OVER (PARTITION BY tree) AS total, row_number() OVER w - 1 AS lo, row_number() OVER w AS hi, digest, other FROM d WINDOW w AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest)),
{_sql_tree("n", _DEEP)},
u0 AS (SELECT tree AS name, 'all' AS tree, count(*) OVER () AS total, row_number() OVER (ORDER BY encode(tree)) - 1 AS lo, row_number() OVER (ORDER BY encode(tree)) AS hi, top AS digest FROM ntop),
{_sql_tree("u", _WIDE)},
{_sql_fold("coalesce(other, digest)", "f", _DEEP, "npath")},
g AS (SELECT f.doc_id, f.digest AS leaf, f.f_{_DEEP - 1} AS folded, f.below, u.* EXCLUDE (digest), u.digest AS subroot FROM (SELECT *, {_JOINED} AS below FROM f{_DEEP - 1}) f JOIN upath u ON f.tree = u.name),
{_sql_fold("folded", "h", _WIDE, "g")}
SELECT doc_id, leaf, subroot, t.top AS root, sha256(below || {_ABOVE}) AS proof_sha256, h_{_WIDE - 1} AS folded_root, h_{_WIDE - 1} = t.top AS verified FROM h{_WIDE - 1} JOIN utop t USING (tree)
"""
