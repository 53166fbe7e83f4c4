"""Merkle dataset manifest (operator 12): sibling-shift self-joins.

A row's leaf is the SHA-256 of its fields, each written with its length, so that no two rows share an encoding. Leaves of
a group (``lang``) are numbered by id. On every level each node computes its siblings' indices (``index XOR 1`` in a binary
tree, slot offsets in a wider one) and equijoins the level with itself on them; the nodes in slot zero then emit the
parents. Groups of one node left are done: that node is the group's subroot. The subroots, ordered by group, form a last
tree of the same kind, whose root stands for the whole table.

Proofs come down again: a level's nodes take their parents' proofs by an equijoin on the parents' indices and put their own
siblings in front. A proof is one binary value, 32 bytes per sibling, leaf to root, left to right; the number of siblings on
each level follows from the leaf's index and its group's size. Levels halve, so all levels together hold twice the leaves,
and every one is written once, to the shared folder; no key of a join repeats, so a group that holds most rows skews nothing.

Defined results: a NULL field is written ``-`` and differs from every value; NULL groups are one group, the first. Rows with
equal ids are ordered by their leaves, equal rows have equal leaves and their own places. The empty table has no rows and no
root. Texts of any length are hashed whole inside the JVM. Columns beside the fields take no part; result columns are named
by the operator, so an input column of such a name cannot clash (only the id passes through).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import broadcast_if_small, crc32_sql, written
from kestrel.llm.ranks import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = ("g", "i", "m", "hash")  # group, index on the level, nodes of the group on the level, digest
LEVELS_A_CUT = 6  # levels of proofs between two written tables


def field(value: Column) -> Column:
    """``-`` for NULL, else the value's length in UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def text_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(F.concat(*[field(c) for c in fields]))


def paired(nodes: DataFrame, arity: int) -> DataFrame:
    """One level: every node with ``others``, its siblings' digests from left to right, by self-joins on their indices."""
    slot = F.col("i") % arity
    out = nodes
    for offset in range(1, arity):
        # The sibling ``offset`` slots further on, cyclically; in a binary tree that is the index XOR 1.
        seen_from = F.col("i").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("i") - slot + F.pmod(slot - offset, F.lit(arity))
        sibling = nodes.select("g", seen_from.alias("i"), F.struct(slot.alias("slot"), "hash").alias(f"s{offset}"))
        out = out.join(sibling, ["g", "i"], "left")
    beside = F.array_sort(F.array_compact(F.array(*[F.col(f"s{o}") for o in range(1, arity)])))
    joined = F.aggregate(beside, F.lit(b""), lambda acc, s: F.concat(acc, s["hash"]))
    return out.withColumn("others", joined).drop(*[f"s{o}" for o in range(1, arity)])


def parents(level: DataFrame, arity: int) -> DataFrame:
    """The nodes of the next level: what the nodes in slot zero emit."""
    return level.where(F.col("i") % arity == 0).select(
        "g", F.expr(f"i div {arity}L").alias("i"), F.expr(f"(m + {arity - 1}L) div {arity}L").alias("m"),
        digest(text_of(F.concat("hash", "others"))).alias("hash"),
    )


def tree(leaves: DataFrame, largest: int, arity: int) -> tuple[DataFrame, DataFrame]:
    """(leaves plus ``path``: the siblings up to the group's last node; (g, hash) of these last nodes).

    ``leaves`` has the columns of ``NODE`` and any others, ``largest`` is the size of the largest group."""
    levels, roots, nodes = [], [], leaves
    while largest > 1:
        roots.append(nodes.where("m = 1").select("g", "hash"))
        levels.append(written(paired(nodes.where("m > 1"), arity)))
        nodes, largest = parents(levels[-1], arity), -(-largest // arity)
    roots.append(nodes.where("m = 1").select("g", "hash"))
    paths = None
    for k, level in reversed(list(enumerate(levels))):
        own = level if k == 0 else level.select("g", "i", "others")
        if paths is None:
            paths = own.withColumnRenamed("others", "path")
        else:
            above = paths.select("g", F.col("i").alias("up"), F.col("path").alias("above"))
            paths = own.withColumn("up", F.expr(f"i div {arity}L")).join(above, ["g", "up"], "left")
            paths = paths.withColumn("path", F.concat("others", F.coalesce("above", F.lit(b"")))).drop("up", "others", "above")
        if k and k % LEVELS_A_CUT == 0:
            paths = written(paths)
    alone = leaves.where("m = 1").withColumn("path", F.lit(b""))
    return (alone if paths is None else paths.unionByName(alone)), reduce(DataFrame.unionByName, roots)


def fold(start: Column, index: Column, size: Column, path: Column, levels: int, arity: int) -> Column:
    """The digest (hex) that a leaf's digest and its siblings lead to: runs are put together again, level by level."""
    state = F.struct(start.alias("h"), F.lit(1).alias("at"), index.cast("bigint").alias("i"), size.cast("bigint").alias("m"))

    def up(s: Column, _: Column) -> Column:
        slot = s["i"] % arity
        others = (F.least(F.lit(arity).cast("bigint"), s["m"] - s["i"] + slot) - 1).cast("int")
        beside = path.substr(s["at"], others * 64)
        left, right = (slot * 64).cast("int"), F.lit(64 * arity)
        run = F.concat(beside.substr(F.lit(1), left), s["h"], beside.substr(left + 1, right))
        return F.when(s["m"] <= 1, s).otherwise(F.struct(
            F.sha2(run.cast("binary"), 256).alias("h"), (s["at"] + others * 64).alias("at"),
            F.floor(s["i"] / arity).cast("bigint").alias("i"), F.ceil(s["m"] / arity).cast("bigint").alias("m")))

    return F.aggregate(F.array_repeat(F.lit(0), levels), state, up)["h"] if levels else start


def depth(size: int, arity: int) -> int:
    n = 0
    while size > 1:
        size, n = -(-size // arity), n + 1
    return n


def manifest(
    df: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", arity: int = 2,
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: the id, group, index in it, leaf, subroot, root (hex), ``path`` (binary, leaf to root), its digest
    ``proof_sha256``, and the root folded from the leaf of the row as ``tampered`` changes it, with ``verified``.

    ``tampered`` maps fields to the values under which rows are verified; by default they are verified as they are."""
    changed = [(tampered or {}).get(f, F.col(f)) for f in fields]
    own = leaf([F.col(f) for f in fields])
    # the changed row is only hashed where it differs
    differs = ~F.struct(*changed).eqNullSafe(F.struct(*[F.col(f) for f in fields])) if tampered else F.lit(False)
    hashed = written(df.select(
        F.col(id_col).alias("id"), F.col(group_col).alias("group"), own.alias("hash"),
        F.when(differs, leaf(changed)).alias("tampered_hash")))
    placed = numbered(hashed, [F.col("group").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("hash")])
    groups = written(placed.groupBy("group").agg(F.count("*").alias("m"), F.min("place").alias("start")))
    groups = written(numbered(groups, [F.col("start")], "g"))
    largest, n_groups = groups.agg(F.max("m"), F.count("*")).first()
    lookup = groups.select(F.col("group").alias("_group"), "g", "m", "start")
    leaves = placed.join(broadcast_if_small(lookup), F.col("group").eqNullSafe(F.col("_group")))
    leaves = leaves.select("g", (F.col("place") - F.col("start")).alias("i"), "m", "hash", "tampered_hash", "id", "group")
    lower, subroots = tree(leaves, largest or 0, arity)

    top = written(subroots.select(F.lit(0).cast("bigint").alias("zero"), "g", "hash"))
    top = top.select(F.col("zero").alias("g"), F.col("g").alias("i"), F.lit(n_groups).cast("bigint").alias("m"), "hash")
    upper, root = tree(top, n_groups, arity)
    root = written(root).select(F.col("g").alias("zero"), F.col("hash").alias("root"))  # one row, or none
    upper = upper.join(F.broadcast(root), upper["g"] == root["zero"])
    upper = written(upper.select(F.col("i").alias("g"), F.col("hash").alias("subroot"), "root", F.col("path").alias("upper")))

    out = lower.join(broadcast_if_small(upper), "g")
    path_text, upper_text = text_of(F.col("path")), text_of(F.col("upper"))
    start = text_of(F.coalesce("tampered_hash", "hash"))
    out = out.select("*", path_text.alias("path_text"), upper_text.alias("upper_text"), start.alias("start"))
    out = out.withColumn("reached", fold(
        F.col("start"), F.col("i"), F.col("m"), F.col("path_text"), depth(largest or 0, arity), arity))
    out = out.withColumn("folded_root", fold(
        F.col("reached"), F.col("g"), F.lit(n_groups), F.col("upper_text"), depth(n_groups, arity), arity))
    return out.select(
        F.col("id").alias(id_col), "group", F.col("i").alias("index"), text_of(F.col("hash")).alias("leaf"),
        text_of(F.col("subroot")).alias("subroot"), text_of(F.col("root")).alias("root"),
        F.concat("path", "upper").alias("path"),
        F.sha2(F.concat("path_text", "upper_text").cast("binary"), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == text_of(F.col("root"))).alias("verified"),
    )


def oracle_sql(modulus: int = 7) -> str:
    """DuckDB SQL for the query over ``documents``: runs by grouped concatenation, proofs by walking up from each leaf."""

    def enc(c):
        return f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"

    def leaf_sql(chars):
        return "sha256(" + " || ".join(enc(chars if f == "n_chars" else f) for f in FIELDS) + ")"

    up = "sha256(string_agg(h, '' order by i))"
    return f"""
with recursive d as (
  select doc_id, lang, {leaf_sql('n_chars')} as leaf,
         case when {crc32_sql('doc_id::varchar')} % {modulus} = 0 then {leaf_sql('(n_chars + 1)')} else {leaf_sql('n_chars')} end as given
  from documents),
l as (
  select *, dense_rank() over (order by lang nulls first) - 1 as g, count(*) over (partition by lang) as m,
         row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i from d),
nodes as (
  select g, 0 as level, i, m, leaf as h from l
  union all
  select g, level + 1, i // 2, (m + 1) // 2, {up} from nodes where m > 1 group by g, level, i // 2, m),
subroots as (select g, h as subroot from nodes where m = 1),
top as (
  select 0 as level, g as i, (select count(*) from subroots) as m, subroot as h from subroots
  union all
  select level + 1, i // 2, (m + 1) // 2, {up} from top where m > 1 group by level, i // 2, m),
walk as (
  select g, i as place, 0 as level, i, m, given as h, '' as proof from l
  union all
  select w.g, w.place, w.level + 1, w.i // 2, (w.m + 1) // 2,
         sha256(case when w.i % 2 = 0 then w.h || coalesce(s.h, '') else s.h || w.h end), w.proof || coalesce(s.h, '')
  from walk w left join nodes s on s.g = w.g and s.level = w.level and s.i = xor(w.i, 1) where w.m > 1),
climb as (
  select g, place, 0 as level, g as i, (select count(*) from subroots) as m, h, proof from walk where m = 1
  union all
  select c.g, c.place, c.level + 1, c.i // 2, (c.m + 1) // 2,
         sha256(case when c.i % 2 = 0 then c.h || coalesce(s.h, '') else s.h || c.h end), c.proof || coalesce(s.h, '')
  from climb c left join top s on s.level = c.level and s.i = xor(c.i, 1) where c.m > 1),
root as (select h as root from top where m = 1)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, c.h as folded_root, c.h = root as verified
from l join subroots using (g) cross join root join climb c on c.g = l.g and c.place = l.i and c.m = 1"""
