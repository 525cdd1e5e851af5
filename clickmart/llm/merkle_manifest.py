"""Merkle dataset manifest: a digest of every row, its group and the whole table, with a proof per row.

Every level is a table of nodes (group, index, digest). A level equijoins
itself with the computed sibling index: ``index XOR 1`` in a binary tree,
``slot offset`` of 1 to arity - 1 within the run otherwise. The slot-zero
rows, which see their whole run, emit the parents. Groups finish at their
own height; the level loop ends with the tallest. Each level is stored, so
its plan holds one join and a lost executor repeats one level at most.
Indices are unique, so no join key is shared by many rows, whatever the
sizes of the groups; a group of a third of all rows is one of many ranges
of indices.

Proofs go down again in one plan: a node's path is its siblings followed
by its parent's path. Only stored sibling tables are read.

Definition. H is the lower-case hex sha256 of its inputs' concatenation,
digests as hex text. A leaf is H over the fields, each ``-`` if null, else
its UTF-8 byte count, ``:`` and its value (numbers in decimal). Leaves
ascend by ``order_col`` within a group; every ``arity`` consecutive nodes
(the last run: fewer, even one) become their H while a group has more
than one. A lone leaf is its group's subroot itself. The subroots, groups
ascending (null first, strings by their bytes), give the root likewise.

Defined results: null, empty and very long values are hashed as stated;
rows with equal order values (null first among them) stand by their leaf
digest, so repeated rows are leaves of their own; a table of one row has
its leaf as root and an empty proof; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import running
from .common import read_table, staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The test tampers with rows whose unsigned crc32 of the decimal id is divided by this.
TAMPER_EVERY = 7


def field_text(value: Column) -> Column:
    """One field of a leaf: ``-`` for null, else byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*fields: Column) -> Column:
    """The 32 bytes of a leaf's digest; stored so, written as hex."""
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)), 256))


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def _parent(nodes: Sequence[Column]) -> Column:
    """Digest of a run; missing slots (null) are left out."""
    return F.unhex(F.sha2(F.concat_ws("", *map(_hex, nodes)), 256))


def _siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (g, idx, h) with slot and ``s1 .. s(arity-1)``: the digest at each slot offset, null if missing."""
    out = nodes.withColumn("slot", F.pmod("idx", F.lit(arity)).cast("int"))
    for offset in range(1, arity):
        if arity == 2:
            at = F.col("idx").bitwiseXOR(F.lit(1).cast("long"))
        else:
            at = F.col("idx") - F.col("slot") + F.pmod(F.col("slot") + offset, F.lit(arity))
        other = nodes.select(F.col("g").alias("og"), F.col("idx").alias("oi"), F.col("h").alias(f"s{offset}"))
        out = out.withColumn("at", at)
        out = out.join(other, (out["g"] == other["og"]) & (out["at"] == other["oi"]), "left").drop("at", "og", "oi")
    return out


def _others(arity: int) -> Column:
    """The siblings from left to right: those of the smaller slots stand at the larger offsets."""
    found = F.array(*[F.col(f"s{o}") for o in range(1, arity)])
    turned = F.concat(F.slice(found, F.lit(arity) - F.col("slot"), F.col("slot")), F.slice(found, F.lit(1), F.lit(arity - 1) - F.col("slot")))
    return F.filter(turned, lambda s: s.isNotNull())


def tree(leaves: DataFrame, arity: int = 2) -> tuple[DataFrame, DataFrame]:
    """(tops, paths) of leaves (g, idx, h, row), idx from 0 in every group g.

    ``tops`` has each group's last digest (g, h); ``paths`` each leaf's
    (g, idx, row, path), path an array of (slot, others) from the leaf up.
    """
    last = leaves.agg(F.max("idx")).first()[0] or 0
    levels, nodes = [], leaves
    run = [F.col("h"), *[F.col(f"s{o}") for o in range(1, arity)]]
    while True:
        joined = _siblings(nodes, arity)
        alone = (F.col("idx") == 0) & F.coalesce(*run[1:]).isNull()
        levels.append(staged(joined.withColumn("top", alone), "merkle-level"))
        if last == 0:
            break
        parents = levels[-1].where((F.col("slot") == 0) & ~F.col("top"))
        nodes = parents.select("g", F.expr(f"idx div {arity}").alias("idx"), _parent(run).alias("h"))
        last //= arity

    tops = reduce(DataFrame.unionByName, [level.where("top").select("g", "h") for level in levels])
    empty = F.array().cast("array<struct<slot:int,others:array<binary>>>")
    paths = levels[-1].withColumn("path", empty)
    for level in reversed(levels[:-1]):
        own = level.withColumn("at", F.when(~F.col("top"), F.expr(f"idx div {arity}")))
        up = paths.select(F.col("g").alias("ug"), F.col("idx").alias("ui"), F.col("path").alias("above"))
        met = own.join(up, (own["g"] == up["ug"]) & (own["at"] == up["ui"]), "left")
        step = F.array(F.struct("slot", _others(arity).alias("others")))
        paths = met.withColumn("path", F.when(F.col("top"), empty).otherwise(F.concat(step, "above")))
    return staged(tops, "merkle-tops"), paths.select("g", "idx", "row", "path")


def fold(leaf: Column, path: Column) -> Column:
    """Hex root that a hex leaf and a path lead to."""

    def step(acc: Column, p: Column) -> Column:
        left = F.slice(p["others"], F.lit(1), p["slot"])
        right = F.slice(p["others"], p["slot"] + 1, F.size(p["others"]))
        both = F.concat(F.transform(left, _hex), F.array(acc), F.transform(right, _hex))
        return F.sha2(F.array_join(both, ""), 256)

    return F.aggregate(path, leaf, step)


def proof_text(path: Column) -> Column:
    """All siblings' hex digests in the order of the proof."""
    return F.array_join(F.transform(F.flatten(F.transform(path, lambda p: p["others"])), _hex), "")


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group_col: str = "lang",
    order_col: str = "doc_id",
    arity: int = 2,
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row: ``order_col``, ``group_col``, leaf, subroot, root (hex) and path.

    ``tampered`` replaces fields for ``other_leaf``, the digest a changed
    row would have; without it other_leaf is the leaf.
    """
    if arity < 2:
        raise ValueError("arity must be at least 2")
    other = digest(*[(tampered or {}).get(f, F.col(f)) for f in fields])
    cols = dict.fromkeys([*fields, group_col, order_col])
    hashed = docs.select(*cols).select(
        F.col(group_col).alias("grp"), F.col(order_col).alias("ord"), digest(*map(F.col, fields)).alias("h"), other.alias("other")
    )
    # stored before they are sorted: the texts are read and hashed once
    placed = running(staged(hashed, "merkle-digests"), [F.col("ord").asc_nulls_first(), F.col("h")], groups=["grp"])
    placed = staged(placed.withColumn("idx", F.col("position") - 1), "merkle-leaves")
    # groups are numbered in the order of their subroots; a row per distinct group
    names = running(placed.select(F.col("grp").alias("name")).distinct(), [F.col("name").asc_nulls_first()])
    names = staged(names.withColumn("g", F.col("position") - 1), "merkle-groups").drop("position")
    leaves = placed.join(names, placed["grp"].eqNullSafe(names["name"])).select(
        "g", "idx", "h", F.struct("grp", "ord", "h", "other").alias("row")
    )
    tops, paths = tree(leaves, arity)
    crown, upper = tree(tops.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), "h", F.struct("g", "h").alias("row")), arity)
    head = crown.select("h").first()
    root = _hex(F.lit(bytes(head["h"])) if head else F.lit(None).cast("binary"))
    per_group = staged(
        upper.select(F.col("row.g").alias("tg"), F.col("row.h").alias("sub"), F.col("path").alias("crown")), "merkle-crown"
    )
    return paths.join(per_group, F.col("g") == F.col("tg")).select(
        F.col("row.ord").alias(order_col), F.col("row.grp").alias("group"), _hex(F.col("row.h")).alias("leaf"),
        _hex(F.col("row.other")).alias("other_leaf"), _hex(F.col("sub")).alias("subroot"), root.alias("root"),
        F.concat("path", "crown").alias("path"),
    )


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """The manifest of ``documents`` with every proof checked, one row in seven tampered with."""
    docs = read_table(spark, sf_dir, "documents", *FIELDS)
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(TAMPER_EVERY)) == 0
    changed = F.when(F.coalesce(hit, F.lit(False)), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    rows = manifest(docs, tampered={"n_chars": changed})
    folded = rows.withColumn("folded_root", fold(F.col("other_leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


OP13_SQL = """
with recursive d as (
  select *, cast(doc_id as varchar) as id_text from documents
),
crc as (
  -- unsigned crc32 of the decimal id, bit by bit
  select *, 4294967295 - list_reduce(
      list_concat([4294967295::bigint], list_transform(range(1, length(id_text) + 1), lambda i: ascii(substr(id_text, i, 1))::bigint)),
      lambda acc, b: list_reduce([xor(acc, b), 0::bigint, 0, 0, 0, 0, 0, 0, 0],
                                 lambda a, z: xor(a >> 1, 3988292384::bigint * (a & 1)))) as crc
  from d
),
texts as (
  select doc_id, lang, text, n_chars,
         coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') as head,
         coalesce(strlen(text) || ':' || text, '-') as body,
         n_chars + case when crc % 7 = 0 then 1 else 0 end as changed
  from crc
),
hashed as (
  select doc_id, lang,
         sha256(head || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') || body) as leaf,
         sha256(head || coalesce(strlen(cast(changed as varchar)) || ':' || changed, '-') || body) as other
  from texts
),
leaves as (
  select *, dense_rank() over (order by lang nulls first) - 1 as g,
         row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx,
         count(*) over (partition by lang) as n
  from hashed
),
nodes as (
  select g, 0 as lvl, idx, leaf as h, n from leaves
  union all
  select g, any_value(lvl) + 1, idx // 2, sha256(string_agg(h, '' order by idx)), (any_value(n) + 1) // 2
  from nodes where n > 1 group by g, idx // 2
),
subroots as (select g, h as subroot, count(*) over () as n from nodes where n = 1),
crown as (
  select 0 as lvl, g as idx, subroot as h, n from subroots
  union all
  select any_value(lvl) + 1, idx // 2, sha256(string_agg(h, '' order by idx)), (any_value(n) + 1) // 2
  from crown where n > 1 group by idx // 2
),
steps as (
  -- a step per level with several nodes: the sibling and whether it stands to the left
  select l.doc_id, l.leaf, l.g, 0 as part, v.lvl, (l.idx >> v.lvl) & 1 as bit, s.h as sib
  from leaves l
  join (select distinct g, lvl from nodes where n > 1) v on v.g = l.g
  left join nodes s on s.g = l.g and s.lvl = v.lvl and s.idx = xor(l.idx >> v.lvl, 1)
  union all
  select l.doc_id, l.leaf, l.g, 1, v.lvl, (l.g >> v.lvl) & 1, s.h
  from leaves l
  cross join (select distinct lvl from crown where n > 1) v
  left join crown s on s.lvl = v.lvl and s.idx = xor(l.g >> v.lvl, 1)
),
proofs as (
  select doc_id, leaf, coalesce(string_agg(sib, '' order by part, lvl), '') as proof,
         list(case when sib is null then 'N' when bit = 0 then 'R' || sib else 'L' || sib end order by part, lvl) as way
  from steps group by doc_id, leaf
)
select l.doc_id, l.leaf, r.subroot, c.h as root, sha256(coalesce(p.proof, '')) as proof_sha256,
       list_reduce(list_concat([l.other], coalesce(p.way, [])), lambda acc, e: sha256(
           case substr(e, 1, 1) when 'N' then acc when 'R' then acc || substr(e, 2) else substr(e, 2) || acc end)) as folded_root,
       folded_root = c.h as verified
from leaves l join subroots r on r.g = l.g join crown c on c.n = 1 left join proofs p on p.doc_id is not distinct from l.doc_id and p.leaf = l.leaf
"""
