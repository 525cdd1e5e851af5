"""Embedding near-duplicates by spherical-cap filters.

Directions form a random product code: a rotated vector is cut into blocks,
each block has its own random unit codewords, and a direction is one
codeword of each block. A vector is put into the filter of every direction
whose inner product with it exceeds alpha; these are list-decoded block by
block, dropping what cannot reach alpha any more, never by trying all
directions. Vectors that share a filter meet in a join on the filter and
are verified by their cosine in double precision.

The number of directions follows the number of vectors, so filters keep
their size; alpha is solved so that a pair exactly at the threshold has
``EXPECTED`` filters in common on average. In simulations of 64 dimensions
0.2 to 0.5 % of such pairs share none; closer pairs share more.

Equal vectors are one vertex with a multiplicity. A filter with more than
``CHUNK`` members is cut into chunks and each pair of chunks is a group of
its own, so no task holds more than two chunks of one filter. A pair counts
in its first common filter only, so a group returns one row per linked
vector - its number of links there and a neighbour it is connected to -
instead of its pairs.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components link with nothing, nor do vectors of different
length; equal vectors and repeated rows link with one another; null ids
take part (a component's id is its least non-null id); an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, staged
from .components import connected_components

THRESHOLD = 0.9
#: Common filters that a pair at the threshold has on average.
EXPECTED = 14.0
#: Independently rotated product codes that share the directions.
CODES = 8
#: Members of a filter that meet in one group.
CHUNK = 1024
#: Most codewords of a block; more directions take more blocks.
CODEWORDS = 2048
SEED = 77


# ------------------------------------------------------------- geometry
def _marginal(d: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid and weights of one coordinate of a random unit vector in d dimensions."""
    x = (np.arange(n) + 0.5) / n * 2 - 1
    w = (1 - x * x) ** ((d - 3) / 2)
    return x, w / w.sum()


def _common(d: int, alpha: float, cosine: float) -> float:
    """Chance that a random direction exceeds alpha with both vectors of such a pair."""
    x, w = _marginal(d, 4000)
    z, wz = _marginal(max(2, d - 1), 4000)
    above = np.append(np.cumsum(wz[::-1])[::-1], 0.0)
    x, w = x[x >= alpha], w[x >= alpha]
    need = (alpha - cosine * x) / (math.sqrt(1 - cosine * cosine) * np.sqrt(1 - x * x))
    return float((w * above[np.searchsorted(z, need)]).sum())


class CapCode:
    """``CODES`` independently rotated product codes for vectors of one length.

    One code treats all near copies of a vector alike, well or badly, by how
    evenly it falls on the blocks; several even that out.
    """

    def __init__(self, d: int, n_vectors: int, threshold: float, expected: float = EXPECTED):
        rng = np.random.Generator(np.random.PCG64([SEED, d]))
        directions = max(64, n_vectors // CODES)
        self.blocks = min(d, max(1 if d < 8 else 2, math.ceil(math.log(directions) / math.log(CODEWORDS))))
        self.size = math.ceil(directions ** (1 / self.blocks))
        self.per_code = self.size**self.blocks
        self.cuts = np.linspace(0, d, self.blocks + 1).round().astype(int)
        self.codes = []
        for _ in range(CODES):
            words = [rng.standard_normal((self.size, b - a)) for a, b in zip(self.cuts, self.cuts[1:])]
            words = [c / np.linalg.norm(c, axis=1, keepdims=True) for c in words]
            self.codes.append((np.linalg.qr(rng.standard_normal((d, d)))[0], words))
        lo, hi = -1.0, 0.999
        for _ in range(40) if d > 1 else ():
            mid = (lo + hi) / 2
            enough = CODES * self.per_code * _common(d, mid, min(threshold, 1 - 1e-9)) >= expected
            lo, hi = (mid, hi) if enough else (lo, mid)
        self.alpha = lo if d > 1 else 0.0

    def _decode(self, unit: np.ndarray, rotation: np.ndarray, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) of one code: blocks are added in turn, each as far down its sorted scores as can still do."""
        turned = unit @ rotation
        scores = [turned[:, a:b] @ c.T for a, b, c in zip(self.cuts, self.cuts[1:], words)]
        tops = np.array([s.max(axis=1) for s in scores])
        behind = np.vstack([np.cumsum(tops[::-1], axis=0)[::-1][1:], np.zeros((1, len(unit)))])
        goal = self.alpha * math.sqrt(self.blocks)
        row, ids, sums = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
        for s, rest in zip(scores, behind):
            order = np.argsort(s, axis=1)
            ranked = np.take_along_axis(s, order, axis=1)
            # scores are within -1 and 1, so rows 10 apart make one sorted line
            line = (ranked + 10.0 * np.arange(len(unit))[:, None]).ravel()
            first = np.searchsorted(line, goal - rest[row] - sums + 10.0 * row)
            first = np.clip(first, row * self.size, (row + 1) * self.size)
            n = (row + 1) * self.size - first
            take = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            row, ids, sums = (np.repeat(x, n) for x in (row, ids, sums))
            ids = ids * self.size + order.ravel()[take]
            sums = sums + ranked.ravel()[take]
        return row, ids

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Sorted ids of all directions exceeding alpha, per row of unit vectors."""
        found = [(r, ids + k * self.per_code) for k, code in enumerate(self.codes) for r, ids in [self._decode(unit, *code)]]
        row, ids = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((ids, row))
        return np.split(ids[order], np.cumsum(np.bincount(row, minlength=len(unit)))[:-1])


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=-1, keepdims=True)
    return v / np.linalg.norm(v, axis=-1, keepdims=True)


def _rectangle(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.value_lengths().to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)


# ------------------------------------------------------------ filter rows
def _decoded(nodes: DataFrame, sizes: dict[int, int], threshold: float) -> DataFrame:
    """nodes with dim and the list of their filters."""
    made: dict[int, CapCode] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, flat = _rectangle(batch.column("vec"))
            ends = np.cumsum(length)
            lists: list[np.ndarray] = [None] * len(batch)
            for d in np.unique(length).tolist():
                if d not in made:
                    made[d] = CapCode(d, sizes[d], threshold)
                code = made[d]
                pick = np.flatnonzero(length == d)
                for first in range(0, len(pick), 256):
                    part = pick[first : first + 256]
                    block = flat[(ends[part] - d)[:, None] + np.arange(d)]
                    for i, found in zip(part, code.decode(_unit(block))):
                        lists[i] = found
            count = np.array([len(x) for x in lists], np.int64)
            offsets = np.r_[0, np.cumsum(count)].astype(np.int32)
            values = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("id", "mult", "vec")]
                + [pa.array(length.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                ["id", "mult", "vec", "dim", "filters"],
            )

    kind = nodes.schema["vec"].dataType.simpleString()
    return nodes.select("id", "mult", "vec").mapInArrow(run, f"id bigint, mult bigint, vec {kind}, dim int, filters array<bigint>")


def _pair_indices(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All i < j inside consecutive groups of the given sizes."""
    first = np.cumsum(sizes) - sizes
    row = np.arange(sizes.sum())
    after = np.repeat(first + sizes, sizes) - row - 1
    a = np.repeat(row, after)
    b = a + 1 + np.arange(after.sum()) - np.repeat(np.cumsum(after) - after, after)
    return a, b


def _earlier_common(filters: list[np.ndarray], a: np.ndarray, b: np.ndarray, here: np.ndarray) -> np.ndarray:
    """Whether the rows a and b share a filter below their group's, pair by pair."""
    width = max(map(len, filters))
    table = np.full((len(filters), width), -1, np.int64)
    for i, f in enumerate(filters):
        table[i, : len(f)] = f
    out = np.zeros(len(a), bool)
    step = max(1, 2_000_000 // (width * width))
    for s in range(0, len(a), step):
        x, y = table[a[s : s + step]], table[b[s : s + step]]
        x = np.where((x >= 0) & (x < here[s : s + step, None]), x, -2)
        out[s : s + step] = (x[:, :, None] == y[:, None, :]).any(axis=(1, 2))
    return out


def _earlier_matrix(filters: list[np.ndarray], here: int) -> np.ndarray:
    """The same for all pairs of one group, by products of incidence blocks."""
    low = [f[f < here] for f in filters]
    values, inverse, counts = np.unique(np.concatenate(low), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(low)), [len(x) for x in low])
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[inverse]
    out = np.zeros((len(low), len(low)), bool)
    col, owner = number[inverse[keep]], owner[keep]
    for s in range(0, int(shared.sum()), 2048):
        block = np.zeros((len(low), 2048), np.float32)
        inside = (col >= s) & (col < s + 2048)
        block[owner[inside], col[inside] - s] = 1
        out |= block @ block.T > 0
    return out


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row reached from each row."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _linked(groups: DataFrame, threshold: float) -> DataFrame:
    """Rows sorted by group in; (id, links, root) of each linked vector and group out."""

    def solve(t: dict[str, np.ndarray], filters: list[np.ndarray], unit: np.ndarray) -> pa.RecordBatch:
        new = np.r_[True, (t["f"][1:] != t["f"][:-1]) | (t["i"][1:] != t["i"][:-1]) | (t["j"][1:] != t["j"][:-1])]
        start = np.flatnonzero(new)
        sizes = np.diff(np.r_[start, len(new)])
        found_a, found_b = [], []
        small = sizes <= 48
        rows = np.flatnonzero(np.repeat(small, sizes))
        a, b = _pair_indices(sizes[small])
        for s in range(0, len(a), 1 << 18):
            x, y = rows[a[s : s + (1 << 18)]], rows[b[s : s + (1 << 18)]]
            hit = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
            hit &= (t["i"][x] == t["j"][x]) | (t["c"][x] != t["c"][y])
            x, y = x[hit], y[hit]
            fresh = ~_earlier_common(filters, x, y, t["f"][x]) if len(x) else np.zeros(0, bool)
            found_a.append(x[fresh])
            found_b.append(y[fresh])
        for g in np.flatnonzero(~small):
            part = slice(start[g], start[g] + sizes[g])
            v = unit[part]
            hit = np.triu(v @ v.T >= threshold, 1)
            if t["i"][start[g]] != t["j"][start[g]]:
                hit &= t["c"][part][:, None] != t["c"][part][None, :]
            if hit.any():
                hit &= ~_earlier_matrix(filters[part], int(t["f"][start[g]]))
            x, y = np.nonzero(hit)
            found_a.append(x + start[g])
            found_b.append(y + start[g])
        a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
        b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
        n = len(new)
        links = np.bincount(a, t["mult"][b], n) + np.bincount(b, t["mult"][a], n)
        root = _spanning(n, a, b)
        hit = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(t["id"][hit]), pa.array(links[hit].astype(np.int64)), pa.array(t["id"][root[hit]])], ["id", "links", "root"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
            table = table.combine_chunks()
            t = {c: table.column(c).to_numpy() for c in ("f", "i", "j", "c", "id", "mult", "dim")}
            lists = table.column("filters").combine_chunks()
            size, flat = _rectangle(lists)
            filters = np.split(flat, np.cumsum(size)[:-1])
            _, values = _rectangle(table.column("vec").combine_chunks())
            # a group has one dimension, and rows are sorted by it first
            for d in np.unique(t["dim"]).tolist():
                pick = np.flatnonzero(t["dim"] == d)
                at = np.cumsum(t["dim"])[pick] - d
                unit = _unit(values[at[:, None] + np.arange(d)])
                yield solve({c: x[pick] for c, x in t.items()}, [filters[k] for k in pick], unit)

        for whole in batches:
            for first in range(0, len(whole), 4096):
                batch = pa.Table.from_batches([whole.slice(first, 4096)])
                table = batch if held is None else pa.concat_tables([held, batch])
                key = [table.column(c).to_numpy() for c in ("dim", "f", "i", "j")]
                last = np.logical_and.reduce([k == k[-1] for k in key])
                cut = int(np.argmax(last))  # the last group may go on in the next batch
                if cut:
                    yield from work(table.slice(0, cut))
                held = table.slice(cut)
        if held is not None and len(held):
            yield from work(held)

    return groups.mapInArrow(run, "id bigint, links bigint, root bigint")


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, chunk: int = CHUNK
) -> DataFrame:
    """vec_id, n_links, component_id per row."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.coalesce(F.forall("vec", good) & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec")).withColumn("usable", usable)
    rows = rows.select(
        "vec_id", "vec",
        # two independent 64-bit keys stand for a vector
        F.when(F.col("usable"), F.xxhash64("vec")).alias("k1"),
        F.when(F.col("usable"), F.xxhash64(F.lit(1), F.reverse("vec"))).alias("k2"),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 36
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(at, at + len(batch)))], [*batch.schema.names, "id"])
            at += len(batch)

    distinct = rows.where("k1 is not null").groupBy("k1", "k2").agg(
        F.first("vec").alias("vec"), F.min("vec_id").alias("least"), F.count("*").alias("mult")
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema)
    nodes = staged(distinct.mapInArrow(number, f"{schema}, id bigint"), "cap-vectors")
    sizes = {r["d"]: r["n"] for r in nodes.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).collect()}
    coded = staged(_decoded(nodes, sizes, threshold), "cap-codes")

    members = coded.select("dim", "id", F.explode("filters").alias("f"))
    counts = members.groupBy("dim", "f").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / chunk)
    placed = (
        members.join(counts, ["dim", "f"])
        .select("id", "f", chunks.alias("chunks"))
        .withColumn("c", F.pmod(F.xxhash64("id"), F.col("chunks")))
    )
    groups = (
        placed.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("id", "f", "c", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"))
        .join(coded, "id")
        .repartition("dim", "f", "i", "j")
        .sortWithinPartitions("dim", "f", "i", "j")
        .select("dim", "f", "i", "j", "c", "id", "mult", "vec", "filters")
    )
    linked = staged(_linked(groups, threshold), "cap-links")
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    roots = staged(connected_components(linked.select(F.col("id").alias("a"), F.col("root").alias("b"))), "cap-components")
    known = (
        nodes.drop("vec").join(links, "id", "left")
        .join(roots, F.col("id") == roots["node"], "left")
        .select("k1", "k2", "least", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("root", "id").alias("root"))
    )
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    known = staged(known.join(least, "root").select("k1", "k2", "n_links", "component"), "cap-known")
    return rows.drop("vec").join(known, ["k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    )


def op1_cap_filters(spark, sf_dir: str) -> DataFrame:
    rows = near_duplicates(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return rows.withColumn("kept", F.col("vec_id") == F.col("component_id"))


OP1_SQL = r"""
with recursive v as (
  select vec_id, embedding::double[] e from embeddings
  where embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0),
links as (
  select a.vec_id a, b.vec_id b from v a join v b on len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.9),
reach(node, seen) as (
  select vec_id, vec_id from v
  union
  select r.node, l.b from reach r join links l on r.seen = l.a),
least as (select node, min(seen) component_id from reach group by node),
n as (select a, count(*) n from links group by a)
select vec_id, coalesce(n, 0) n_links, coalesce(component_id, vec_id) component_id,
       vec_id = coalesce(component_id, vec_id) kept
from embeddings left join n on a = vec_id left join least on node = vec_id
"""
