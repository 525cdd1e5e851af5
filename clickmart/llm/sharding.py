"""Sharding of documents by best-fit-decreasing bin packing.

All copies of a text form a group, which is never split. Groups, sorted by
size, enter the shard with the tightest remaining capacity that holds
them, found in a balanced tree of capacities. For a number of shards the
least capacity is searched for which the packing needs no more of them,
so all shards come near the same bytes (law ``bytes``). A group larger
than an even share of what is left has a shard of its own first.

Scale. Copies are summed by 128-bit digest before the shuffle. The order
by size and the bytes before each group are exact and distributed
(``ordering.running``). With R bytes left from a group on (T in all),
groups of equal ``floor(PARTS * ln(T / R))`` form an item. A group larger
than R / PARTS is an item of its own, smaller ones are packed in runs of
at most 2 R / PARTS bytes, which shrink with what is left: the last items
are the smallest groups themselves. So at most PARTS * ln(T / 16) + 1
items reach the driver, whatever the corpus, and the table that sends
items to shards, as large, is broadcast. Slots are two-level positions
within the shards; neither a shard nor a group passes through one task.

Defined results: null texts are one group of size 16 each, empty ones
another; equal ids keep the order of their texts' digests; repeated rows
take a slot each; fewer groups than shards leave shards empty; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import running
from .common import read_table, staged

SHARDS = 40
#: Bytes every document takes beside its text.
OVERHEAD = 16
#: Fineness of the items: a run of small groups holds at most 2 / PARTS of the bytes that are left.
PARTS = 1000
#: Shards of a fixed capacity at most; each takes about CAPACITY_PARTS items on the driver.
MAX_SHARDS, CAPACITY_PARTS = 20_000, 32


class CapacityTree:
    """Remaining capacities in order: a B+ tree of two levels, whose blocks split when full."""

    BLOCK = 256

    def __init__(self):
        self.blocks: list[list[tuple[int, int]]] = []
        self.lasts: list[tuple[int, int]] = []

    def add(self, room: int, shard: int) -> None:
        entry = (room, shard)
        if not self.blocks:
            self.blocks, self.lasts = [[entry]], [entry]
            return
        b = min(bisect_left(self.lasts, entry), len(self.blocks) - 1)
        block = self.blocks[b]
        insort(block, entry)
        if len(block) > self.BLOCK:
            half = len(block) // 2
            self.blocks[b : b + 1] = [block[:half], block[half:]]
            self.lasts[b : b + 1] = [block[half - 1], block[-1]]
        else:
            self.lasts[b] = block[-1]

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the tightest (room, shard) that holds ``size``, the lowest shard of equal ones."""
        b = bisect_left(self.lasts, (size, -1))
        if b == len(self.blocks):
            return None
        block = self.blocks[b]
        entry = block.pop(bisect_left(block, (size, -1)))
        if block:
            self.lasts[b] = block[-1]
        else:
            del self.blocks[b], self.lasts[b]
        return entry


def best_fit(sizes: list[int], capacity: int, limit: int | None = None) -> list[int] | None:
    """Shard of each size, taken in the given (falling) order; a larger one than the capacity stands alone.

    None if more than ``limit`` shards are needed.
    """
    tree, out, used = CapacityTree(), [], 0
    for size in sizes:
        entry = tree.take(size)
        if entry is None:
            if used == limit:
                return None
            entry, used = (max(capacity, size), used), used + 1
        out.append(entry[1])
        if entry[0] > size:
            tree.add(entry[0] - size, entry[1])
    return out


def even_shards(sizes: list[int], shards: int) -> list[int]:
    """Shard of each size, sizes falling: the best fit of the least capacity found that needs no more shards."""
    alone, rest = 0, sum(sizes)
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) >= rest:
        rest -= sizes[alone]
        alone += 1
    small, left = sizes[alone:], shards - alone
    if not small:
        return list(range(alone))
    low = max(small[0], -(-rest // left))
    high, best = low, best_fit(small, low, left)
    step = 1
    while best is None:  # an even share plus the largest size always holds them all
        low, high = high + 1, high + step
        best, step = best_fit(small, high, left), step * 2
    while low < high:
        middle = (low + high) // 2
        found = best_fit(small, middle, left)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    return [*range(alone), *[alone + s for s in best]]


def shard_documents(
    docs: DataFrame,
    shards: int | None = SHARDS,
    capacity: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    parts: int = PARTS,
) -> DataFrame:
    """id, size, text_crc32, shard and slot of every row.

    ``shards`` fills so many evenly; ``capacity`` instead opens as few
    shards of so many bytes as best fit needs (at most ``MAX_SHARDS``
    times that many bytes in all; larger groups stand alone).
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give shards or capacity")
    text = F.col(text_col).cast("string")
    rows = staged(
        docs.select(F.col(id_col).alias("doc"), text.alias("text")).select(
            "doc",
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
            F.crc32("text").alias("text_crc32"),
            F.coalesce(F.unhex(F.md5("text")), F.lit(b"")).alias("key"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    placed = running(groups, [F.col("bytes").desc(), F.col("key")], totals={"through": "bytes"})
    total = rows.agg(F.sum("size")).first()[0] or 0
    if capacity and total > MAX_SHARDS * capacity:
        raise ValueError(f"{total} bytes need more than {MAX_SHARDS} shards of {capacity}")
    placed = placed.select("key", "bytes", (F.col("through") - F.col("bytes")).alias("before"))
    item = F.floor(F.log(F.lit(float(total)) / (F.lit(total) - F.col("before"))) * parts)
    # a fixed capacity also needs runs that are small beside it
    run = F.expr(f"before div {max(1, capacity // CAPACITY_PARTS)}") if capacity else F.lit(0)
    placed = staged(placed.select("key", "bytes", item.cast("long").alias("item"), run.cast("long").alias("run")), "shard-groups")

    found = placed.groupBy("item", "run").agg(F.sum("bytes").alias("bytes")).collect()  # bounded: see the module's text
    found.sort(key=lambda r: (-r["bytes"], r["item"], r["run"]))
    sizes = [r["bytes"] for r in found]
    where = even_shards(sizes, shards) if shards else best_fit(sizes, capacity)
    table = rows.sparkSession.createDataFrame(
        [(r["item"], r["run"], s) for r, s in zip(found, where)], "item long, run long, shard int"
    )
    homes = placed.join(F.broadcast(table), ["item", "run"]).select("key", "shard")
    sharded = rows.join(homes, "key")
    slots = running(sharded, [F.col("doc").asc_nulls_first(), F.col("key")], groups=["shard"])
    return slots.select(F.col("doc").alias(id_col), "size", "text_crc32", "shard", (F.col("position") - 1).alias("slot"))


def op11_sharding(spark, sf_dir: str) -> DataFrame:
    """``documents`` in 40 shards of nearly equal bytes; copies of a text stay together."""
    out = shard_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
