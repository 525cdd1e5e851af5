"""Best-fit-decreasing sharding against a plain version and its own laws."""

import random
import zlib
from collections import defaultdict

import pytest
from hard_rows import EDGE, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmart.llm import sharding

SIZES = st.lists(st.one_of(st.integers(1, 60), st.integers(1, 5)), max_size=80).map(lambda v: sorted(v, reverse=True))


def plain_best_fit(sizes, capacity):
    rooms, out = [], []
    for s in sizes:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= s]
        if fits:
            i = min(fits)[1]
        else:
            i = len(rooms)
            rooms.append(max(capacity, s))
        rooms[i] -= s
        out.append(i)
    return out


@settings(max_examples=200, deadline=None)
@given(SIZES, st.integers(1, 80), st.integers(2, 6))
def test_tree_finds_the_tightest_shard(sizes, capacity, block):
    old, sharding.CapacityTree.BLOCK = sharding.CapacityTree.BLOCK, block
    try:
        got = sharding.best_fit(sizes, capacity)
        assert got == plain_best_fit(sizes, capacity)
        assert sharding.best_fit(sizes, capacity, max(got, default=-1) + 1) == got
        assert not got or sharding.best_fit(sizes, capacity, max(got)) is None
    finally:
        sharding.CapacityTree.BLOCK = old


@settings(max_examples=200, deadline=None)
@given(SIZES, st.integers(1, 12))
def test_even_shards(sizes, shards):
    where = sharding.even_shards(sizes, shards)
    assert len(where) == len(sizes) and all(0 <= s < shards for s in where)
    load = [0] * shards
    for s, n in zip(where, sizes):
        load[s] += n
    if sizes:
        # never above the larger of the largest group and an even share plus the largest that shares a shard
        shared = [n for s, n in zip(where, sizes) if where.count(s) > 1]
        assert max(load) <= max(sizes[0], -(-sum(sizes) // shards) + max(shared, default=0))


def test_many_small_groups_fill_evenly():
    rng = random.Random(3)
    sizes = sorted([rng.randrange(20, 40_000) for _ in range(4000)] + [9_000_000], reverse=True)
    load = [0] * 40
    for s, n in zip(sharding.even_shards(sizes, 40), sizes):
        load[s] += n
    rest = load[1:]
    assert load[0] == 9_000_000 and max(rest) - min(rest) <= 0.001 * max(rest)


def check(rows, got, shards):
    assert sorted((str(r.doc_id), r.size, str(r.text_crc32)) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 16, str(None if t is None else zlib.crc32(t.encode()))) for i, t in rows
    )
    homes, slots, load = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in got:
        homes[r.text_crc32].add(r.shard)
        slots[r.shard].append((r.slot, r.doc_id))
        load[r.shard] += r.size
    assert all(len(h) == 1 for h in homes.values())
    for s in slots.values():
        assert [n for n, _ in sorted(s)] == list(range(len(s)))
        ids = [i for _, i in sorted(s, key=lambda x: x[0])]
        assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert set(load) <= set(range(shards))
    return load


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_edge_documents(spark, edge_docs, shards):
    got = sharding.shard_documents(edge_docs, shards=shards).collect()
    load = check([e[:2] for e in EDGE], got, shards)
    groups = defaultdict(int)
    for _, t, _ in EDGE:
        groups[t] += len((t or "").encode()) + 16
    plain = [0] * shards
    for s, n in zip(sharding.even_shards(sorted(groups.values(), reverse=True), shards), sorted(groups.values(), reverse=True)):
        plain[s] += n
    # so few groups are items of their own, or small beside what is left
    assert max(load.values()) <= 1.01 * max(plain)


def test_runs_hot_text_and_capacity(spark):
    rng = random.Random(8)
    rows = [(i, "copied " * 30) for i in range(400)] + [(1000 + i, prose(i, rng.randrange(1, 60))) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    load = check(rows, sharding.shard_documents(df, shards=5, parts=50).collect(), 5)  # coarse items: most groups are in runs
    total = sum(load.values())
    hot = 400 * (len("copied " * 30) + 16)
    assert max(load.values()) == hot > total / 5
    rest = sorted(load.values())[:-1]
    assert rest[-1] - rest[0] < 0.05 * rest[-1]
    fixed = sharding.shard_documents(df, shards=None, capacity=total // 8).collect()
    loads = check(rows, fixed, 1000)
    assert len([v for v in loads.values() if v > total // 8]) == 1 and len(loads) <= 9


def test_empty_table_and_arguments(spark, no_docs):
    assert sharding.shard_documents(no_docs).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_documents(no_docs, shards=3, capacity=5)
    with pytest.raises(ValueError):
        sharding.shard_documents(spark.createDataFrame([(1, "x" * 30_000)], "doc_id long, text string"), shards=None, capacity=1)
