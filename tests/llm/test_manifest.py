"""The Merkle manifest against a plain recursive tree."""

import hashlib

import pytest
from hard_rows import EDGE
from pyspark.sql import functions as F

from clickmart.llm import merkle_manifest as mm


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, arity):
    """(top, [proof of each node as (left digests, right digests) per level])."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for leaf, i in enumerate(at):
            run, slot = runs[i // arity], i % arity
            ways[leaf].append((run[:slot], run[slot + 1 :]))
        nodes, at = [sha(*r) for r in runs], [i // arity for i in at]
    return nodes[0], ways


def brute(rows, arity, bump):
    """rows: (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: sha(*map(field, r))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = (members, *climb([leaf(r) for r in members], arity))
    root, upper = climb([trees[g][1] for g in names], arity)
    out = []
    for k, g in enumerate(names):
        members, subroot, ways = trees[g]
        for r, way in zip(members, ways):
            way = way + upper[k]
            n = r[3] + 1 if bump(r) and r[3] is not None else r[3]
            folded = leaf((r[0], r[1], r[2], n, r[4]))
            for left, right in way:
                folded = sha(*left, folded, *right)
            out.append((r[0], leaf(r), subroot, root, sha(*[s for lr in way for side in lr for s in side]), folded))
    return sorted(out, key=str)


def result(rows):
    out = rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(mm.proof_text(F.col("path")), 256), mm.fold(F.col("other_leaf"), F.col("path"))
    )
    return sorted([tuple(r) for r in out.collect()], key=str)


@pytest.mark.parametrize("arity", [2, 5])
def test_edge_documents(spark, edge_docs, arity):
    # nulls in every column, repeated rows, a very long text, other columns named like internal ones
    rows = [(i, None, lang, len(t) if t else None, t) for i, t, lang in EDGE]
    got = mm.manifest(edge_docs, arity=arity, tampered={"n_chars": F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    assert result(got) == brute(rows, arity, lambda r: r[0] is not None and r[0] % 3 == 0)


@pytest.mark.parametrize("n", [1, 2, 9])
def test_sizes(spark, n):
    # one group larger than all others together, numbers as text have several digits
    rows = [(i * 7, f"s{i}", "é" if i % 3 == 2 else "x", i, f"text {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    assert result(mm.manifest(docs)) == brute(rows, 2, lambda r: False)


def test_untampered_rows_verify_and_tampered_do_not(spark):
    rows = [(i, "s", "l", None if i % 10 == 0 else i, "t") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = mm.manifest(docs, tampered={"n_chars": F.col("n_chars") + 1})
    ok = got.select("doc_id", (mm.fold(F.col("other_leaf"), F.col("path")) == F.col("root")).alias("ok")).collect()
    assert {r.doc_id for r in ok if r.ok} == {0, 10, 20, 30}


def test_empty_table_and_arity(spark, no_docs):
    assert mm.manifest(no_docs).count() == 0
    with pytest.raises(ValueError):
        mm.manifest(no_docs, arity=1)
