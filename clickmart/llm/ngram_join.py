"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of word shingles, ordered rarest first. If two sets have
a Jaccard similarity of t, their prefixes of ``n - ceil(t n) + l`` tokens
share at least l tokens, for every l (the l-prefix scheme of adaptive set
joins). Each document picks the l, up to ``LEVELS``, with the least
estimated cost - longer postings against fewer candidates to verify - and
as the larger of a pair needs that many shared tokens before verification.

Steps:

1. a fixed-size count sketch of all shingles of all documents gives the
   order (rare before frequent, ties by hash) and the cost estimates;
2. one pass makes each document's set size, set signature, l and prefix;
   equal sets become one vertex;
3. tokens with one vertex are dropped; in each other posting list every
   vertex is compared with a few pivots only (stars, not all pairs): those
   that share most of their own prefix tokens with others, such as the text
   that many were copied from; verified links join vertices into groups;
4. lists whose vertices are all in one group are settled; in the others
   pairs from different groups are joined, counted per pair, and those with
   l shared tokens verified, if the shared tokens and what stands behind
   the prefixes can make up the similarity at all. So no link between different groups is lost,
   and a group of thousands of near copies costs its size, not its square;
5. groups are the connected components of the verified links.

Verification compares whole shingle sets of whole texts.

Defined results: null, empty or wordless texts have no shingles and form
their own group; texts shorter than a shingle are one shingle; copies and
repeated rows are one group, of which one row is kept; null ids take part
(a group's id is its least non-null id); all other columns travel in
``rest`` untouched, whatever their names; an empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACELESS, hashed_words, mix, read_table, shingles, signed, staged, text_slices
from .components import connected_components

#: Cells of each of the two rows of the count sketch.
SKETCH = 1 << 16
#: Most shared prefix tokens that a document may ask for.
LEVELS = 4
#: Cost of verifying a candidate, per shingle, against reading one posting.
VERIFY_COST = 0.05
#: Vertices of a posting list that all others in it are compared with at first.
PIVOTS = 3

_U = np.uint64


def _cells(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h & _U(SKETCH - 1)).astype(np.int64), ((h >> _U(20)) & _U(SKETCH - 1)).astype(np.int64)


def _sketch(docs: DataFrame, words: int) -> np.ndarray:
    """Two rows of occurrence counts over all shingles of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(2 * SKETCH, np.int64)
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                h, row, _, _ = hashed_words(data, offsets, SPACELESS)
                a, b = _cells(shingles(h, row, hi - lo, words)[0])
                table[:SKETCH] += np.bincount(a, minlength=SKETCH)
                table[SKETCH:] += np.bincount(b, minlength=SKETCH)
        cell = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(table[cell])], ["cell", "n"])

    sums = docs.select("text").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(2 * SKETCH, np.int64)  # at most that many rows
    table[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    return table.reshape(2, SKETCH)


def _others(sketch: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Estimated further occurrences of each shingle: the smaller cell less what strangers put there."""
    a, b = _cells(h)
    strangers = sketch[0].sum() / SKETCH
    return np.maximum(np.minimum(sketch[0][a], sketch[1][b]) - 1.0 - strangers, 0.0)


def _choose_level(others: np.ndarray, n: int, prefix: int, required: int) -> int:
    """The number of shared tokens to ask for with the least estimated cost."""
    best, level = np.inf, 1
    for l in range(1, min(LEVELS, required) + 1):
        postings = others[: prefix + l - 1].sum()
        cost = postings + prefix + l + VERIFY_COST * n * postings / l
        if cost < best - 1e-9:
            best, level = cost, l
    return level


def _document_rows(docs: DataFrame, words: int, percent: int, sketch) -> DataFrame:
    """rest, packed, rid, n, sig1, sig2, level, prefix of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sketch.value
        rid = TaskContext.get().partitionId() << 36
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in (whole.slice(first, 1000) for whole in batches for first in range(0, len(whole), 1000)):
            text = batch.column("text")
            size = len(batch)
            n = np.zeros(size, np.int64)
            sig = np.zeros((2, size), np.uint64)
            level = np.zeros(size, np.int32)
            prefixes: list[np.ndarray] = []
            for lo, hi, data, offsets in text_slices(text):
                h, row, _, _ = hashed_words(data, offsets, SPACELESS)
                g, owner = shingles(h, row, hi - lo, words)
                others = _others(table, g)
                rank = np.minimum(2 * np.log2(1 + others), 63).astype(np.uint64)
                token = (rank << _U(58)) | (g >> _U(6))
                edge = np.searchsorted(owner, np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    t = np.sort(token[edge[i] : edge[i + 1]])
                    if len(t):
                        t = t[np.r_[True, t[1:] != t[:-1]]]
                    m = len(t)
                    n[lo + i] = m
                    if not m:
                        prefixes.append(t)
                        continue
                    sig[0, lo + i], sig[1, lo + i] = mix(t).sum(), mix(t * _U(0x9E3779B97F4A7C15) + _U(7)).sum()
                    need = -(-percent * m // 100)
                    p = m - need + 1
                    est = np.exp2((t >> _U(58)).astype(float) / 2) - 1
                    level[lo + i] = _choose_level(est, m, p, need)
                    prefixes.append(t[: p + LEVELS - 1])
            length = np.array([len(p) for p in prefixes], np.int64)
            flat = signed(np.concatenate(prefixes)) if prefixes else np.zeros(0, np.int64)
            some = pa.array(n == 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rest"),
                    pa.array([None if t is None else squeeze.compress(t.encode()) for t in text.to_pylist()], pa.binary()),
                    pa.array(np.arange(rid, rid + size)),
                    pa.array(n),
                    pa.array(signed(sig[0]), mask=some.to_numpy(zero_copy_only=False)),
                    pa.array(signed(sig[1]), mask=some.to_numpy(zero_copy_only=False)),
                    pa.array(level),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)].astype(np.int32)), pa.array(flat)),
                ],
                ["rest", "packed", "rid", "n", "sig1", "sig2", "level", "prefix"],
            )
            rid += size

    kind = docs.schema["rest"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"rest {kind}, packed binary, rid bigint, n bigint, sig1 bigint, sig2 bigint, level int, prefix array<bigint>"
    )


def _verify(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets have the similarity; ``texts`` has id and packed."""

    def sets(packed: dict[int, bytes]) -> dict[int, np.ndarray]:
        out: dict[int, np.ndarray] = {}
        ids = list(packed)
        opener = zstandard.ZstdDecompressor()
        for first in range(0, len(ids), 256):
            part = ids[first : first + 256]
            text = pa.array([opener.decompress(packed[i]) for i in part], pa.large_binary())
            for lo, hi, data, offsets in text_slices(text):
                h, row, _, _ = hashed_words(data, offsets, SPACELESS)
                g, owner = shingles(h, row, hi - lo, words)
                edge = np.searchsorted(owner, np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    out[part[lo + i]] = np.unique(g[edge[i] : edge[i + 1]])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, len(whole), 512):
                batch = whole.slice(first, 512)
                a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                packed = dict(zip(a, batch.column("a_packed").to_pylist())) | dict(zip(b, batch.column("b_packed").to_pylist()))
                have = sets(packed)
                keep = []
                for x, y in zip(a, b):
                    sx, sy = have[x], have[y]
                    both = len(np.intersect1d(sx, sy, assume_unique=True))
                    keep.append(100 * both >= percent * (len(sx) + len(sy) - both))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = (
        pairs.join(texts.select(F.col("id").alias("b"), F.col("packed").alias("b_packed")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("packed").alias("a_packed")), "a")
        .select("a", "b", "a_packed", "b_packed")
    )
    return both.mapInArrow(run, "a bigint, b bigint")


def _missing(percent: int):
    """Shared tokens that a similar pair must have among its indexed prefixes.

    Common tokens up to the end of the prefix that ends first are in both
    prefixes; behind it stand at most that set's other tokens.
    """
    need = F.ceil((F.col("a_n") + F.col("b_n")) * percent / F.lit(100.0 + percent) - 1e-9)
    indexed = lambda n: F.least(n, n - F.floor((n * percent + 99) / 100) + LEVELS)
    unseen = lambda c: F.col(c) - indexed(F.col(c))
    return need - F.greatest(unseen("a_n"), unseen("b_n"))


def ngram_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """rest (struct of the other columns), packed (zstd text), n_shingles, component_id, kept.

    ``kept`` is true for one row of each group: that of its least id.
    """
    spark = docs.sparkSession
    src = docs.select(
        F.struct(*[c for c in docs.columns if c != text_col]).alias("rest"), F.col(text_col).cast("string").alias("text")
    )
    sketch = spark.sparkContext.broadcast(_sketch(src, words))
    rows = staged(_document_rows(src, words, percent, sketch), "join-rows")

    doc = F.col(f"rest.{id_col}")
    first = F.struct(doc.isNull().alias("none"), doc.alias("doc"), "rid")
    nodes = staged(
        rows.where("n > 0").groupBy("sig1", "sig2")
        .agg(F.min("rid").alias("id"), F.min(first).alias("first"), F.max("n").alias("n"), F.max("level").alias("level")),
        "join-nodes",
    )
    base = F.col("n") - F.floor((F.col("n") * percent + 99) / 100)
    entries = rows.join(nodes.select("id"), rows["rid"] == F.col("id")).select(
        "id", base.alias("base"), F.posexplode("prefix").alias("pos", "token")
    ).select(
        "token",
        # place l of the prefix counts from the l-th level on
        (F.col("id") * 8 + F.greatest(F.col("pos") - F.col("base") + 1, F.lit(1))).alias("ref"),
    )
    posting = Window.partitionBy("token")
    live = staged(
        entries.withColumn("lo", F.min("ref").over(posting)).withColumn("hi", F.max("ref").over(posting))
        .where("shiftright(lo, 3) < shiftright(hi, 3)")
        .select("token", F.shiftright("ref", 3).alias("id"), F.col("ref").bitwiseAND(F.lit(7)).alias("level")),
        "join-postings",
    )

    # a vertex with its set size and how many of its indexed tokens others share
    size = staged(
        live.groupBy("id").agg(F.count("*").alias("live")).join(nodes.select("id", "n", F.col("level").alias("asks")), "id"),
        "join-sizes",
    )
    ranked = live.join(size, "id").withColumn(
        "rank", F.row_number().over(Window.partitionBy("token").orderBy((F.col("live") / F.col("n")).desc(), "id"))
    )
    pivots = ranked.where(F.col("rank") <= PIVOTS).select("token", F.col("id").alias("b"))
    # a star pair is worth comparing if it shares half of what a similar pair must; step 4 looks at all others
    stars = (
        live.select("token", F.col("id").alias("a")).join(pivots, "token").where("a <> b")
        .groupBy("a", "b").agg(F.count("*").alias("shared"))
        .join(size.select(F.col("id").alias("a"), F.col("n").alias("a_n")), "a")
        .join(size.select(F.col("id").alias("b"), F.col("n").alias("b_n")), "b")
        .where(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
        .where(2 * F.col("shared") >= _missing(percent))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    # texts of the vertices that share a token: the same plan at every size, whether few or many
    texts = staged(
        rows.select(F.col("rid").alias("id"), "packed").join(live.select("id").distinct().hint("merge"), "id", "left_semi"),
        "join-texts",
    )
    stars = staged(stars, "join-stars")
    links = staged(_verify(stars, texts, words, percent), "join-links")
    groups = staged(connected_components(links), "join-groups")

    placed = live.join(groups, live["id"] == groups["node"], "left").select(
        "token", "id", "level", F.coalesce("root", "id").alias("root")
    )
    open_tokens = (
        placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
    )
    rest = staged(placed.join(open_tokens, "token").join(size, "id"), "join-open")
    cols = ("id", "level", "root", "n", "live")
    x = rest.select("token", F.col("asks"), *[F.col(c).alias(f"a_{c}") for c in cols])
    y = rest.select("token", *[F.col(c).alias(f"b_{c}") for c in cols])
    more = (
        x.join(y, "token")
        .where("a_root <> b_root and struct(a_n, a_id) > struct(b_n, b_id)")
        .where(f"100 * b_n >= {percent} * a_n")
        # no more tokens can be shared than either shares with anyone
        .where(F.least("a_live", "b_live") >= _missing(percent))
        .groupBy(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "asks", "a_n", "b_n")
        .agg(F.count("*").alias("shared"), F.count_if(F.expr("a_level <= asks and b_level <= asks")).alias("asked"))
        .where("asked >= asks")
        .where(F.col("shared") >= _missing(percent))
        .select("a", "b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .join(stars, ["a", "b"], "left_anti")
    )
    found = staged(_verify(staged(more, "join-candidates"), texts, words, percent), "join-more-links")
    bridges = found.join(groups.select(F.col("node").alias("a"), F.col("root").alias("a_root")), "a", "left").join(
        groups.select(F.col("node").alias("b"), F.col("root").alias("b_root")), "b", "left"
    ).select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    merged = connected_components(bridges)
    roots = (
        nodes.join(groups, nodes["id"] == groups["node"], "left")
        .select("sig1", "sig2", "first", F.coalesce("root", "id").alias("group"))
        .join(merged, F.col("group") == merged["node"], "left")
        .select("sig1", "sig2", "first", F.coalesce("root", "group").alias("group"))
    )
    heads = roots.groupBy("group").agg(F.min("first").alias("head"))
    known = staged(roots.join(heads, "group").select("sig1", "sig2", "head"), "join-heads")
    return rows.join(known, ["sig1", "sig2"], "left").select(
        "rest", "packed", F.col("n").alias("n_shingles"),
        F.when(F.col("head").isNull(), doc).otherwise(F.col("head.doc")).alias("component_id"),
        (F.col("head").isNull() | (F.col("head.rid") == F.col("rid"))).alias("kept"),
    )


def unpacked(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """The kept rows as the documents they were, in columns of the given order without the text, then the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = [None if p is None else opener.decompress(p).decode() for p in batch.column("packed").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(texts, pa.string())], ["rest", "text"])

    src = rows.where("kept").select("rest", "packed")
    kind = src.schema["rest"].dataType.simpleString()
    return src.mapInArrow(run, f"rest {kind}, text string").select("rest.*", F.col("text").alias(text_col))


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    rows = ngram_groups(read_table(spark, sf_dir, "documents", "doc_id", "text"), words=3, percent=90)
    return rows.select("rest.doc_id", "n_shingles", "component_id")


OP2_SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') w
  from documents),
s as (
  select distinct doc_id, array_to_string(w[p : p + 2], ' ') g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) p from d where len(w) > 0)),
n as (select doc_id, count(*) n from s group by doc_id),
pairs as (
  select a.doc_id a, b.doc_id b, count(*) both_n from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * both_n >= 90 * (x.n + y.n - both_n)),
edges as (select a, b from links union select b, a from links),
reach(node, seen) as (
  select doc_id, doc_id from n
  union
  select r.node, e.b from reach r join edges e on r.seen = e.a),
least as (select node, min(seen) component_id from reach group by node)
select d.doc_id, coalesce(n.n, 0) n_shingles, coalesce(component_id, d.doc_id) component_id
from d left join n on n.doc_id = d.doc_id left join least on node = d.doc_id
"""
