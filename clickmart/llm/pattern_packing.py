"""Best-fit packing by length patterns and non-negative least squares.

Documents become token pieces of at most ``length`` tokens; only the
histogram of piece lengths (at most ``length`` numbers, whatever the
corpus) reaches the driver. There

1. every pattern of up to ``PARTS`` lengths that fills a sequence exactly
   is enumerated;
2. repeat counts x >= 0 are fitted to the histogram h by least squares,
   ``min |A x - h|``, with accelerated projected gradients on the sparse A;
3. the counts are rounded, largest first, never beyond what is left; the
   fit is repeated on the rest while it still places pieces;
4. residuals are packed best fit, longest first, in bulk per length.

Where most lengths occur once, full patterns use up the short pieces that
would fill the gaps of the rest; so the residual is packed after each
round of fitting, with counts rounded up and rounded down, and the plan
with the fewest sequences is used (of equal ones that with most patterns).

The result is a table of slots - for the k-th piece of each length its
sequence and offset - whose size depends on ``length`` alone. Pieces are
numbered per length by two-level counts (within and across ``spread``
buckets, so a length that a third of all pieces share is spread over
tasks) and look their slot up.

Defined results: null or empty text is the end id alone; a special token's
string in a text is that token, as the tokenizer file reads it; equal documents
and repeated rows are packed each on its own; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read_table, staged
from .encoding import default_path, encoder

LENGTH = 1024
END_ID = 2
PARTS = 3
#: Projected-gradient steps of each fit, and fits at most.
STEPS, FITS = 400, 6


# ------------------------------------------------------------------ pieces
def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    tokenizer_path: str | None = None,
    keep_ids: bool = True,
) -> DataFrame:
    """doc, piece, start, length, ids_crc32, spread and (optionally) ids of each piece.

    The first piece of a longer document takes what is over, the others are full.
    """
    path = tokenizer_path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path, specials=True), np.array([end_id], "<u4").tobytes()
        seen = 0
        for batch in batches:
            owner, piece, start, size, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                data = enc.encode(text.as_py() or "") + end
                n = len(data) // 4
                cuts = [0, *range(n % length or length, n + 1, length)] if n > length else [0, n]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = data[4 * a : 4 * b]
                    owner.append(i)
                    piece.append(p)
                    start.append(a)
                    size.append(b - a)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(part)
            columns = [
                batch.column("doc").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(size, pa.int64()), pa.array(crc, pa.int64()),
                pa.array((np.arange(seen, seen + len(owner)) * 2654435761 % 2**31).astype(np.int64)),
            ]
            names = ["doc", "piece", "start", "length", "ids_crc32", "spread"]
            seen += len(owner)
            if keep_ids:
                flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    src = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, spread bigint"
    return src.mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))


# -------------------------------------------------------------------- plan
def _patterns(present: np.ndarray, length: int, parts: int) -> np.ndarray:
    """Rows of ``parts`` lengths (zero-padded, falling) that add up to ``length``, of present lengths only."""
    out = []

    def grow(rest: np.ndarray, left: int):
        # rest: rows of chosen lengths; close each with its remainder, or choose one more
        total = rest.sum(axis=1)
        last = length - total
        top = rest[:, -1] if rest.shape[1] else np.full(len(rest), length - 1)
        ok = (last >= 1) & (last <= top)
        ok[ok] = present[last[ok]]
        closed = np.column_stack([rest[ok], last[ok]])
        out.append(np.pad(closed, ((0, 0), (0, parts - closed.shape[1]))))
        if left > 1:
            nxt = np.flatnonzero(present)
            for v in nxt:
                keep = (v <= top) & (total + v < length)
                if keep.any():
                    grow(np.column_stack([rest[keep], np.full(keep.sum(), v)]), left - 1)

    lengths = np.flatnonzero(present[:length])
    grow(lengths[:, None], parts - 1)
    return np.concatenate(out) if out else np.zeros((0, parts), np.int64)


def fit_counts(patterns: np.ndarray, hist: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares: counts x with the least |A x - hist|."""
    used = patterns > 0
    flat = patterns[used]
    col = np.broadcast_to(np.arange(len(patterns))[:, None], patterns.shape)[used]
    size = len(hist)
    h = hist.astype(float)

    def a(x):
        return np.bincount(flat, weights=x[col], minlength=size)

    def at(y):
        return np.where(used, y[patterns], 0.0).sum(axis=1)

    v = np.ones(len(patterns))
    for _ in range(12):  # the largest eigenvalue of A'A by power iteration
        v = at(a(v))
        norm = np.linalg.norm(v)
        v /= norm
    rate = 1.0 / (1.05 * norm)
    x = np.zeros(len(patterns))
    y, t = x, 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - rate * at(a(y) - h))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        if ((y - new) * (new - x)).sum() < 0:  # overshoot: start the momentum again
            y, t_new = new, 1.0
        x, t = new, t_new
    return x


def _round(patterns: np.ndarray, x: np.ndarray, left: np.ndarray, up: bool = True) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeat counts, largest fits first, never more than is left of a length."""
    placed = []
    for i in np.argsort(-x, kind="stable"):
        want = int(np.ceil(x[i] - 1e-9) if up else np.floor(x[i] + 1e-9))
        if want <= 0:
            break
        lengths = tuple(int(v) for v in patterns[i] if v)
        n = want
        for v in set(lengths):
            n = min(n, int(left[v]) // lengths.count(v))
        if n > 0:
            for v in lengths:
                left[v] -= n
            placed.append((lengths, n))
    return placed


def _best_fit(left: np.ndarray, length: int) -> list[tuple[tuple[int, ...], int]]:
    """What is left, longest first, each into the fullest open sequence that has room."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for v in range(length, 0, -1):
        n = int(left[v])
        while n:
            gap = min((g for g in groups if g >= v), default=None)
            if gap is None:
                groups.setdefault(length - v, []).append(((v,), n))
                n = 0
                continue
            content, count = groups[gap].pop()
            if not groups[gap]:
                del groups[gap]
            take = min(n, count)
            if count > take:
                groups.setdefault(gap, []).append((content, count - take))
            groups.setdefault(gap - v, []).append((content + (v,), take))
            n -= take
        left[v] = 0
    return [g for gs in groups.values() for g in gs]


def pattern_plan(hist: np.ndarray, length: int = LENGTH, parts: int = PARTS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) whose lengths use up the histogram exactly; ``hist[v]`` pieces have length v."""
    full = [((length,), int(hist[length]))] if hist[length] else []
    rest = hist.astype(np.int64).copy()
    rest[length] = 0
    best: tuple[int, list] | None = None
    for up in (False, True):
        left, plan = rest.copy(), []
        for fits in range(FITS + 1):
            whole = plan + _best_fit(left.copy(), length)
            size = sum(n for _, n in whole)
            if best is None or size <= best[0]:
                best = size, whole
            patterns = _patterns(left > 0, length, parts) if fits < FITS else ()
            if not len(patterns):
                break
            placed = _round(patterns, fit_counts(patterns, left), left, up)
            plan = plan + placed
            if not placed:
                break
    return full + best[1]


def plan_slots(plan: list[tuple[tuple[int, ...], int]], length: int) -> tuple[np.ndarray, ...]:
    """(code, sequence, offset) sorted by code = length * 2**40 + first index; the next pieces follow on."""
    used = np.zeros(length + 1, np.int64)
    code, seq, offset, base = [], [], [], 0
    for lengths, n in plan:
        at = 0
        for v in lengths:
            code.append((v << 40) + int(used[v]))
            seq.append(base)
            offset.append(at)
            used[v] += n
            at += v
        base += n
    order = np.argsort(np.array(code, np.int64), kind="stable")
    return tuple(np.array(c, np.int64)[order] for c in (code, seq, offset))


# --------------------------------------------------------------- placement
def pack(pieces: DataFrame, length: int = LENGTH, parts: int = PARTS) -> DataFrame:
    """Adds sequence_id and offset to staged pieces (see ``token_pieces``)."""
    spark = pieces.sparkSession
    hist = np.zeros(length + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most `length` rows
        hist[r["length"]] = r["n"]
    slots = spark.sparkContext.broadcast(plan_slots(pattern_plan(hist, length, parts), length))

    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = pieces.withColumn("bucket", F.pmod("spread", F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
        .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("length", "bucket").orderBy("spread", "doc", "piece", "ids_crc32")
    numbered = (
        pieces.withColumn("k", F.row_number().over(inside) - 1)
        .join(bases, ["length", "bucket"])
        .withColumn("code", F.shiftleft(F.col("length"), 40) + F.col("base") + F.col("k"))
        .drop("bucket", "spread", "k", "base")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, seqs, offsets = slots.value
        for batch in batches:
            if not len(batch):
                continue
            code = batch.column("code").to_numpy()
            at = np.searchsorted(codes, code, "right") - 1
            keep = [c for c in batch.schema.names if c != "code"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(seqs[at] + code - codes[at]), pa.array(offsets[at])],
                [*keep, "sequence_id", "offset"],
            )

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "code"]
    return numbered.mapInArrow(run, ", ".join([*fields, "sequence_id bigint", "offset bigint"]))


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and its ids: at most ``length`` tokens a group."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, keep_ids: bool = False, **options) -> DataFrame:
    """Pieces of the documents with their sequence and offset; the ids too if asked for."""
    pieces = staged(token_pieces(docs, keep_ids=keep_ids, **options), "token-pieces")
    placed = pack(pieces, options.get("length", LENGTH))
    cols = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    return placed.select(F.col("doc").alias(options.get("id_col", "doc_id")), *cols)


def op6_pattern_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"))
