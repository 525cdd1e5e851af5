"""Shared plumbing of the training-data operators.

Numeric text work (splitting, hashing) is done on Arrow buffers inside
``mapInArrow`` tasks with numpy; everything that meets across rows is a
Spark shuffle. No helper here ever holds more than one slice of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import stage

#: Bytes of text handled at once by the vectorised helpers (a longer text is a slice of its own).
SLICE_BYTES = 1 << 18

_U = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Columns of one of the given tables, read through Spark."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared staging folder and read back, which cuts the lineage."""
    return stage(df, df.sparkSession, label)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """From now on, tasks get their rows in Arrow batches of about ``size``: a worker holds few texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last, memory that Arrow holds but does not use goes back to the machine."""
    yield from batches
    pa.default_memory_pool().release_unused()


# ------------------------------------------------------------ numpy hashing
_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = int(_rng.integers(1, 2**62)) * 4 + 3
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept per worker up to the slice size."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _BASE_INV, np.uint64)
        up[0] = down[0] = 1
        up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if size > 4 * SLICE_BYTES:
            return up, down
        _powers["up"], _powers["down"] = up, down
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Running polynomial hash of 64-bit symbol codes, one longer than the input."""
    up, _ = powers(len(codes) + 1)
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end): equal spans get equal hashes wherever they stand."""
    _, down = powers(len(sums))
    h = (sums[end] - sums[start]) * down[start]
    return mix(h + (end - start).astype(np.uint64) * _U(0x9E3779B97F4A7C15))


def combine(hashes: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of hashes; sequences of different length differ."""
    out = np.full(len(hashes[0]), len(hashes), np.uint64)
    for h in hashes:
        out = mix(out * _U(0xD6E8FEB86659FD93) + h)
    return out


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows of at most ``limit`` bytes.

    A null has no bytes. A run holds one row at least, so a longer text is whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends and row of each run of word bytes; runs never cross rows."""
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, e
    inside = word_byte[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


#: Words are what no white space interrupts: the complement of 0x20 and 0x09 to 0x0D.
SPACELESS = np.ones(256, bool)
SPACELESS[[9, 10, 11, 12, 13, 32]] = False
#: Words are ASCII letters and digits and everything above 0x7F.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def hashed_words(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, row, start, end) of every word, A-Z lower-cased."""
    start, end, row = word_spans(data, offsets, word_byte)
    sums = prefix_sums(BYTE_CODE[_LOWER[data]])
    return span_hash(sums, start, end), row, start, end


def shingles(words: np.ndarray, row: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words and their rows, sorted by row.

    A row of fewer words, but not none, gives its whole sequence as one.
    """
    count = np.bincount(row, minlength=n_rows)
    if len(words) >= k:
        m = len(words) - k + 1
        h = combine([words[i : i + m] for i in range(k)])
        whole = row[k - 1 :] == row[:m]
        hs, rs = [h[whole]], [row[:m][whole]]
    else:
        hs, rs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    first = np.cumsum(count) - count
    for j in range(1, k):
        short = np.flatnonzero(count == j)
        if len(short):
            hs.append(combine([words[first[short] + i] for i in range(j)]))
            rs.append(short)
    h, r = np.concatenate(hs), np.concatenate(rs)
    if len(rs) > 1:
        order = np.argsort(r, kind="stable")
        h, r = h[order], r[order]
    return h, r


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as the signed longs Spark has."""
    return h.view(np.int64)


# ------------------------------------------------------- bounded key filter
def key_bitmap(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of ``2**bits`` cells with the cell of every key set.

    Its size is the parameter's, whatever the number of keys: crowded, it
    only lets more rows through to the exact join behind it.
    """
    cell = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = keys.select(F.shiftright(cell, 5).alias("w"), cell.bitwiseAND(F.lit(31)).cast("int").alias("c")).select(
        "w", F.expr("shiftleft(1L, c)").alias("v")
    )
    found = rows.groupBy("w").agg(F.bit_or("v").alias("v")).collect()
    words = np.zeros(1 << (bits - 5), np.uint64)
    for r in found:
        words[r["w"]] = r["v"]
    return words


def in_bitmap(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes fall on a set cell."""
    cell = h & _U(len(words) * 32 - 1)
    return (words[cell >> _U(5)] >> (cell & _U(31))) & _U(1) != 0
