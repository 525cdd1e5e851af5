"""Benchmark decontamination: a prefix-filtered set join of word windows.

An item's windows are its runs of ``window`` consecutive words (an item of
fewer words is one window). A window occurs in a document where all its
shingles stand in order, so containment is 1 and the necessary prefix is
one shingle: the window's rarest over all documents. Steps:

1. windows and shingles of the items, equal windows once;
2. document frequency of every item shingle, counted over all documents;
3. the rarest shingle of each window with its offset there;
4. documents' places of such shingles, each with the words around it;
5. join on the shingle; the place minus the offset must leave room for
   the window inside the document (position and length bounds), and the
   words must be the window's, word for word;
6. per document the union of hit words and the items found.

Documents are read twice and never shuffled whole; a fixed-size bitmap of
item shingles (``FILTER_BITS``, whatever the number of items) decides on
the executors which places can matter, and the join is exact.

Defined results: null or wordless texts have no words and no hits; an
item with a null id hits words but is not named; equal items or repeated
rows give equal results; an empty benchmark hits nothing; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ALNUM, combine, hashed_words, in_bitmap, key_bitmap, signed, staged, text_slices

WINDOW = 10
SHINGLE = 3
#: Cells of the shingle filter sent to executors: 2**23 bits, 2 MB as held here.
FILTER_BITS = 23


def _lists(starts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> pa.ListArray:
    """Arrow lists values[start : start + length]."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    take = np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.LargeListArray.from_arrays(offsets, values[take]).cast(pa.list_(values_type(values)))


def values_type(values: np.ndarray) -> pa.DataType:
    return pa.from_numpy_dtype(values.dtype)


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """(item, words): the word hashes of every window of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                h, row, _, _ = hashed_words(data, offsets, ALNUM)
                count = np.bincount(row, minlength=hi - lo)
                first = np.cumsum(count) - count
                n = np.where(count == 0, 0, np.maximum(1, count - window + 1))
                size = np.repeat(np.minimum(count, window), n)
                at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                owner = np.repeat(np.arange(lo, hi), n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array(owner)), _lists(at, size, signed(h))], ["item", "words"]
                )

    src = items.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["item"].dataType.simpleString()
    return src.mapInArrow(run, f"item {kind}, words array<bigint>")


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(wid, words, offset, gram): each shingle of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            flat = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            length = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.cumsum(length) - length
            for k in range(1, shingle + 1):
                pick = np.flatnonzero(length >= shingle if k == shingle else length == k)
                if not len(pick):
                    continue
                n = length[pick] - k + 1
                off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(first[pick], n) + off
                owner = pa.array(np.repeat(pick, n))
                gram = combine([flat[at + i] for i in range(k)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("wid").take(owner), words.take(owner), pa.array(off.astype(np.int32)),
                     pa.array(np.full(len(off), k, np.int32)), pa.array(signed(gram))],
                    ["wid", "words", "offset", "size", "gram"],
                )

    return windows.mapInArrow(run, "wid bigint, words array<bigint>, offset int, size int, gram bigint")


def _grams(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the runs of exactly ``k`` words inside one row."""
    m = len(h) - k + 1
    if m < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(row[k - 1 :] == row[:m])
    return at, combine([h[at + i] for i in range(k)])


def _gram_counts(docs: DataFrame, sizes: list[int], cells) -> DataFrame:
    """(gram, n): occurrences in all documents of what the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, data, offsets in text_slices(batch.column("text")):
                h, row, _, _ = hashed_words(data, offsets, ALNUM)
                for k in sizes:
                    g = _grams(h, row, k)[1]
                    found.append(g[in_bitmap(cells.value, g)])
            if found:
                gram, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(gram)), pa.array(n)], ["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _places(docs: DataFrame, sizes: list[int], cells, window: int) -> DataFrame:
    """A row per document (gram null) and a row per place where the filter lets a gram through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                h, row, _, _ = hashed_words(data, offsets, ALNUM)
                count = np.bincount(row, minlength=hi - lo)
                first = np.cumsum(count) - count
                at, gram = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for k in sizes:
                    a, g = _grams(h, row, k)
                    hit = in_bitmap(cells.value, g)
                    at.append(a[hit])
                    gram.append(g[hit])
                at, gram = np.concatenate(at), np.concatenate(gram)
                owner = row[at]
                begin = np.maximum(at - window + 1, first[owner])
                end = np.minimum(at + window, first[owner] + count[owner])
                none = pa.nulls(hi - lo, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([batch.column(c).slice(lo, hi - lo), batch.column(c).take(pa.array(lo + owner))])
                        for c in ("doc", "key")
                    ]
                    + [
                        pa.array(np.concatenate([count, count[owner]])),
                        pa.concat_arrays([none, pa.array(signed(gram))]),
                        pa.concat_arrays([none, pa.array(at - first[owner])]),
                        pa.concat_arrays([none, pa.array(at - begin)]),
                        pa.concat_arrays([pa.nulls(hi - lo, pa.list_(pa.int64())), _lists(begin, end - begin, signed(h))]),
                    ],
                    ["doc", "key", "n_words", "gram", "pos", "lead", "around"],
                )

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"doc {kind}, key bigint, n_words bigint, gram bigint, pos bigint, lead bigint, around array<bigint>"
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> tuple[DataFrame, DataFrame]:
    """(per document, spans).

    Per document row: doc, key (xxhash64 of the text), n_words, n_hit and
    items (sorted array of item ids as strings). Spans: doc, key, start,
    words of each occurrence of a window, for masking instead of dropping.
    """
    spark = docs.sparkSession
    src = docs.select(
        F.col(id_col).alias("doc"),
        F.xxhash64(F.col(text_col).cast("string")).alias("key"),
        F.col(text_col).cast("string").alias("text"),
    )
    named = staged(item_windows(items, item_col, item_text_col, window, shingle), "item-windows")
    named = named.withColumn("wid", F.xxhash64("words"))
    windows = named.select("wid", "words").distinct()
    grams = staged(_window_shingles(windows, shingle), "window-shingles")
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect())  # at most `shingle` values

    cells = spark.sparkContext.broadcast(key_bitmap(grams, "gram", FILTER_BITS))
    counts = _gram_counts(src, sizes, cells)
    rare = (
        grams.join(counts, "gram")  # a window with a shingle that no document has cannot occur
        .groupBy("wid", "words")
        .agg(F.count(F.lit(1)).alias("present"), F.min(F.struct("n", "gram", "offset")).alias("first"))
        .where("present = greatest(size(words) - %d, 1)" % (shingle - 1))
        .select("wid", "words", "first.gram", "first.offset")
    )
    rare = staged(rare, "window-prefixes")
    cells = spark.sparkContext.broadcast(key_bitmap(rare, "gram", FILTER_BITS))
    places = staged(_places(src, sizes, cells, window), "document-places")

    spans = (
        places.where("gram is not null")
        .join(rare, "gram")
        .where("offset <= lead and pos - offset + size(words) <= n_words")
        .where("slice(around, cast(lead - offset + 1 as int), size(words)) = words")
        .select("doc", "key", "wid", (F.col("pos") - F.col("offset")).alias("start"), F.size("words").alias("words"))
        .distinct()
    )
    spans = staged(spans, "document-spans")
    here = Window.partitionBy("doc", "key").orderBy("start", "words").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("words")
    hit = (
        spans.select("doc", "key", "start", "words").distinct()
        .withColumn("before", F.max(end).over(here))
        .groupBy("doc", "key")
        .agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", F.coalesce("before", "start")))).alias("n_hit"))
    )
    found = (
        spans.select("doc", "key", "wid").distinct()
        .join(named.where("item is not null").select("wid", F.col("item").cast("string").alias("item")).distinct(), "wid")
        .groupBy("doc", "key")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    marks = hit.join(found, [hit["doc"].eqNullSafe(found["doc"]), hit["key"] == found["key"]], "left").select(
        hit["doc"].alias("m_doc"), hit["key"].alias("m_key"), "n_hit", "items"
    )
    rows = places.where("gram is null").select("doc", "key", "n_words")
    out = rows.join(
        marks, [rows["doc"].eqNullSafe(marks["m_doc"]), rows["key"] == marks["m_key"]], "left"
    ).select(
        "doc", "key", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return out, spans.drop("wid")


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    from .common import read_table

    rows, _ = contamination(
        read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark", "item_id", "text")
    )
    return rows.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP9_SQL = r"""
with d as (
  select doc_id, row_number() over () rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from documents),
b as (
  select item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from benchmark),
bw as (
  select distinct item_id, array_to_string(w[p : p + 9], ' ') win, least(len(w), 10) k
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) p from b where len(w) > 0)),
ks as (select distinct k from bw),
dw as (
  select rid, p, k, array_to_string(w[p : p + k - 1], ' ') win
  from (select rid, w, k, unnest(range(1, len(w) - k + 2)) p from d, ks where len(w) >= k)),
hits as (select distinct rid, p, dw.k, item_id from dw join bw on dw.win = bw.win and dw.k = bw.k),
covered as (select rid, count(distinct p + i) n_hit from (select rid, p, unnest(range(0, k)) i from hits) group by rid),
named as (
  select rid, count(*) n_items, string_agg(item, ',' order by item) items
  from (select distinct rid, cast(item_id as varchar) item from hits where item_id is not null) group by rid)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join covered using (rid) left join named using (rid)
"""
