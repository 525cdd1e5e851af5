"""Line dedup by a segment-partition edit join.

A line (white space at its ends cut off) of at least ``min_chars``
characters is linked to every line that is equal to it or at most
``max_edits`` character edits away. A group is a connected component of
those links, so two of its lines can be further apart than that; its first
line stays and all others go, whether or not they are linked to an earlier
one. First means the least document id, then the line number.

Two lines within t edits share one of t + 1 segments: a line of length L is
cut into t + 1 even segments, indexed under (L, segment number, segment);
every line probes the indexes of lengths L - t to L with the substrings
that multi-match-aware selection leaves (12 for t = 2). Steps:

1. one pass notes each document's lines (hash, characters);
2. one pass emits the index and probe keys of distinct lines as hashes of
   substrings, from running hashes of the text;
3. a key with one line is dropped; in the others every line is compared
   with the key's first indexed line only, and verified links make groups;
4. keys whose lines are all in one group are settled; in the others, pairs
   from different groups that also agree on a group of character counts
   (which lines so close must) are verified. No link between groups is
   lost, and thousands of variants of a line are not compared pair by pair;
5. only lines that share a key travel as text: a fixed-size bitmap of them
   (``FILTER_BITS``) goes to the executors, and the join behind it is exact;
6. verification is the banded bit-parallel edit distance, a whole batch of
   pairs at once.

Lines are identified by 63 bits of a hash; two different lines among n
meet by chance with a probability of about n * n / 2**64.

Shorter lines are grouped by equality alone: lines of ``EXACT_CHARS``
characters or more in at least ``EXACT_DOCS`` documents, and, where
``own_times`` is given (as in the query), lines of ``OWN_CHARS`` or more that
a document holds so many times. Rarer and shorter ones are ordinary
sentences and stay.

Defined results: null text has no lines and stays null; rows with equal id and text count as one document; null ids
come last; other columns travel untouched, whatever their names; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_batches, in_bitmap, key_bitmap, mix, prefix_sums, read_table, signed, span_hash, staged, text_slices
from .components import connected_components

MIN_CHARS = 32
MAX_EDITS = 2
#: Shorter lines are only compared for equality: of so many characters, in so many documents.
EXACT_CHARS, EXACT_DOCS = 10, 5
#: The same for lines that one document repeats: so many characters, so many times.
OWN_CHARS, OWN_TIMES = 6, 5

#: Cells of the bitmap of lines that share a key, as a power of two.
FILTER_BITS = 23

_U = np.uint64
_SPACE = np.zeros(0x3001, bool)
_SPACE[[*range(33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = True


#: Steps by which all lines are trimmed at once; what has more white space is looked up.
_TRIM_STEPS = 16


def _blank(chars: np.ndarray) -> np.ndarray:
    return _SPACE[np.minimum(chars, 0x3001 - 2)]


def _trimmed(chars: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the lines without the white space at their ends; one of nothing else is empty at its start."""
    a, b = start.copy(), np.maximum(start, end)
    for at, step, ahead in ((a, 1, 0), (b, -1, -1)):
        rest = np.flatnonzero(a < b)
        for _ in range(_TRIM_STEPS):
            rest = rest[_blank(chars[at[rest] + ahead])]
            at[rest] += step
            rest = rest[a[rest] < b[rest]]
            if not len(rest):
                break
        if len(rest):
            solid = np.flatnonzero(~_blank(chars))
            if step > 0:
                a[rest] = np.minimum(np.append(solid, len(chars))[np.searchsorted(solid, a[rest])], b[rest])
            else:
                b[rest] = np.maximum(np.append(-1, solid)[np.searchsorted(solid, b[rest])] + 1, a[rest])
    empty = a >= b
    return np.where(empty, start, a), np.where(empty, start, b)


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(code points, row, number, start, end) of every line, ends without white space."""
    if not len(data) or data.max() < 0x80:
        chars, bounds = data.astype(np.uint32), offsets
    else:
        chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        bounds = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), offsets)
    # a line begins at a row's start and behind every line feed; a null or empty row has one empty line
    feed = np.flatnonzero(chars == 10)
    row = np.concatenate([np.arange(len(bounds) - 1), np.searchsorted(bounds, feed, "right") - 1])
    start = np.concatenate([bounds[:-1], feed + 1])
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    first = np.searchsorted(row, np.arange(len(bounds) - 1))
    number = np.arange(len(row)) - first[row]
    last = np.r_[row[1:] != row[:-1], True] if len(row) else np.zeros(0, bool)
    end = np.where(last, bounds[row + 1], np.r_[start[1:], 0] - 1)
    return chars, row, number, *_trimmed(chars, start, end)


def _line_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hash(sums, start, end) & _U(0xFFFFFFFFFFFFFFFE)


def _char_codes(chars: np.ndarray) -> np.ndarray:
    return mix(chars.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _U(1))


#: The codes of the characters of the basic plane; others are rare and computed.
_CODES = _char_codes(np.arange(0x10000))


def _sums(chars: np.ndarray) -> np.ndarray:
    if not len(chars) or chars.max() < len(_CODES):
        return prefix_sums(_CODES[chars])
    codes = _CODES[np.minimum(chars, len(_CODES) - 1)]
    far = np.flatnonzero(chars >= len(_CODES))
    codes[far] = _char_codes(chars[far])
    return prefix_sums(codes)


def _document_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc, key, size (characters), n_lines and (number, chars, line hash) of the lines long enough."""
    entry = pa.struct([("number", pa.int32()), ("chars", pa.int32()), ("line", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null = batch.column("text").is_null().to_numpy(zero_copy_only=False)
            sizes = pc.utf8_length(batch.column("text")).cast(pa.int64())
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                chars, row, number, start, end = _lines(data, offsets)
                long = np.flatnonzero(end - start >= min_chars)
                h = _line_hash(_sums(chars), start[long], end[long])
                count = np.bincount(row, minlength=hi - lo)
                count[null[lo:hi]] = 0
                edge = np.searchsorted(row[long], np.arange(hi - lo + 1)).astype(np.int32)
                entries = pa.StructArray.from_arrays(
                    [pa.array(number[long].astype(np.int32)), pa.array((end - start)[long].astype(np.int32)), pa.array(signed(h))],
                    fields=list(entry),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").slice(lo, hi - lo), batch.column("key").slice(lo, hi - lo),
                        sizes.slice(lo, hi - lo), pa.array(count.astype(np.int32)), pa.ListArray.from_arrays(pa.array(edge), entries),
                    ],
                    ["doc", "key", "size", "n_lines", "lines"],
                )

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc {kind}, key bigint, size bigint, n_lines int, lines array<struct<number:int,chars:int,line:bigint>>")


def _segment(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the i-th of ``parts`` even segments; the last ones take what is over."""
    size, over = length // parts, length % parts
    begin = i * size + np.maximum(0, i - (parts - over))
    return begin, size + (i >= parts - over)


def segment_keys(
    sums: np.ndarray, start: np.ndarray, end: np.ndarray, edits: int
) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(lines, keys, whether they are index keys): the probes of each line, its own index keys among them."""
    length = end - start
    for short in range(edits + 1):
        other = length - short
        for i in range(edits + 1):
            begin, size = _segment(other, i, edits + 1)
            place = mix(other.astype(np.uint64) * _U(edits + 1) + _U(i) + _U(0x51ED27))
            low, high = max(-i, short - (edits - i)), min(i, short + (edits - i))
            for shift in range(low, high + 1):
                at = begin + shift
                fits = np.flatnonzero((at >= 0) & (at + size <= length) & (size > 0))
                s = start[fits] + at[fits]
                yield fits, span_hash(sums, s, s + size[fits]) ^ place[fits], short == 0 and shift == 0


def _line_keys(docs: DataFrame, min_chars: int, edits: int) -> DataFrame:
    """(key, ref): ref is the line hash, its lowest bit set for index keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()  # equal lines of a batch give their keys once
            for _, _, data, offsets in text_slices(batch.column("text")):
                chars, _, _, start, end = _lines(data, offsets)
                long = end - start >= min_chars
                start, end = start[long], end[long]
                sums = _sums(chars)
                h, first = np.unique(_line_hash(sums, start, end), return_index=True)
                new = np.array([x not in seen for x in h.tolist()], bool)
                h, first = h[new], first[new]
                seen.update(h.tolist())
                if not len(h):
                    continue
                keys, refs = [], []
                for lines, key, indexed in segment_keys(sums, start[first], end[first], edits):
                    keys.append(key)
                    refs.append(h[lines] | _U(indexed))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate(keys))), pa.array(signed(np.concatenate(refs)))], ["key", "ref"]
                )

    return docs.select("text").mapInArrow(run, "key bigint, ref bigint")


#: Cells of a line's character counts, each kept modulo 16 in four bits of two longs.
COUNT_CELLS = 32


def count_sketch(chars: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(lines, 2) longs: how many characters of each of 32 classes a line has, modulo 16."""
    size = end - start
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    cell = (mix(chars[at].astype(np.uint64) + _U(11)) & _U(COUNT_CELLS - 1)).astype(np.int64)
    line = np.repeat(np.arange(len(size)), size)
    counts = np.bincount(line * COUNT_CELLS + cell, minlength=len(size) * COUNT_CELLS).reshape(-1, 2, 16).astype(np.uint64) & _U(15)
    return (counts << (np.arange(16, dtype=np.uint64) * _U(4))).sum(axis=2, dtype=np.uint64)


def _sketch_distance(a: str, b: str):
    """What the counts of two lines differ by at least, from their sketches."""
    terms = []
    for half in (1, 2):
        for i in range(16):
            x, y = (f"(shiftrightunsigned({c}{half}, {4 * i}) & 15L)" for c in (a, b))
            d = f"(({x} - {y}) & 15L)"
            terms.append(f"least({d}, 16 - {d})")
    return F.expr(" + ".join(terms))


def _line_texts(docs: DataFrame, min_chars: int, edits: int, wanted) -> DataFrame:
    """(line, chars, s1, s2, parts) of the lines long enough that fall on a set cell of ``wanted`` (a broadcast bitmap), once per batch.

    An edit changes two of the counts by one at most. So lines within t
    edits differ in 2 t counts at most, and agree on one of 2 t + 1 groups
    of counts: ``parts`` are the hashes of those groups.
    """
    cells = np.arange(COUNT_CELLS) % (2 * edits + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            for _, _, data, offsets in text_slices(batch.column("text")):
                chars, _, _, start, end = _lines(data, offsets)
                long = end - start >= min_chars
                start, end = start[long], end[long]
                h = _line_hash(_sums(chars), start, end)
                hit = in_bitmap(wanted.value, h >> _U(1))
                start, end = start[hit], end[hit]
                h, first = np.unique(h[hit], return_index=True)
                new = np.array([x not in seen for x in h.tolist()], bool)
                h, first = h[new], first[new]
                if not len(h):
                    continue
                seen.update(h.tolist())
                text = [chars[start[k] : end[k]].tobytes().decode("utf-32-le") for k in first]
                sketch = count_sketch(chars, start[first], end[first])
                counts = (sketch[:, :, None] >> (np.arange(16, dtype=np.uint64) * _U(4)) & _U(15)).reshape(-1, COUNT_CELLS)
                parts = np.empty((len(h), 2 * edits + 1), np.uint64)
                for g in range(2 * edits + 1):
                    parts[:, g] = _U(g)
                    for c in np.flatnonzero(cells == g):
                        parts[:, g] = mix(parts[:, g] * _U(17) + counts[:, c])
                offs = pa.array((np.arange(len(h) + 1) * (2 * edits + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(h)), pa.array(text, pa.string()), pa.array(signed(sketch[:, 0].copy())), pa.array(signed(sketch[:, 1].copy())),
                     pa.ListArray.from_arrays(offs, pa.array(signed(parts.ravel())))],
                    ["line", "chars", "s1", "s2", "parts"],
                )

    return docs.select("text").mapInArrow(run, "line bigint, chars string, s1 bigint, s2 bigint, parts array<bigint>")


def within_edits(left: list[str], right: list[str], edits: int) -> np.ndarray:
    """Which pairs are at most ``edits`` apart: banded bit-parallel dynamic programming, all pairs at once.

    Bit 63 stands for the row ``edits`` below the diagonal; each column moves
    the band one row down. Rows off the band never match, which cannot hide
    a path of so few edits.
    """
    out = np.zeros(len(left), bool)
    m = np.array([len(x) for x in left], np.int64)
    n = np.array([len(x) for x in right], np.int64)
    near = np.flatnonzero((np.abs(m - n) <= edits) & (np.minimum(m, n) > edits))
    for k in np.flatnonzero(np.minimum(m, n) <= edits):  # too short for a band
        out[k] = _plain_distance(left[k], right[k]) <= edits
    near = near[np.argsort(n[near], kind="stable")]
    for s in range(0, len(near), 4096):
        part = near[s : s + 4096]
        pm, pn = m[part], n[part]
        wide, high = int(pn.max()), int(pm.max())
        a = np.full((len(part), edits + max(high, wide) + 2 * edits + 1), 0xFFFFFFFF, np.uint32)
        b = np.full((len(part), wide), 0xFFFFFFFE, np.uint32)
        for i, k in enumerate(part):
            a[i, edits : edits + pm[i]] = np.frombuffer(left[k].encode("utf-32-le"), np.uint32)
            b[i, : pn[i]] = np.frombuffer(right[k].encode("utf-32-le"), np.uint32)
        a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
        vp = np.full(len(part), 0xFFFFFFFFFFFFFFFF, np.uint64) << _U(63 - edits)
        vn = np.zeros(len(part), np.uint64)
        dist = np.full(len(part), edits, np.int64)
        for j in range(wide):
            match = np.zeros(len(part), np.uint64)
            for k in range(2 * edits + 1):
                match |= (a[j + 2 * edits - k] == b[j]).astype(np.uint64) << _U(63 - k)
            d0 = (((match & vp) + vp) ^ vp) | match | vn
            hp = vn | ~(d0 | vp)
            hn = d0 & vp
            # down the diagonal until the last row, then along it
            below = np.maximum(j - (pm - edits) + 1, 0).astype(np.uint64)
            bit = _U(63) - np.minimum(below, _U(63))
            step = np.where(below == 0, ((d0 >> _U(63)) & _U(1)).astype(np.int64) ^ 1, ((hp >> bit) & _U(1)).astype(np.int64) - ((hn >> bit) & _U(1)).astype(np.int64))
            dist += np.where(j < pn, step, 0)
            down = d0 >> _U(1)
            vp, vn = hn | ~(down | hp), down & hp
        out[part] = dist <= edits
    return out


def _plain_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _verify(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = within_edits(batch.column("a_chars").to_pylist(), batch.column("b_chars").to_pylist(), edits)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = (
        pairs.join(texts.select(F.col("line").alias("b"), F.col("chars").alias("b_chars")), "b")
        .join(texts.select(F.col("line").alias("a"), F.col("chars").alias("a_chars")), "a")
        .select("a", "b", "a_chars", "b_chars")
    )
    return both.mapInArrow(run, "a bigint, b bigint")


def line_groups(docs: DataFrame, min_chars: int, edits: int) -> DataFrame:
    """(line, root) of the lines that are within edits of another line; ``docs`` has a column text."""
    posting = Window.partitionBy("key")
    node = lambda c: F.col(c).bitwiseAND(F.lit(-2))
    live = staged(
        _line_keys(docs, min_chars, edits)
        .withColumn("lo", F.min("ref").over(posting)).withColumn("hi", F.max("ref").over(posting))
        .withColumn("pivot", F.min(F.when(F.col("ref").bitwiseAND(F.lit(1)) == 1, F.col("ref"))).over(posting))
        .where(node("lo") < node("hi")).where("pivot is not null")
        .select("key", node("ref").alias("line"), F.col("ref").bitwiseAND(F.lit(1)).alias("indexed"), node("pivot").alias("pivot"))
        .distinct(),
        "line-postings",
    )
    stars = staged(
        live.where("line <> pivot").select(F.greatest("line", "pivot").alias("a"), F.least("line", "pivot").alias("b")).distinct(),
        "line-stars",
    )
    # lines that share a key: the same plan at every size, whether few or many; the bitmap keeps most others from the
    # shuffle and, crowded, only lets more of them into the join
    bits = key_bitmap(live.select(F.shiftrightunsigned("line", 1).alias("line")), "line", FILTER_BITS)
    wanted = docs.sparkSession.sparkContext.broadcast(bits)
    texts = staged(
        _line_texts(docs, min_chars, edits, wanted)
        .join(live.select("line").distinct().hint("merge"), "line", "left_semi")
        .dropDuplicates(["line"]),
        "line-texts",
    )
    links = staged(_verify(stars, texts, edits), "line-links")
    groups = staged(connected_components(links), "line-groups")

    placed = live.join(groups, live["line"] == groups["node"], "left").select(
        "key", "line", "indexed", F.coalesce("root", "line").alias("root")
    )
    open_keys = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
    rest = staged(
        placed.join(open_keys, "key")
        .join(texts.drop("chars"), "line")
        .select("key", "line", "indexed", "root", "s1", "s2", F.explode("parts").alias("part")),
        "line-open",
    )
    x = rest.where("indexed = 1").select("key", "part", *[F.col(c).alias(f"x_{c}") for c in ("line", "root", "s1", "s2")])
    y = rest.select("key", "part", *[F.col(c).alias(f"y_{c}") for c in ("line", "root", "s1", "s2")])
    more = (
        x.join(y, ["key", "part"])
        .where("x_root <> y_root")
        .where(_sketch_distance("x_s", "y_s") <= 2 * edits)
        .select(F.greatest("x_line", "y_line").alias("a"), F.least("x_line", "y_line").alias("b")).distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    found = staged(_verify(staged(more, "line-candidates"), texts, edits), "line-more-links")
    root_of = lambda c: groups.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    bridges = found.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left").select(
        F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")
    )
    merged = connected_components(bridges)
    members = groups.select(F.col("node").alias("line"), F.col("root").alias("group")).unionByName(
        # lines that only the second round linked are their own group so far
        merged.join(groups, "node", "left_anti").select(F.col("node").alias("line"), F.col("node").alias("group"))
    )
    return members.join(merged, members["group"] == merged["node"], "left").select(
        "line", F.coalesce("root", "group").alias("root")
    )


_PLACE = ("doc", "key", "number")


def _place(*cols):
    """A line's place, as it is ordered: null ids come last."""
    doc, key, number = cols
    return F.struct(F.col(doc).isNull().alias("none"), F.col(doc).alias("doc"), F.col(key).alias("key"), F.col(number).alias("number"))


def _noted_repeats(
    docs: DataFrame, id_col: str, text_col: str, min_chars: int, max_edits: int, own_times: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(documents with their lines, every place of the groups of two places or more with the group's root and first place)."""
    if min_chars <= max_edits:
        raise ValueError("min_chars must exceed max_edits")
    src = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col).cast("string")).alias("key"), F.col(text_col).cast("string").alias("text")
    )
    shortest = min(min_chars, EXACT_CHARS if own_times is None else min(EXACT_CHARS, OWN_CHARS))
    noted = staged(_document_lines(src, shortest), "document-lines")
    groups = staged(line_groups(src, min_chars, max_edits), "line-roots")

    seen = noted.select("doc", "key", F.explode("lines").alias("l")).select("doc", "key", "l.number", "l.chars", "l.line")
    lines = seen.where(F.col("chars") >= min_chars).groupBy("line").agg(F.min(_place(*_PLACE)).alias("first"), F.count("*").alias("n"))
    heads = (
        lines.join(groups, "line", "left").withColumn("root", F.coalesce("root", "line"))
    )
    best = heads.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
    repeats = heads.select("line", "root").join(best, "root").select("line", "root", "first")

    common = (F.col("chars") >= EXACT_CHARS) & (F.col("docs") >= EXACT_DOCS)
    if own_times is not None:
        common = common | ((F.col("chars") >= OWN_CHARS) & (F.col("most") >= own_times))
    equal = (
        seen.where(F.col("chars") < min_chars)
        .groupBy("line", "chars", "doc", "key").agg(F.min("number").alias("number"), F.count("*").alias("n"))
        .groupBy("line", "chars").agg(F.min(_place(*_PLACE)).alias("first"), F.count("*").alias("docs"), F.max("n").alias("most"))
        .where(common)
    )
    repeats = repeats.unionByName(equal.select("line", F.col("line").alias("root"), "first"))
    noted = noted.withColumn("n_long", F.size(F.filter("lines", lambda x: x["chars"] >= min_chars)))
    return noted, seen.join(repeats, "line")


def _marked(noted: DataFrame, places: DataFrame) -> DataFrame:
    removed = (
        places.where(~_place(*_PLACE).eqNullSafe(F.col("first")))
        .groupBy("doc", "key")
        .agg(F.sort_array(F.collect_set("number")).alias("removed"), F.sum("chars").alias("removed_chars"))
        .select(F.col("doc").alias("r_doc"), F.col("key").alias("r_key"), "removed", "removed_chars")
    )
    return noted.join(
        removed, [noted["doc"].eqNullSafe(removed["r_doc"]), noted["key"] == removed["r_key"]], "left"
    ).select(
        "doc", "key", "n_lines", "n_long",
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.coalesce("removed_chars", F.lit(0)).cast("long").alias("removed_chars"),
        "size",
    )


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    max_edits: int = MAX_EDITS,
    own_times: int | None = None,
) -> DataFrame:
    """Per document row: doc, key (xxhash64 of the text), n_lines, n_long, removed (sorted line numbers), removed_chars."""
    return _marked(*_noted_repeats(docs, id_col, text_col, min_chars, max_edits, own_times)).drop("size")


def _passed_on(marks: DataFrame, places: DataFrame) -> DataFrame:
    """``marks`` (with ``bare``) where each group keeps a line in a document that stays.

    A group whose first place is in a bare document stays at its first place
    in another one, or, where all its places are in bare documents, at its
    first place, and that document is not bare then.
    """
    id_of = lambda df, doc, key: df.select(F.col(doc).alias("b_doc"), F.col(key).alias("b_key")).distinct()
    bare = staged(id_of(marks.where("bare"), "doc", "key"), "line-bare")
    is_bare = lambda doc, key: [F.col(doc).eqNullSafe(F.col("b_doc")), F.col(key) == F.col("b_key")]
    roots = (
        places.where(_place(*_PLACE).eqNullSafe(F.col("first")))
        .join(bare, is_bare("doc", "key"), "left_semi").select("root").distinct()
    )
    held = places.join(roots, "root").join(bare.withColumn("gone", F.lit(True)), is_bare("doc", "key"), "left")
    moved = staged(
        held.groupBy("root", "first").agg(F.min(F.when(F.col("gone").isNull(), _place(*_PLACE))).alias("next")), "line-moved"
    )
    change = (
        # the bare document's own line goes if another document has it, and stays otherwise; the other's stays
        moved.select("first.*", F.col("next").isNull().alias("stays"))
        .unionByName(moved.where("next is not null").select("next.*", F.lit(True).alias("stays")))
        .groupBy("doc", "key")
        .agg(F.collect_set(F.when(F.col("stays"), F.col("number"))).alias("back"), F.collect_set(F.when(~F.col("stays"), F.col("number"))).alias("off"))
        .select(F.col("doc").alias("c_doc"), F.col("key").alias("c_key"), "back", "off")
    )
    return marks.join(change, [F.col("doc").eqNullSafe(F.col("c_doc")), F.col("key") == F.col("c_key")], "left").select(
        "doc", "key",
        F.when(F.col("back").isNull(), F.col("removed")).otherwise(F.array_union(F.array_except("removed", "back"), "off")).alias("removed"),
        (F.col("bare") & (F.coalesce(F.size("back"), F.lit(0)) <= 0)).alias("bare"),
    )


def without_lines(text, removed):
    """The text column without the lines of those numbers."""
    numbered = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(i.alias("i"), line.alias("line")))
    kept = F.filter(numbered, lambda e: ~F.array_contains(removed, e["i"]))
    return F.array_join(F.transform(kept, lambda e: e["line"]), "\n")


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bare_share: float | None = None,
    min_chars: int = MIN_CHARS,
    max_edits: int = MAX_EDITS,
    own_times: int | None = OWN_TIMES,
) -> DataFrame:
    """The documents without repeated lines (those of ``repeated_lines``); one of which nothing but white space is left goes.

    Each group of repeated lines keeps its first one. With ``bare_share``, a
    document that loses so much of its characters goes as well, with what it
    has of lines found nowhere else; its groups keep a line elsewhere.
    """
    noted, places = _noted_repeats(docs, id_col, text_col, min_chars, max_edits, own_times)
    places = staged(places, "line-places")
    marks = staged(_marked(noted, places).dropDuplicates(["doc", "key"]), "line-marks").where("size(removed) > 0")
    if bare_share is None:
        marks = marks.withColumn("bare", F.lit(False))
    else:
        marks = _passed_on(marks.withColumn("bare", F.col("removed_chars") >= bare_share * F.col("size")), places)
        marks = staged(marks, "line-passed-on")
    marks = marks.select(
        F.col("doc").alias("_m_doc"), F.col("key").alias("_m_key"), F.col("removed").alias("_m_removed"), F.col("bare").alias("_m_bare")
    )
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col).cast("string")).alias("key"))
    joined = whole.join(marks, [whole["doc"].eqNullSafe(marks["_m_doc"]), whole["key"] == marks["_m_key"]], "left")
    text = F.col(f"row.{text_col}")
    fresh = F.when(F.col("_m_removed").isNull(), text).otherwise(without_lines(text, F.col("_m_removed")))
    left = joined.where("not coalesce(_m_bare, false)").select("row", fresh.alias("left"), F.col("_m_removed").isNull().alias("whole"))
    return left.where(F.col("whole") | F.col("left").rlike(r"\S")).select(
        *[F.col("left" if c == text_col else f"row.`{c}`").alias(c) for c in docs.columns]
    )


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    rows = repeated_lines(read_table(spark, sf_dir, "documents", "doc_id", "text"), own_times=OWN_TIMES)
    return rows.select(
        F.col("doc").alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed_lines"), "removed_chars",
    )
