"""Cross-tokenizer alignment by interval coalescing.

Two tokenizers cut the same bytes into intervals. All A and B tokens of a
slice of documents are lexsorted by start; ``maximum.accumulate`` of their
ends is the furthest byte covered so far, and a group breaks where a start
reaches it: there, tokens of both sides have ended. Inside a group,
overlapping tokens are expanded into pairs (a linear number, as neither
side overlaps itself); links are the pairs that end together.

Corpus counts of linked id pairs are one aggregate over per-document
counts. Scoring looks the frequent pairs up in a table of at most
``LOOKUP`` entries, whatever the corpus, and joins the rare ones, each of
which has few occurrences, by pair; both ways always run. The best count
per B id is an aggregate of the pair table.

Defined results: a null or empty text, and one whose tokens' bytes joined
differ from space + text on either side (it holds U+2581, say), has no
tokens: zeros, and an empty digest. Special strings inside a text are
plain text. Repeated rows count each on its own; an empty table gives an
empty table; very long texts are slices of their own; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, staged
from .encoding import CACHE, PieceEncoder

#: Linked id pairs that tasks look up directly; the others are joined.
LOOKUP = 1 << 20
#: Characters of text aligned at once (a longer text is a slice of its own).
SLICE_CHARS = 1 << 18

_SPACE = "▁"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------- token bytes
def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def byte_level_table(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level BPE file; added tokens are their own text."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    of = _byte_of_char()
    found = {i: bytes(of[c] for c in entry) for entry, i in spec["model"]["vocab"].items() if all(c in of for c in entry)}
    found |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    return [found.get(i, b"") for i in range(max(found) + 1)]


def piece_bytes(piece: str) -> bytes:
    """U+2581 is a space, ``<0xHH>`` a byte, anything else UTF-8."""
    if re.fullmatch(r"<0x[0-9A-Fa-f]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(_SPACE, " ").encode()


def spells(ids: bytes, table: list[bytes], text: str) -> bool:
    """Whether the ids' bytes, joined, are the text's."""
    return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]) == text.encode("utf-8", "surrogatepass")


class CheckedPieces(PieceEncoder):
    """Remembers whether ids of some piece ever spelled something else; only then texts are compared whole."""

    def __init__(self, path: str, table: list[bytes]):
        super().__init__(path)
        self.table, self.exact = table, True

    def _encode(self, pieces: list[str]) -> list[bytes]:
        found = super()._encode(pieces)
        self.exact = self.exact and all(spells(ids, self.table, p) for p, ids in zip(pieces, found))
        return found


class SentenceEncoder:
    """Piece ids of whole texts, the leading space included, with a bounded cache of units.

    A unit is a run of spaces and what follows up to the next space or line
    feed, or a line feed. No piece holds a line feed or a space behind
    something else, so no merge crosses units (checked when loaded; else
    texts are encoded whole). A unit is encoded behind a line feed, whose
    pieces are then taken off. ``odd`` are units whose pieces spell
    something else: a text without any is spelled by its own pieces.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.table = [piece_bytes(p) for p in pieces]
        self.by_unit = not any("\n" in p or _SPACE in p.lstrip(_SPACE) for p in pieces)
        self.lead = self.model.encode("\n")
        self.by_unit &= all(self.model.encode("\n" + probe)[: len(self.lead)] == self.lead for probe in ("a", " a", "\n", "  "))
        self.known: dict[str, bytes] = {}
        self.odd: set[str] = set()

    def _new(self, units: list[str]) -> dict[str, bytes]:
        skip, found = len(self.lead), self.model.encode(["\n" + u for u in units], num_threads=1)
        return {u: np.array(ids[skip:], "<u4").tobytes() for u, ids in zip(units, found)}

    def checked(self, text: str) -> tuple[bytes, bool]:
        """Ids as bytes, and whether they spell space + text."""
        if not self.by_unit:
            ids = np.array(self.model.encode(text), "<u4").tobytes()
            return ids, spells(ids, self.table, " " + text)
        units = re.findall(r" *[^ \n]+| +|\n", " " + text)
        parts = list(map(self.known.get, units))
        odd = self.odd
        if None in parts:
            fresh = self._new(list({u for u, i in zip(units, parts) if i is None}))
            strange = {u for u, ids in fresh.items() if not spells(ids, self.table, u)}
            if len(self.known) + len(fresh) <= CACHE:
                self.known.update(fresh)
                self.odd |= strange
            parts = [fresh[u] if i is None else i for u, i in zip(units, parts)]
            odd = odd | strange
        ids = b"".join(parts)
        return ids, odd.isdisjoint(units) or spells(ids, self.table, " " + text)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.checked(text)[0], "<u4").astype(np.int32)


class TokenPair:
    """Both tokenizers with the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str):
        self.a_table, self.b = byte_level_table(a_path), SentenceEncoder(b_path)
        self.a, self.b_table = CheckedPieces(a_path, self.a_table), self.b.table
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_table, self.b_table))

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides; none at all where either side's bytes are not space + text."""
        none = np.zeros(0, np.int32), np.zeros(0, np.int32)
        if not text:
            return none
        a = self.a.encode(" " + text)
        if not (self.a.exact or spells(a, self.a_table, " " + text)):
            return none
        b, exact = self.b.checked(text)
        if not exact:
            return none
        return np.frombuffer(a, "<u4").astype(np.int32), np.frombuffer(b, "<u4").astype(np.int32)


@lru_cache(maxsize=2)
def token_pair(a_path: str, b_path: str) -> TokenPair:
    """One per pair of files and Python worker."""
    return TokenPair(a_path, b_path)


# --------------------------------------------------------------- alignment
def coalesce(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): tokens by start and side, and the group of each in that order."""
    order = np.lexsort((side, start))
    if not len(order):
        return order, np.zeros(0, np.int64)
    covered = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= covered[:-1]
    return order, np.cumsum(breaks) - 1


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all overlapping (A, B) tokens; both sides sorted and free of overlaps of their own."""
    first = np.searchsorted(b_end, a_start, "right")
    n = np.searchsorted(b_start, a_end, "left") - first
    a = np.repeat(np.arange(len(a_start)), n)
    b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return a, b


@lru_cache(maxsize=2)
def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below ``size``, right-aligned in rows behind NULs, a cell left for the mark, and their number."""
    width = len(str(size))
    cells = np.frombuffer(b"".join(str(i).encode().rjust(width, b"\0") + b"\0" for i in range(size)), np.uint8)
    cells = cells.reshape(size, width + 1)
    return cells, np.count_nonzero(cells, axis=1)


def group_texts(ids: np.ndarray, side: np.ndarray, group: np.ndarray, doc: np.ndarray, n_docs: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` per document; tokens come sorted by group."""
    if not len(ids):
        return [b""] * n_docs
    order = np.argsort(group * 2 + side, kind="stable")
    ids, side, group, doc = ids[order], side[order], group[order], doc[order]
    digits, counts = _digits(1 << int(ids.max()).bit_length())  # a power of two: a few tables serve all slices
    cells, count = digits[ids], counts[ids]
    width = cells.shape[1] - 1
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[:-1][side[1:] > side[:-1]] = ord("|")
    mark[:-1][group[1:] > group[:-1]] = ord(";")
    cells[:, width] = mark
    text = cells[cells != 0].tobytes()
    size = np.bincount(doc, weights=count + 1, minlength=n_docs).astype(np.int64)
    ends = np.cumsum(size)
    return [text[e - n : e - 1] if n else b"" for e, n in zip(ends.tolist(), size.tolist())]


def align(pairs: list[tuple[np.ndarray, np.ndarray]], a_size: np.ndarray, b_size: np.ndarray) -> dict[str, np.ndarray | list]:
    """Alignment of a slice of encoded documents.

    Per document n_a, n_b, n_groups and its groups' text; per overlapping
    pair the document, both ids and whether it is a link.
    """
    n_a, n_b = (np.array([len(p[s]) for p in pairs], np.int64) for s in (0, 1))
    docs = np.arange(len(pairs))
    a_id, b_id = (np.concatenate([p[s] for p in pairs]) if pairs else np.zeros(0, np.int32) for s in (0, 1))
    # the documents' bytes stand one after another, so groups never cross documents
    a_end, b_end = np.cumsum(a_size[a_id]), np.cumsum(b_size[b_id])
    a_start, b_start = a_end - a_size[a_id], b_end - b_size[b_id]
    a_doc, b_doc = np.repeat(docs, n_a), np.repeat(docs, n_b)

    side = np.concatenate([np.zeros(len(a_id), np.int8), np.ones(len(b_id), np.int8)])
    order, group = coalesce(np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end]), side)
    doc = np.concatenate([a_doc, b_doc])[order]
    new = np.ones(len(group), bool)
    new[1:] = group[1:] > group[:-1]
    texts = group_texts(np.concatenate([a_id, b_id])[order], side[order], group, doc, len(pairs))
    i, j = overlaps(a_start, a_end, b_start, b_end)
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc[new], minlength=len(pairs)), "texts": texts,
        "doc": a_doc[i], "a": a_id[i], "b": b_id[j], "link": a_end[i] == b_end[j],
    }


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    lo, chars = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > lo and chars + n > SLICE_CHARS:
            yield lo, i
            lo, chars = i, 0
        chars += n
    if lo < len(texts):
        yield lo, len(texts)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def aligned(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None
) -> DataFrame:
    """row, doc, n_a, n_b, n_groups, n_links, groups_sha256 and the linked pairs (code, times) of each document.

    ``row`` tells rows apart; a pair's code is ``a * 2**32 + b``.
    """
    default = default_paths()
    a_path, b_path = a_path or default[0], b_path or default[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        both = token_pair(a_path, b_path)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in _slices(texts):
                got = align([both.encode(t) for t in texts[lo:hi]], both.a_size, both.b_size)
                n = hi - lo
                at = np.flatnonzero(got["link"])
                code = (got["a"][at].astype(np.int64) << 32) + got["b"][at]
                doc = got["doc"][at]
                n_links = np.bincount(doc, minlength=n)
                order = np.lexsort((code, doc))
                code, doc = code[order], doc[order]
                new = np.ones(len(code), bool)
                new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(code)))
                distinct = np.bincount(doc[first], minlength=n)
                digest = [hashlib.sha256(t).hexdigest() if t else "" for t in got["texts"]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)), batch.column("doc").slice(lo, n), pa.array(got["n_a"]), pa.array(got["n_b"]),
                        pa.array(got["n_groups"].astype(np.int64)), pa.array(n_links.astype(np.int64)), pa.array(digest),
                        _lists(code[first], distinct), _lists(times.astype(np.int32), distinct),
                    ],
                    ["row", "doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"],
                )
                row += n

    src = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc"].dataType.simpleString()
    return src.mapInArrow(
        run,
        f"row bigint, doc {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "codes array<bigint>, times array<int>",
    )


def pair_counts(rows: DataFrame) -> DataFrame:
    """code, n (links of the pair corpus-wide) and best (no other A id links the B id more often)."""
    each = rows.select(F.explode(F.arrays_zip("codes", "times")).alias("p")).select("p.codes", "p.times")
    counts = staged(each.groupBy(F.col("codes").alias("code")).agg(F.sum("times").alias("n")), "pair-counts")
    b = F.col("code").bitwiseAND(F.lit(2**32 - 1))
    top = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.join(top, b == top["b"]).select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def _least_looked_up(counts: DataFrame, limit: int) -> int:
    """The smallest power of two that at most ``limit`` pairs reach: at most 64 rows decide it."""
    per = {r["p"]: r["pairs"] for r in counts.groupBy(F.floor(F.log2("n")).alias("p")).agg(F.count(F.lit(1)).alias("pairs")).collect()}
    total, least = 0, 64
    for p in sorted(per, reverse=True):
        total += per[p]
        if total > limit:
            break
        least = p
    return 1 << least if least < 63 else 2**63 - 1


def score_links(rows: DataFrame, lookup: int = LOOKUP) -> DataFrame:
    """Adds n_best and count_sum to staged rows of ``aligned``."""
    spark = rows.sparkSession
    counts = staged(pair_counts(rows), "pair-scores")
    least = _least_looked_up(counts, lookup)
    table = counts.where(F.col("n") >= least).orderBy("code").toArrow()  # at most `lookup` rows
    frequent = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("code", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = frequent.value
        for batch in batches:
            codes, times = batch.column("codes"), batch.column("times").flatten().to_numpy()
            sizes = codes.value_lengths().to_numpy().astype(np.int64)
            flat = codes.flatten().to_numpy()
            doc = np.repeat(np.arange(len(batch)), sizes)
            at = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
            hit = known[at] == flat if len(known) else np.zeros(len(flat), bool)
            total, bests = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(total, doc[hit], n[at[hit]] * times[hit])
            np.add.at(bests, doc[hit], best[at[hit]] * times[hit].astype(np.int64))
            rare = np.bincount(doc[~hit], minlength=len(batch))
            keep = [c for c in batch.schema.names if c not in ("codes", "times")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(bests), pa.array(total), _lists(flat[~hit], rare), _lists(times[~hit], rare)],
                [*keep, "n_best", "count_sum", "codes", "times"],
            )

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("codes", "times")]
    schema = ", ".join([*kept, "n_best bigint", "count_sum bigint", "codes array<bigint>", "times array<int>"])
    looked = staged(rows.mapInArrow(run, schema), "pairs-looked-up")
    rare = looked.select("row", F.explode(F.arrays_zip("codes", "times")).alias("p")).select("row", "p.codes", "p.times")
    rest = (
        rare.join(counts.where(F.col("n") < least), rare["codes"] == F.col("code"))
        .groupBy(F.col("row").alias("rare_row"))
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"),
            F.sum(F.col("n") * F.col("times")).alias("rare_sum"),
        )
    )
    out = looked.drop("codes", "times").join(rest, F.col("row") == F.col("rare_row"), "left")
    return out.withColumns(
        {"n_best": F.col("n_best") + F.coalesce("rare_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))}
    ).drop("rare_row", "rare_best", "rare_sum")


def align_documents(docs: DataFrame, id_col: str = "doc_id", lookup: int = LOOKUP, **options) -> DataFrame:
    """Alignment figures of every document (see ``aligned`` and ``score_links``)."""
    rows = staged(aligned(docs, id_col, **options), "aligned")
    return score_links(rows, lookup).select(
        F.col("doc").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    return align_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"))
