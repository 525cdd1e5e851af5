"""Language ID by multilingual mixture inference.

Each language has a character model: letters given the two before them
inside a word (counts hashed into fixed tables, smoothed with letter
frequencies), learned from all labelled training rows. A document is a mixture:
every word is drawn from one of its languages in unknown proportions.
Expectation-maximisation estimates the proportions from the words'
likelihoods. The language set is the one with the best penalised
likelihood: each language beyond the first costs ``PENALTY`` times the
logarithm of the number of words.

Training is one pass of counts (combined in each task, then by a Spark
sum); the model on the driver has ``2**TRI_BITS + 2**16`` numbers per
language, whatever the corpus. Prediction is one pass without a shuffle,
batches of documents at once in numpy.

Defined results: a text that is null or has no letter, or any text when
nothing was learned, is ``und`` with score 0 and an empty mixture; rows
with null text or null language teach nothing; equal texts get equal
results; ties go to the alphabetically first language; other columns are
carried in ``row`` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, freed, read_table, text_slices

TRI_BITS = 17
#: Pseudo-counts of the letter frequencies in every context.
PRIOR = 2.0
#: Share of words that any language may produce (names, codes, noise).
NOISE = 0.01
#: Price of a further language, times the logarithm of the number of words.
PENALTY = 3.0
ROUNDS = 20
UNKNOWN = "und"

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def _contexts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(trigram cell, bigram, next byte, place) at each letter; words never cross rows."""
    cur = _LETTER[data]
    prev, nxt = np.empty_like(cur), np.empty_like(cur)
    prev[1:], nxt[:-1] = cur[:-1], cur[1:]
    full = offsets[:-1] < offsets[1:]
    prev[offsets[:-1][full]] = 32
    nxt[offsets[1:][full] - 1] = 32
    at = np.flatnonzero(cur != 32)
    p, c, n = prev[at].astype(np.uint32), cur[at].astype(np.uint32), nxt[at].astype(np.uint32)
    two = (p << np.uint32(8)) | c
    three = ((two << np.uint32(8)) | n) * np.uint32(2654435761) >> np.uint32(32 - TRI_BITS)
    return three, two, n, at


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, trigram counts, bigram counts) from every row with a text and a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            text = _lower(batch.column("text"))
            for lang in sorted(set(langs)):
                rows = text.filter(pa.array([x == lang for x in langs]))
                mine = counts.setdefault(lang, [np.zeros(1 << TRI_BITS, np.int64), np.zeros(1 << 16, np.int64)])
                for _, _, data, offsets in text_slices(rows):
                    three, two, _, _ = _contexts(data, offsets)
                    mine[0] += np.bincount(three, minlength=1 << TRI_BITS)
                    mine[1] += np.bincount(two, minlength=1 << 16)
        for lang, tables in counts.items():
            for kind, table in enumerate(tables):
                cell = np.flatnonzero(table)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(cell), pa.string()), pa.array(np.full(len(cell), kind, np.int32)),
                     pa.array(cell.astype(np.int32)), pa.array(table[cell])],
                    ["lang", "kind", "cell", "n"],
                )

    src = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    sums = (
        src.where("lang is not null and text is not null")
        .mapInArrow(run, "lang string, kind int, cell int, n bigint")
        .groupBy("lang", "kind", "cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # at most 2**TRI_BITS + 2**16 rows per language
    )
    lang = np.array(sums.column("lang").to_pylist(), dtype=object)
    names = sorted(set(lang.tolist()))
    kind, cell, n = (sums.column(c).to_numpy() for c in ("kind", "cell", "n"))
    tri, bi = np.zeros((1 << TRI_BITS, len(names)), np.float32), np.zeros((1 << 16, len(names)), np.float32)
    index = np.array([names.index(x) for x in lang], np.int64) if len(lang) else np.zeros(0, np.int64)
    for k, table in enumerate((tri, bi)):
        table[cell[kind == k], index[kind == k]] = n[kind == k]
    return names, tri, bi


class MixtureModel:
    """Word likelihoods and mixture inference for batches of documents."""

    def __init__(self, names: list[str], tri: np.ndarray, bi: np.ndarray):
        self.names = names
        letters = bi.reshape(256, 256, len(names)).sum(axis=0) if names else np.zeros((256, 0), np.float32)
        # what follows a letter is another letter or the word's end
        ends = bi.reshape(256, 256, len(names))[32].sum(axis=0) if names else np.zeros(0, np.float32)
        follow = letters.copy()
        follow[32] = ends
        self.follow = (PRIOR * (follow + 0.5) / (follow.sum(axis=0) + 128.0)).astype(np.float32)
        self.tri = tri
        self.context = np.log(bi + PRIOR).astype(np.float32)
        first = bi.reshape(256, 256, len(names))[32] if names else np.zeros((256, 0), np.float32)
        self.first = np.log((first + 0.5) / (first.sum(axis=0) + 128.0)).astype(np.float32)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(likelihoods of each word, scaled to a maximum of 1, and the row of each word)."""
        three, two, nxt, at = _contexts(data, offsets)
        if not len(at):
            return np.zeros((0, len(self.names)), np.float32), np.zeros(0, np.int64)
        begin = (two >> np.uint32(8)) == 32
        logs = np.log(self.tri[three] + self.follow[nxt]) - self.context[two]
        logs[begin] += self.first[two[begin] & np.uint32(255)]
        start = np.flatnonzero(begin)
        total = np.add.reduceat(logs, start, axis=0)
        total -= total.max(axis=1, keepdims=True)
        like = (1 - NOISE) * np.exp(total) + NOISE
        return like.astype(np.float32), np.searchsorted(offsets, at[start], "right") - 1

    @staticmethod
    def fit(like: np.ndarray, doc: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM of every document at once: (proportions, log-likelihood). ``doc`` is sorted and dense."""
        start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        size = np.diff(np.r_[start, len(doc)])[:, None].astype(np.float32)
        share = allowed / allowed.sum(axis=1, keepdims=True)
        share = share.astype(np.float32)
        for _ in range(ROUNDS):
            part = share[doc] * like
            part /= part.sum(axis=1, keepdims=True)
            share = np.add.reduceat(part, start, axis=0) / size
        fit = np.add.reduceat(np.log((share[doc] * like).sum(axis=1, dtype=np.float64)), start)
        return share.astype(np.float64), fit

    def infer(self, like: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Proportions of the selected language set of each document."""
        k = like.shape[1]
        start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        words = np.diff(np.r_[start, len(doc)])
        price = PENALTY * np.log(words + 1.0)
        single = np.add.reduceat(np.log(like), start, axis=0, dtype=np.float64)
        best = single.argmax(axis=1)
        result = np.eye(k)[best]
        if k == 1:
            return result
        share, fit = self.fit(like, doc, np.ones((len(start), k)))
        value = single.max(axis=1)
        # a set's fit is at most that of all languages: most documents end here
        mixed = np.flatnonzero(fit - value > price)
        if not len(mixed):
            return result
        pick = np.isin(doc, mixed)
        sub_like, sub_doc = like[pick], np.searchsorted(mixed, doc[pick])
        order = np.argsort(-share[mixed], axis=1, kind="stable")
        value = value[mixed]
        for size in range(2, k + 1):
            allowed = np.zeros((len(mixed), k))
            np.put_along_axis(allowed, order[:, :size], 1.0, axis=1)
            part, fit = self.fit(sub_like, sub_doc, allowed)
            gain = fit - price[mixed] * (size - 1)
            better = gain > value
            result[mixed[better]] = part[better]
            value = np.maximum(value, gain)
        return result


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text_col: str = "text") -> DataFrame:
    """row (a struct of all given columns), lang_pred, score (its share), mixture (lang, share by share)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slot = pa.struct([("lang", pa.string()), ("share", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = MixtureModel(*shared.value)
        names = mixture.names
        limit = max(SLICE_BYTES // 16, SLICE_BYTES * 4 // max(4, len(names)))
        for batch in batches:
            text = batch.column("text")
            lower = _lower(text)
            langs, scores, mixes = [UNKNOWN] * len(batch), [0.0] * len(batch), [[]] * len(batch)
            for lo, hi, data, offsets in text_slices(lower, limit) if names else ():
                like, row = mixture.words(data, offsets)
                if not len(row):
                    continue
                have, doc = np.unique(row, return_inverse=True)
                share = mixture.infer(like, doc)
                plain = np.zeros(len(data) + 1, np.int64)
                np.cumsum((data >= 97) & (data <= 122), out=plain[1:])
                ascii_letters = plain[offsets[1:]] - plain[offsets[:-1]]
                for i, part in zip(have.tolist(), share):
                    if not ascii_letters[i] and not any(map(str.isalpha, text[lo + i].as_py())):
                        continue
                    order = np.argsort(-part, kind="stable")
                    langs[lo + i], scores[lo + i] = names[order[0]], min(1.0, float(part[order[0]]))
                    mixes[lo + i] = [{"lang": names[j], "share": float(part[j])} for j in order if part[j] > 0]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in given], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(mixes, pa.list_(slot))],
                [*given, "lang_pred", "score", "mixture"],
            )

    # a text goes to the worker and back once; the row is put together again from it
    others = [c for c in docs.columns if c != text_col]
    rest = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest")] if others else []
    given = ["rest", "text"] if others else ["text"]
    src = docs.select(*rest, F.col(text_col).cast("string").alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema)
    out = src.mapInArrow(
        lambda batches: freed(run(batches)), f"{schema}, lang_pred string, score double, mixture array<struct<lang:string,share:double>>"
    )
    text_type = docs.schema[text_col].dataType
    row = F.struct(*[(F.col("text").cast(text_type) if c == text_col else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])
    return out.select(row.alias("row"), "lang_pred", "score", "mixture")


def held_out(id_col: Column) -> Column:
    """The fold that teaches nothing: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(F.encode(id_col.cast("string"), "utf-8")), F.lit(4)) == 2, F.lit(False))


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    rows = identify(docs.select("doc_id", "text"), model)
    return rows.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "mixture")
