"""From raw documents to packed training sequences, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and reread as
the next stage's ``docs``. Each works on all rows its predecessor kept, and
all but the last return the columns of ``documents``:

1. language ID drops documents without a letter, as no language is in them;
2. line dedup takes repeated lines out, and documents of which nothing is left;
3. the n-gram Jaccard join (five words, 0.8) keeps one document of a group;
4. benchmark decontamination drops documents with a window of an item;
5. best-fit packing returns the token pieces and where they stand.

Every stage handles nulls in any column, empty and very long texts, ties
and repeated rows, empty tables and extra columns of any name as its
operator's docstring says: a null or letterless text ends in stage 1, of
repeated rows one stays after stage 3, extra columns travel untouched up
to stage 4 and are not part of the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm.common import bounded_batches, staged
from clickmart.llm.decontamination import contamination
from clickmart.llm.language_id import UNKNOWN, held_out, identify, train
from clickmart.llm.line_dedup import dedup_lines
from clickmart.llm.ngram_join import ngram_groups, unpacked
from clickmart.llm.pattern_packing import pack_documents

#: Word shingles and percent of similarity of near duplicates.
WORDS, PERCENT = 5, 80


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, whatever their mixture.

    The model is learned from the stage's own labelled rows outside the
    held-out fold. Where they teach nothing, every text with a letter stays.
    """
    bounded_batches(spark)
    model = train(docs.where(~held_out(F.col("doc_id"))))
    if not model[0]:
        return docs.where(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    return identify(docs, model).where(F.col("lang_pred") != UNKNOWN).select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document (or line) has; n_chars follows the text."""
    bounded_batches(spark)
    out = dedup_lines(docs)
    if "n_chars" in out.columns:
        kind = dict(out.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    bounded_batches(spark)
    kept = unpacked(ngram_groups(docs, words=WORDS, percent=PERCENT))
    return kept.select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    bounded_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    marks, _ = contamination(docs, items)
    hit = staged(
        marks.where("n_hit > 0").select(F.col("doc").alias("_hit_doc"), F.col("key").alias("_hit_key")).distinct(), "contaminated"
    )
    key = F.xxhash64(docs["text"].cast("string"))
    return docs.join(hit, [docs["doc_id"].eqNullSafe(hit["_hit_doc"]), key == hit["_hit_key"]], "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces in sequences of at most 1024 tokens."""
    bounded_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("ngram_join", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("pattern_packing", packing_stage),
]

#: SQL cannot express the language model, the edit join or the packing; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
