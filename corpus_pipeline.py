"""From documents to packed token sequences: language, toxicity, near duplicates, packing.

Each stage is a function of (spark, docs, sf_dir) that works on all documents its predecessor kept.  ``run``
writes each result as Parquet to the shared folder and reads it again for the next stage.  All stages but the last
return the columns of documents, extra ones included.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderloom.llm import bottom_k, language_codes, ordinal_toxicity, packing
from tenderloom.llm.common import small_batches, staged, table
from tenderloom.llm.tokens import public_path

SIMILARITY = Fraction(4, 5)
ABOVE_CHANCE = 1.1


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a learnt language.

    Those without text or without a letter go, and those that are like no language learnt: their best language scores
    less than nearly all documents of that language and size do, or is flagged as ambiguous and scores less than
    ``ABOVE_CHANCE`` times what it would by chance.  If no document has a language to learn from, those with a letter
    cannot be told apart and go too.
    """
    small_batches(spark)
    model, cuts = language_codes.learn_calibrated(docs)
    found = language_codes.predicted(F.col("text"), model, cuts)
    by_chance = found["ambiguous"] & (found["score"] < ABOVE_CHANCE / max(1, len(model.languages)))
    return docs.where((found["lang"] != language_codes.UNDETERMINED) & ~(by_chance | found["unlike"]))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are not graded toxic; an empty text is not."""
    small_batches(spark)
    model = ordinal_toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(~ordinal_toxicity.graded(F.col("text"), model)["toxic"])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group, that with the smallest id; those without words are in no group.

    Texts are judged, not ids: an id may stand on several texts or rows.  Rows without id form a group for each set of
    shingles.  Of rows with one id and one text the first in the order of their other columns stays.
    """
    judged = bottom_k.decisions(docs, SIMILARITY)
    id_, key = _free_name(docs, "judged_id"), _free_name(docs, "judged_key")
    judged = staged(judged.select(F.col("doc_id").alias(id_), F.col("key").alias(key), "repeated"), "judged")
    own = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (bottom_k.text_key() == F.col(key))
    others = docs.join(judged, own, "left_anti")
    # Rows that come again are few or none: written apart, their list is seen to be small and the texts are not dealt out.
    repeated = staged(judged.where("repeated").drop("repeated"), "repeated")
    again = docs.join(repeated, own)
    order = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    # The rank filter reduces the rows of a task before they are dealt out, however often a row comes.
    rank = _free_name(docs, "judged_rank")
    again = again.withColumn(rank, F.row_number().over(Window.partitionBy(id_, key).orderBy(*order)))
    return others.unionByName(again.where(F.col(rank) == 1).select(*[F.col(f"`{c}`") for c in docs.columns]))


def _free_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack(packing.token_pieces(docs, public_path("word_bpe_49k.json")))


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

# Learnt classifiers and tokenizers have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
