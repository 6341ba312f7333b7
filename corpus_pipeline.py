"""From raw documents to packed sequences: five stages, each reading what the one before wrote.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``
(extra columns go with the first stage); the last returns the packing, a row
per piece. ``ORACLE_SQL`` is None: SQL can't express the tokenizer or a trained
classifier. The tests hold the pipeline against a brute-force version.

Defined results: null and empty texts go in the first stage (no letter);
repeated rows (same id and text) are one document from the third stage on, and
of one id's texts those in one group; a document whose bytes all repeat elsewhere stays, with an empty text; an empty
table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewforge.llm import language_id, minhash_join, packing, quality_rules, suffix_dedup
from reviewforge.llm.common import stored, table

#: Least similarity of near-duplicates, in percent.
SIMILAR = 80
#: Bytes of a string that may not repeat: 51 words with the spaces after them are rarely fewer.
REPEATED = suffix_dedup.Window(span=200, gram=64)
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages."""
    return language_id.identify(docs, keep=COLUMNS).where(F.col("lang_pred") != language_id.UND).select("own.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.passing(docs, COLUMNS)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash_join.representatives(docs.select(*COLUMNS), SIMILAR).select(*COLUMNS)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that repeat."""
    others = ("lang", "source")
    left = suffix_dedup.remove_repeats(docs, keep=others, with_text=True, size=REPEATED)
    return left.select("doc_id", F.col("kept_text").alias("text"), *others, F.length("kept_text").cast("long").alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("minhash_join", minhash_stage),
    ("suffix_dedup", suffix_stage),
    ("best_fit_packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
