"""The corpus pipeline: operators of zonelake.llm applied to ``documents`` one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that its predecessor kept.
The stages, their input and what they do with it:

1. language ID: rows whose language is ``und`` (null text, no letter) or whose score is under the least score
   go; if nothing could be learned every row with a letter stays.
2. line dedup: lines that occur earlier in the corpus go; the row stays, ``n_chars`` follows the text.
3. SimHash near-dedup: one row of each group stays, the one with the smallest id.
4. benchmark decontamination: rows contaminated by an item of ``benchmark`` go.
5. packing: the pieces of what is left, with their sequences and offsets.

All but the last return the columns of ``documents``.  Between the stages the rows are written as Parquet
into the shared scratch folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.llm.common import load, stored
from zonelake.llm.decontam import drop_contaminated
from zonelake.llm.langid import keep_identified
from zonelake.llm.line_dedup import drop_duplicate_lines
from zonelake.llm.packing import pack
from zonelake.llm.simhash import RADIUS, SHINGLE, drop_near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shorter = drop_duplicate_lines(docs)
    if "n_chars" in docs.columns:
        shorter = shorter.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return shorter.select(docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, shingle=SHINGLE, radius=RADIUS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

ORACLE_SQL = None  # SQL expresses neither the trained network nor the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
