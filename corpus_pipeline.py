"""A corpus pipeline over documents: language ID, line dedup, near-dedup, benchmark decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next one's docs. No SQL
expresses language ID or BagMinHash, so the whole is tested stage by stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import materialize
from forecourt.llm.decontaminate import remove_contaminated
from forecourt.llm.language_id import keep_identified, learn, loss_limit
from forecourt.llm.line_dedup import dedup_lines
from forecourt.llm.mixing import mixed_documents
from forecourt.llm.near_dedup import drop_near_duplicates


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has no letter, is null or decodes to no learned language go; learnt from all rows that have one."""
    model = learn(docs, F.lit(True))
    return keep_identified(docs, model, loss_limit(docs, model, F.lit(True)))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document of smaller id holds go; n_chars follows the text. Every row stays, if with empty text."""
    columns = [F.char_length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else c for c in docs.columns]
    return dedup_lines(docs).select(*columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the smallest doc_id stays."""
    return drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which tiles cover at least half of a benchmark item go."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with how often in a column copies."""
    return mixed_documents(docs)


STAGES = [
    ("language_id", identify),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
