"""The corpus pipeline: STAGES over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

import threading
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from clickpulse.llm.common import release, scratch, staged, table
from clickpulse.llm.jaccard_join import near_duplicate_stage
from clickpulse.llm.language_id import language_stage
from clickpulse.llm.packing import pack_documents
from clickpulse.llm.quality import quality_stage
from clickpulse.llm.queries import END_ID, WINDOW, vocabulary
from clickpulse.llm.substring_dedup import substring_stage


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"), WINDOW, END_ID)


_BEFORE = threading.local()  # this thread's last stage: what it read, and the working tables its rows still need


def _freeing(stage):
    """``stage``, freeing the working tables of the stage before it, whose rows have been written by then.

    They stay if this stage reads them, or the same documents as the stage before it: then that one's rows may be open.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        was, tables = getattr(_BEFORE, app, (None, []))
        if tables and not docs.sameSemantics(was):
            files = docs.inputFiles()
            read = [df for df in tables if any(df.staged_path.rpartition("/")[2] in x for x in files)]
            release(*[df for df in tables if df not in read])
            tables = read
        with scratch() as own:
            out = stage(spark, docs, sf_dir)
            own.keep(*own.folders.values())
        setattr(_BEFORE, app, (docs, [*tables, *own.folders.values()]))
        return out

    return run


STAGES = [
    ("quality", _freeing(quality_stage)),
    ("language", _freeing(language_stage)),
    ("near_duplicates", _freeing(near_duplicate_stage)),
    ("substrings", _freeing(substring_stage)),
    ("packing", _freeing(packing_stage)),
]

#: the tokenizer's ids have no SQL form; tests hold each stage and the whole against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        read, docs = docs, staged(stage(spark, docs, sf_dir), name)
        if hasattr(read, "staged_path"):
            release(read)
    return STAGES[-1][1](spark, docs, sf_dir)
