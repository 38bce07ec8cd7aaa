"""A training corpus from the table of documents, in five stages.

Every stage takes what the stage before kept and returns documents with the same columns; the last one returns pieces
of packed sequences. Stages are written as Parquet and read again, so each survives the loss of executors on its own.

An empty table passes through all stages; nulls and repeated rows are dealt with as the operators of each stage say.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from curbline.llm.common import table
from curbline.llm.exact_dedup import drop_exact_duplicates
from curbline.llm.language_id import fit_language_model, keep_known_languages
from curbline.llm.mixing import mixed_documents
from curbline.llm.near_dedup import drop_near_duplicates
from curbline.llm.packing import pack_documents, piece_digest
from curbline.session import release, settle, settled_as

#: Intermediate tables of a stage; they go when the next stage starts, as the stage's result is written by then.
WITHIN = "corpus-stage"

#: A text is rejected when no learned language reaches this score. Of held-out texts of learned languages 1 in 2,000 stay
#: below, of texts of a language left out of training 2 to 7 in 100; a higher bound would cost clean texts.
LEAST_SCORE = 0.5


#: Rows handed to Python at once. A stage is evaluated after its function has returned, so the setting stays with the
#: session; lower ones are kept. Whole texts in batches of the default 10,000 rows would fill an executor's memory.
BATCH_ROWS = 1000


def stage(function):
    """A stage that first lets go what the stage before has stored on its way."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, WITHIN, keep_for=docs)
        batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(batch)) <= BATCH_ROWS:
            spark.conf.set(batch, str(BATCH_ROWS))
        with settled_as(WITHIN):
            return function(spark, docs, sf_dir)

    return run_stage


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts that look like no learned language."""
    return keep_known_languages(docs, fit_language_model(docs), least_score=LEAST_SCORE)


@stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return drop_exact_duplicates(docs)


@stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return drop_near_duplicates(docs)


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix takes their words."""
    return mixed_documents(docs, length_column="n_chars")


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return piece_digest(pack_documents(docs))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: Trained models, sketches and pseudorandom draws cannot be stated in SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stored = table(spark, sf_dir, "documents"), None
    for name, function in STAGES[:-1]:
        result = function(spark, docs, sf_dir)
        with settled_as(f"corpus-{name}"):
            docs = settle(result, name)
        if stored:
            release(spark, stored)  # the input of the stage just written
        stored = f"corpus-{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
