"""A training-corpus pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the result
is written as Parquet in the shared folder and read again as the next stage's
``docs``, so a lost executor costs at most the stage at work. All stages but
the last return the columns of ``documents``.

language    documents whose language is not known are left out
near_dups   one document of each SimHash group stays (its smallest doc_id)
pii         personal data in the texts is masked, n_chars follows
mixing      sources are brought to their target weights: a document taken
            several times is several rows, one not taken is left out
packing     the rows are cut at document or sentence ends into sequences of at most 1024 ids
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillbook.llm.common import prepare, table, word_count, write_read
from fillbook.llm.langid import LanguageModel, held_out
from fillbook.llm.mixing import Mix
from fillbook.llm.packing import pack_sequences
from fillbook.llm.pii import mask_pii
from fillbook.llm.simhash import drop_near_duplicates


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: rows with a null or letterless text, or one whose best
    language is unlikely, go. The model learns from this stage's own rows."""
    prepare(spark)
    model = LanguageModel.fit(docs, ~held_out(F.col("doc_id"), 5, 0))
    return model.accepted(docs)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup at 4-word shingles and 4 bits: one row of each group."""
    prepare(spark)
    return drop_near_duplicates(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: every span becomes its kind in angle brackets; ``n_chars``
    is the masked text's length (null where the text is null)."""
    prepare(spark)
    return mask_pii(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: each row as often as the mix takes it, at most three times."""
    prepare(spark)
    size, sources = word_count(F.col("text")), F.array("source")
    uses = Mix.fit(docs, sources, size).uses(docs.select(*[F.col(c).alias(f"d_{c}") for c in docs.columns], "doc_id", "source", "text"), sources, size)
    rows = uses.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest("uses", F.lit(1))))).where("uses > 0")
    return rows.select(*[F.col(f"d_{c}").alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: one row per piece of a document in its sequence."""
    prepare(spark)
    return pack_sequences(docs, inner_cuts=False)


STAGES = [("language", language), ("near_dups", near_dups), ("pii", pii), ("mixing", mixing), ("packing", packing)]

#: SQL can express none of the learned and hashed stages; tests/llm holds each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_read(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
