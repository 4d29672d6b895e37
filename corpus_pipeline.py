"""The corpus pipeline: toxicity, exact dedup, near-dedup, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor
kept and returns the columns of ``documents``; the last returns the packing.
Filtering stages drop rows and never change one; the secrets stage keeps every row
and replaces the secrets in its text.  Further columns, whatever their names, pass through all stages but
the last, and no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.config import free_name
from annospark.lineage import cut
from annospark.llm import exact_dedup, packing, secret_scan, simhash, tokens
from annospark.llm import toxicity as tox
from annospark.llm.queries import tokenizer_file


#: Documents in an Arrow batch.  They are long: Spark's default of 10,000 is some 100 MB at once in a worker and in the JVM's buffers.
BATCH = "1000"


def in_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH`` documents, unless the session has a size of its own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, BATCH)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the model, fitted on the labels of ``labels``, gives a toxicity under one half.

    A null or empty text counts as no words, and stays unless most labelled rows are toxic.  Ids play no part in the verdict, so rows
    with a null id, and repeated rows, stay or go by their texts.  A long text is judged by all its passages.
    """
    in_batches(spark)
    model = tox.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(tox.toxicity(spark, F.col("text"), model) < 0.5)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, letter case of A-Z aside, the row with the largest id.

    A null text is an empty one; a null id is less than any other; of rows with equal ids and texts exactly one can stay.  A very long
    text is a few levels of names more.
    """
    in_batches(spark)
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row with the least id; five-word shingles, similarity 0.8.

    Texts without words, null ones too, are one class; a null id stays only if its class has no other; of rows with equal ids
    and texts exactly one can stay.  Of a very long text all shingles count; one task at a time has its set of them, eight bytes each.
    """
    in_batches(spark)
    return simhash.near_dedup(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, each secret in a text replaced by its kind, and ``n_chars`` brought up to date where the text has changed.

    Null and empty texts, null ids and repeated rows stay as they are; a null ``n_chars`` stays null.  A very long text is searched
    whole, in time proportional to its length.
    """
    in_batches(spark)
    columns, before = docs.columns, free_name("before", docs.columns)
    out = secret_scan.redact(docs.withColumn(before, F.char_length("text")))
    if "n_chars" in columns:
        n = F.col("n_chars") + (F.char_length("text") - F.col(before)).cast(dict(docs.dtypes)["n_chars"])
        out = out.withColumn("n_chars", F.coalesce(n, F.col("n_chars")))
    return out.select(*columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bucket, batch and slot of every row; lengths are the token counts of op 1.

    Null and empty texts have length 0; ties in length are told apart by id; null and repeated ids are rows like any others.  A very
    long text that exceeds the budget is a batch of its own.
    """
    in_batches(spark)
    return packing.pack(docs, length=tokens.token_length(docs, tokenizer_file("byte_bpe_50k.json")))


STAGES = [("toxicity", toxicity), ("exact dedup", exact), ("SimHash near-dedup", near), ("secret scans", secrets), ("packing", pack)]

#: SQL can't express the trained stage; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
