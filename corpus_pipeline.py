"""The training-data pipeline: five stages over documents, each written as Parquet and read again.

All stages take null and empty texts, repeated rows, null ids, empty tables and
further columns, whatever their names; columns come out as they went in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import bpe, cotraining, mixing, ngram_join, pii
from skyloom.session import materialize, table


def _apart(docs: DataFrame, *names: str) -> DataFrame:
    """The columns that an operator reads, and each row whole as __row, where no name can clash."""
    return docs.select(F.struct(*docs.columns).alias("__row"), *names)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the co-trained views keep.

    Null texts count as empty and are judged like all others; repeated rows have
    the same score, so all stay or none; without labels of both kinds all stay.
    """
    model = cotraining.fit(docs, table(spark, sf_dir, "labels"))
    return cotraining.score(_apart(docs, "text", "lang", "source", "n_chars"), model).where("kept").select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the least id.

    Rows that repeat an id and text are one row. Null, empty and blank texts are
    copies of nothing: each id keeps them.
    """
    return ngram_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with each span of personal data replaced by its kind in brackets, and n_chars to match.

    A null text stays null, an empty one empty; repeated rows stay equal.
    """
    found = pii.detect(_apart(docs, "text"), keep=["__row"])
    text = F.col("__row.text")
    clean = found.select("__row", F.when(text.isNotNull(), pii.redact(text, F.col("spans"))).alias("clean"))
    return clean.select(F.col("__row").withField("text", F.col("clean")).withField("n_chars", F.length("clean").cast("long")).alias("__row")).select("__row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, repeated by the rates that bring the languages to their target tokens.

    Texts without words have rate 1; rows without a language get the rate of what
    their text looks like; repeated rows are repeated alike. No document goes.
    """
    return mixing.repeat(mixing.apply(_apart(docs, "doc_id", "text"), mixing.fit(docs))).select("__row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their texts, their number, and whether they decode to the text's bytes.

    A null or empty text has no ids, and they decode to no bytes. Columns named ids,
    n_tokens or round_trip are replaced.
    """
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.decode(bpe.encode(docs, *ranks), *ranks, bytes_col="__decoded")
    whole = F.col("__decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return encoded.withColumns({"n_tokens": F.size("ids").cast("long"), "round_trip": whole}).drop("__decoded")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("mixing", mix),
    ("byte_bpe", encode),
]

#: Training, pruning and fitting are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
