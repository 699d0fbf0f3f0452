"""Helpers of the text operators.

Arrow batches hold spark.sql.execution.arrow.maxBytesPerBatch at most (64 MB by
default) or one row, and BATCH_ROWS rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch: 10,000 texts, which is Spark's default, with what Python makes of them are too much for small executors.
BATCH_ROWS = 256


def small_batches(spark: SparkSession) -> None:
    """Lower the rows of the session's Arrow batches; plans read this when they run, so it stays."""
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_of(df: DataFrame, col: str = "text") -> Column:
    """The text column with null as the empty string."""
    return F.coalesce(df[col], F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores in front until df has no such column (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
