"""Operator 1: document quality by co-training two views.

One classifier sees the text (shares of character classes, word and line
statistics), the other the page metadata (source, language and length). Both are
logistic regressions. In each round, each view labels the unlabelled documents
it is sure of, and these pseudo-labels, at a lower weight, join the training rows
of the other view. At the end both views are calibrated together on labelled
rows that neither view was fitted on, and every document gets the combined
probability of good quality.

Defined results: null text counts as empty, null metadata as a value of its own;
a doc_id that is repeated in labels counts with the mean of its labels, rounded;
documents without words are scored from their features like all others. Without
labels of both kinds every document scores 1 and is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import small_batches, text_of
from skyloom.session import materialize

ROUNDS = 2
#: A pseudo-label needs at least this probability; its rows have this weight.
SURE = 0.95
PSEUDO_WEIGHT = 0.2
#: Documents with a lower combined probability are rejected.
KEEP = 0.4
#: Slots for hashed sources and languages.
SOURCE_SLOTS, LANG_SLOTS = 32, 16

_CLASS_OF = np.zeros(256, np.uint8)
for _class, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), (32,), (10,), range(128, 256), b".,;:?'\"()-", b"#*$%&<>@=/\\{}[]_^~+", b"|", b"!"), 1):
    _CLASS_OF[list(_bytes)] = _class
_N_CLASSES = 11
TEXT_FEATURES = _N_CLASSES + 6


def text_features(text: str) -> np.ndarray:
    """Shares of byte classes; word length, distinct and repeated words, repeated lines, capital words, log length."""
    found = np.zeros(TEXT_FEATURES)
    data = text.encode()
    if not data:
        return found
    found[:_N_CLASSES] = np.bincount(_CLASS_OF[np.frombuffer(data, np.uint8)], minlength=_N_CLASSES) / len(data)
    words = text.split()
    n = max(1, len(words))
    lines = [line for line in text.split("\n") if line.strip()]
    found[_N_CLASSES:] = (
        len(text) / n / 10,
        len(set(words)) / n * np.log1p(n) / 5,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        sum(map(str.isupper, words)) / n,
        np.log1p(len(words)) / 10,
    )
    return found


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _text_view(texts: pa.Array) -> pa.Array:
    rows = [text_features(t) for t in texts.to_pylist()]
    flat = np.concatenate(rows) if rows else np.zeros(0)
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * TEXT_FEATURES)
    return pa.ListArray.from_arrays(offsets, pa.array(flat))


def _one_hot(value: Column, slots: int) -> list[Column]:
    slot = F.pmod(F.xxhash64(F.coalesce(value, F.lit("\0"))), F.lit(slots))
    return [F.when(slot == i, 1.0).otherwise(0.0) for i in range(slots)]


def _meta_view(df: DataFrame) -> Column:
    length = F.log1p(F.greatest(F.lit(0.0), F.coalesce(df["n_chars"].cast("double"), F.lit(0.0))))
    return F.array(*_one_hot(df["source"].cast("string"), SOURCE_SLOTS), *_one_hot(df["lang"].cast("string"), LANG_SLOTS), length / 10, length * length / 100)


@dataclass
class Model:
    """The views and their combination; None where the labels are of one kind."""

    text: LogisticRegressionModel | None
    meta: LogisticRegressionModel | None
    both: LogisticRegressionModel | None


def _fit(rows: DataFrame, features: str, **more) -> LogisticRegressionModel:
    return LogisticRegression(featuresCol=features, labelCol="y", weightCol="w", maxIter=25, regParam=more.get("regParam", 1e-3)).fit(rows)


def _p(df: DataFrame, model: LogisticRegressionModel, features: str, out: str) -> DataFrame:
    own = model.copy().setFeaturesCol(features).setProbabilityCol("__p").setPredictionCol("__y").setRawPredictionCol("__r")
    return own.transform(df).withColumn(out, vector_to_array("__p")[1]).drop("__p", "__y", "__r")


def _logit(p: str) -> Column:
    bounded = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), F.col(p)))
    return F.log(bounded / (1 - bounded))


def _views(df: DataFrame) -> DataFrame:
    return df.withColumns({"__t": array_to_vector(_text_view(text_of(df))), "__m": array_to_vector(_meta_view(df))})


def fit(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Model:
    """Co-train on docs(doc_id, text, lang, source, n_chars) and labels(doc_id, quality)."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.round(F.avg("quality")).alias("y"))
    views = _views(docs).select("doc_id", "__t", "__m").join(known, "doc_id", "left")
    # every fifth labelled document is left for the calibration
    check = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    rows = materialize(views.select("__t", "__m", "y", (check & F.col("y").isNotNull()).alias("check"))).cache()
    labelled = rows.where("y is not null and not check").select("__t", "__m", "y", F.lit(1.0).alias("w"))
    pool = rows.where("y is null").select("__t", "__m")
    if labelled.select("y").distinct().count() < 2:
        return Model(None, None, None)
    text, meta = _fit(labelled, "__t"), _fit(labelled, "__m")

    def pseudo(model: LogisticRegressionModel, features: str) -> DataFrame:
        guessed = _p(pool, model, features, "p").where((F.col("p") >= SURE) | (F.col("p") <= 1 - SURE))
        return guessed.select("__t", "__m", F.round("p").alias("y"), F.lit(PSEUDO_WEIGHT).alias("w"))

    for _ in range(rounds):
        from_text, from_meta = pseudo(text, "__t"), pseudo(meta, "__m")
        text, meta = _fit(labelled.union(from_meta), "__t"), _fit(labelled.union(from_text), "__m")
    checked = _combined(_p(_p(rows.where("check"), text, "__t", "__pt"), meta, "__m", "__pm")).withColumn("w", F.lit(1.0))
    both = _fit(checked, "__b", regParam=1e-2) if checked.select("y").distinct().count() == 2 else None
    rows.unpersist()
    return Model(text, meta, both)


def _combined(df: DataFrame) -> DataFrame:
    return df.withColumn("__b", array_to_vector(F.array(_logit("__pt"), _logit("__pm"))))


def score(df: DataFrame, model: Model, keep_at: float = KEEP) -> DataFrame:
    """Add p_text, p_meta, quality_score and kept; other columns pass through, those of these names are replaced."""
    small_batches(df.sparkSession)
    if model.text is None or model.meta is None:
        return df.withColumns({c: F.lit(1.0) for c in ("p_text", "p_meta", "quality_score")} | {"kept": F.lit(True)})
    scored = _p(_p(_views(df), model.text, "__t", "__pt"), model.meta, "__m", "__pm")
    if model.both is None:
        scored = scored.withColumn("__q", F.col("__pt"))
    else:
        scored = _p(_combined(scored), model.both, "__b", "__q").drop("__b")
    named = scored.withColumns({"p_text": F.col("__pt"), "p_meta": F.col("__pm"), "quality_score": F.col("__q"), "kept": F.col("__q") >= keep_at})
    return named.drop("__t", "__m", "__q", "__pt", "__pm")
