"""Operator 9: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon joins known insults with terms learned from the training rows: words
and word beginnings that are far commoner in toxic than in other texts. Features
are lexicon densities, closeness to second-person words, shares of capitals and
punctuation, and rates of obfuscated words. Trees are fitted on most training
rows; isotonic regression on the rest, which neither trees nor learned terms have
seen, maps their probabilities to frequencies. Only texts are inputs of a score.

Fitting reads at most `fit_rows` labelled rows, chosen by a hash of doc_id, and
never a held-out row (crc32 of doc_id as text, mod 5, is 0). The model has at most
MAX_TERMS learned terms, the best of MAX_CANDIDATES that are in the most toxic
rows of the fit. Scoring reads every whole text.

Defined results: null and empty texts are scored with all features 0; null
labels are left out of the fit; a doc_id that is repeated in labels counts once
for each label; without labels of both kinds the score is the share of toxic
labels (0 if there are none).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import small_batches, text_of
from skyloom.session import materialize

#: Labelled rows that a fit reads at most.
FIT_ROWS = 12_000
#: Learned terms at most; each must be in so many toxic texts and so many times commoner there, and chance must
#: give such counts with a probability of exp(-EVIDENCE) at most, as many thousand terms are tried.
MAX_TERMS = 2_000
MAX_CANDIDATES = 100_000
LEAST_TEXTS = 4
LEAST_SHARE = 0.004
RATIO = 25.0
EVIDENCE = 10.0
PREFIXES = range(3, 8)

# Common insults and second-person words.
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers pathetic worthless disgusting scum trash garbage clown imbecile jerk creep filthy "
    "idiota estúpido estúpida imbécil basura inútil asqueroso payaso connard idiote stupide imbécile pathétique dégoûtant ordure crétin "
    "dumm dummkopf idiotin trottel abschaum wertlos ekelhaft"
).split()
SECOND_PERSON = "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer tú ti usted ustedes tuyo vosotros".split()

_LEET = str.maketrans("013457@$", "oieastas")
_WORD = re.compile(r"\w+")
_OBFUSCATED = re.compile(r"[^\W\d_][0-9@$*.\-_!][^\W\d_]", re.I)
NAMES = (
    "hits_per_100", "log_hits", "distinct_hits", "insults_per_100", "leet_hits", "near_second_person", "second_person_per_100",
    "capitals", "exclamations", "questions", "punctuation", "obfuscated", "log_words",
)
#: Words between a hit and a second-person word that count as close.
NEAR = 4


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def terms_of(text: str) -> set[str]:
    """The distinct words and, with a dash, word beginnings of a text."""
    words = set(_WORD.findall(text.lower()))
    return words | {f"{w[:n]}-" for w in words for n in PREFIXES if len(w) >= n}


@functools.lru_cache(maxsize=4)
def _automaton(lexicon: tuple[str, ...]):
    """Matches " word " and " beginning" in texts whose words stand between single blanks."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for term in lexicon:
        key = f" {term[:-1]}" if term.endswith("-") else f" {term} "
        found.add_word(key, (term, len(key)))
    found.make_automaton()
    return found


def features(text: str, lexicon: tuple[str, ...]) -> list[float]:
    """The values of NAMES."""
    if not text:
        return [0.0] * len(NAMES)
    lowered = text.lower()
    words = _WORD.findall(lowered)
    n = max(1, len(words))
    flat = f" {' '.join(words)} "
    starts: dict[int, str] = {}
    for end, (term, size) in _automaton(lexicon).iter(flat):
        starts[end - size + 1] = term
    insults, people = set(INSULTS), set(SECOND_PERSON)
    leet = 0
    # a match starts at the blank before its word
    place = np.searchsorted(np.cumsum([0] + [len(w) + 1 for w in words]), sorted(starts)).tolist() if starts else []
    near = sum(not people.isdisjoint(words[max(0, i - NEAR) : i] + words[i + 1 : i + 1 + NEAR]) for i in place)
    odd = _OBFUSCATED.findall(text)
    if odd:
        plain = re.sub(r"(?<=\w)[.*\-_](?=\w)", "", lowered).translate(_LEET)
        leet = max(0, sum(w in insults for w in _WORD.findall(plain)) - sum(w in insults for w in words))
    hits = len(starts)
    size = len(text)
    marks = sum(text.count(c) for c in ".,;:!?'\"()-")
    return [
        100 * hits / n,
        float(np.log1p(hits)),
        float(len({flat[at + 1 : flat.find(" ", at + 1)] for at in starts})),
        100 * sum(w in insults for w in words) / n,
        float(leet),
        100 * near / n,
        100 * sum(w in people for w in words) / n,
        sum(map(str.isupper, text)) / size,
        text.count("!") / size,
        text.count("?") / size,
        marks / size,
        100 * len(odd) / n,
        float(np.log1p(len(words))),
    ]


def _count_terms(only: frozenset[str] | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                terms = terms_of(text)
                for term in terms if only is None else terms & only:
                    seen.setdefault(term, [0, 0])[toxic] += 1
        keys = list(seen)
        yield pa.RecordBatch.from_pydict({"term": keys, "clean": [seen[k][0] for k in keys], "toxic": [seen[k][1] for k in keys]}, schema)

    schema = pa.schema([("term", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())])
    return count


def learn_lexicon(rows: DataFrame, n_toxic: int, n_clean: int) -> tuple[str, ...]:
    """Known insults and at most MAX_TERMS terms learned from rows(text, toxic)."""
    least = max(LEAST_TEXTS, int(LEAST_SHARE * n_toxic))
    schema = "term string, clean long, toxic long"
    common = rows.where("toxic = 1").mapInArrow(_count_terms(None), schema).groupBy("term").agg(F.sum("toxic").alias("n")).where(F.col("n") >= least)
    # each toxic text of bounded share adds few terms of that share; the longest list is cut by frequency
    candidates = frozenset(r.term for r in common.orderBy(F.desc("n"), "term").limit(MAX_CANDIDATES).collect())
    counts = rows.mapInArrow(_count_terms(candidates), schema).groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ratio = (F.col("toxic") / n_toxic) / ((F.col("clean") + 0.5) / n_clean)
    # Chernoff's bound on the chance that so many of a term's texts are toxic
    base = n_toxic / (n_toxic + n_clean)
    seen, hit = F.col("toxic") + F.col("clean"), F.col("toxic").cast("double")
    miss = F.col("clean").cast("double")
    bound = hit * F.log(hit / seen / base) + F.when(miss > 0, miss * F.log(miss / seen / (1 - base))).otherwise(0.0)
    learned = counts.where((F.col("toxic") >= least) & (ratio >= RATIO) & (bound >= EVIDENCE)).orderBy(F.desc("toxic"), "term").limit(MAX_TERMS).collect()
    terms = {r.term: (r.toxic, r.clean) for r in learned}
    for term, (toxic, clean) in list(terms.items()):
        # a beginning that a longer one replaces: as many toxic texts, fewer others
        for n in range(min(PREFIXES), len(term.rstrip("-"))):
            shorter = f"{term[:n]}-"
            if shorter in terms and toxic >= 0.9 * terms[shorter][0] and clean < terms[shorter][1]:
                del terms[shorter]
    # beginnings of known insults tell nothing more, but match other words
    fresh = {t for t in terms if not (t.endswith("-") and any(word.startswith(t[:-1]) for word in INSULTS))}
    return tuple(sorted(fresh | set(INSULTS)))


@dataclass
class Model:
    """A fitted scorer; trees and steps are None where the labels are of one kind."""

    lexicon: tuple[str, ...]
    trees: object
    steps: object
    constant: float


def _vectors(df: DataFrame, text: Column, lexicon: tuple[str, ...], out: str) -> DataFrame:
    @F.arrow_udf("array<double>")
    def dense(texts: pa.Array) -> pa.Array:
        return pa.array([features(t, lexicon) for t in texts.to_pylist()], pa.list_(pa.float64()))

    return df.withColumn(out, array_to_vector(dense(text)))


def _checks(doc_id: Column) -> Column:
    """The rows that calibrate: an eighth of those that are not held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 10 == 1


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from docs(doc_id, text) and labels(doc_id, toxic) without held-out rows."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    n = known.count()
    share = min(1.0, 0.9 * fit_rows / max(n, 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)).limit(fit_rows)
    rows = materialize(docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(chosen), "doc_id").repartition(12))
    counts = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        return Model(tuple(INSULTS), None, None, toxic / max(1, toxic + clean))
    learning = rows.where(~_checks(F.col("doc_id")))
    seen = {r.toxic: r["count"] for r in learning.groupBy("toxic").count().collect()}
    lexicon = learn_lexicon(learning.select("text", "toxic"), seen[1], seen[0]) if len(seen) == 2 else tuple(INSULTS)
    vectors = _vectors(rows, F.col("text"), lexicon, "x").select("x", F.col("toxic").cast("double").alias("label"), _checks(F.col("doc_id")).alias("check"))
    vectors = materialize(vectors.coalesce(4)).cache()
    fitted = GBTClassifier(featuresCol="x", labelCol="label", maxIter=15, maxDepth=3, stepSize=0.3, minInstancesPerNode=4, seed=7)
    trees = fitted.fit(vectors.where(~F.col("check")))
    checked = trees.transform(vectors.where("check")).select("label", vector_to_array("probability")[1].alias("p"))
    steps = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="s").fit(checked) if checked.select("label").distinct().count() == 2 else None
    vectors.unpersist()
    return Model(lexicon, trees, steps, 0.0)


def score(df: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """Add the calibrated probability; other columns pass through."""
    small_batches(df.sparkSession)
    if model.trees is None:
        return df.withColumn(out_col, F.lit(model.constant))
    vectors = _vectors(df, text_of(df, text_col), model.lexicon, "__x")
    trees = model.trees.copy().setFeaturesCol("__x").setPredictionCol("__y").setProbabilityCol("__p").setRawPredictionCol("__raw")
    scored = trees.transform(vectors).withColumn("__p1", vector_to_array("__p")[1])
    if model.steps is not None:
        scored = model.steps.copy().setFeaturesCol("__p1").setPredictionCol("__s").transform(scored)
    else:
        scored = scored.withColumn("__s", F.col("__p1"))
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("__s")))
    return scored.withColumn(out_col, bounded).drop("__x", "__y", "__p", "__raw", "__p1", "__s")
